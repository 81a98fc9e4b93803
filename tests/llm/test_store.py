"""Rows keep their numbers however a scan is split, and names never clash."""

import public_tokenizers
import pytest

from larkmetric.llm import line_dedup, store, token_counts


@pytest.fixture
def docs(workers, tmp_path):
    rows = workers.range(4000).selectExpr("id AS doc_id", "concat('a line of some thirty bytes or more ', id % 50, '\nmine ', id) AS text")
    rows.repartition(3).write.parquet(f"{tmp_path}/documents")
    return lambda: workers.read.parquet(f"{tmp_path}/documents")


def numbers(df):
    return {r.doc_id: r.rid for r in store.tagged(df).select("doc_id", "rid").collect()}


def test_numbers_do_not_follow_splits(docs, conf):
    conf(spark__sql__files__maxPartitionBytes="128m")
    whole = numbers(docs())
    conf(spark__sql__files__maxPartitionBytes="8k", spark__sql__files__openCostInBytes="1")
    assert docs().rdd.getNumPartitions() > 4
    assert numbers(docs()) == whole and len(set(whole.values())) == 4000
    assert numbers(docs().where("doc_id % 3 = 0")) == {k: v for k, v in whole.items() if k % 3 == 0}


def test_splits_may_change_between_steps(docs, conf, workers):
    """Between finding and dropping rows the scan is split anew."""
    df = store.on_files(docs())
    conf(spark__sql__files__maxPartitionBytes="128m")
    found = store.stored(store.tagged(df).where("doc_id % 5 = 0").select("rid"), "found")
    conf(spark__sql__files__maxPartitionBytes="8k", spark__sql__files__openCostInBytes="1")
    left = store.without_rows(df, found, "gone")
    assert sorted(r.doc_id for r in left.collect()) == [k for k in range(4000) if k % 5]


def test_rows_of_no_file_are_written_first(workers):
    df = workers.createDataFrame([(1, "a"), (2, None), (2, None)], "doc_id long, text string")
    assert store._row_number(df) is None
    held = store.on_files(df)
    assert store.on_files(held) is held
    assert sorted((r.doc_id, r.text) for r in store.tagged(held).collect()) == [(1, "a"), (2, ""), (2, "")]
    with pytest.raises(ValueError):
        store.numbered(df, "n")
    joined = held.join(workers.range(3).withColumnRenamed("id", "k"))
    assert store.tagged(joined).count() == 9


CLASHES = ["_rid", "_rid_of", "_rid_gone", "_touched", "_lost", "_had", "_metadata", "rid", "RID", "gone", "lines", "of", "fp"]


@pytest.mark.parametrize("name", CLASHES)
def test_columns_of_any_name(workers, tmp_path, name):
    line = "a line that is long enough to be evidence\n"
    rows = [(k, f"{line * (k % 2)}own {k}", "x") for k in range(6)]
    workers.createDataFrame(rows, f"doc_id long, text string, `{name}` string").write.parquet(f"{tmp_path}/d")
    df = workers.read.parquet(f"{tmp_path}/d")
    kept, _, lost = line_dedup.without_repeats(df)
    assert sorted((r.doc_id, r[lost]) for r in kept.collect()) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 0), (5, 1)]
    assert kept.columns[:3] == df.columns
    gone = store.tagged(df).where("doc_id > 2").select("rid")
    left = store.without_rows(df, gone, "gone")
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [0, 1, 2]


def test_blocks_of_rows_that_do_not_follow_each_other(docs):
    """Rows of several small files in one task, and files of which rows were left out."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs(), path).collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs().where("doc_id % 7 != 0"), path).collect()}
    assert len(want) == 4000 and got == {k: v for k, v in want.items() if k % 7}
