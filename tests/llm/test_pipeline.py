"""The pipeline's stages on small documents, each against brute force on its own input."""

import inspect

import pytest
from test_operators import brute_components, brute_fingerprint, brute_hits, brute_lines

import __spark_entry__
import corpus_pipeline
from larkmetric.llm.queries import CHECKS, QUERIES


@pytest.fixture
def sf_dir(workers, corpus, tmp_path):
    docs = workers.read.parquet(corpus[0])
    passage = next(t for i, t in corpus[1] if i == 505)
    items = [(1, " ".join(passage.split()[3:14])), (2, None)]
    workers.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.selectExpr("doc_id", "text", "if(doc_id is null, null, 'en') AS lang", "source", "n_chars", "rid", "fp").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(CHECKS) <= set(QUERIES)
    assert [len(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [3] * 5


def test_stages(workers, sf_dir, tmp_path):
    docs = workers.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        out = f"{tmp_path}/{name}"
        stage(workers, docs, sf_dir).write.parquet(out)
        docs = workers.read.parquet(out)
        if name == "best_fit_packing":
            assert sorted({r.doc_id or -1 for r in docs.collect()}) == sorted({i or -1 for i, _ in before})
            continue
        assert docs.columns == columns
        after = sorted(map(repr, rows_of(docs)))
        if name == "language_id":
            want = [(i, t) for i, t in before if any(c.isalpha() for c in t or "")]
        elif name == "line_dedup":
            want = [(i, t) for i, t, n in brute_lines(before) if not n or (t or "").strip()]
        elif name == "simhash_dedup":
            fps = [brute_fingerprint(t) for _, t in before]
            of = brute_components(set(fps), 4)
            first = {}
            for k in sorted(range(len(before)), key=lambda k: (before[k][0] is None, before[k][0] or 0, k)):
                first.setdefault(of[fps[k]], k)
            want = [before[k] for k in first.values()]
        else:
            items = [(1, workers.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id = 1").first().text)]
            want = [b for b, hit in zip(before, brute_hits(before, items)) if not hit[2]]
        assert after == sorted(map(repr, want)), name
        assert len(after) < len(before), name


def test_run_is_all_stages(workers, sf_dir):
    df = corpus_pipeline.run(workers, sf_dir)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(df.columns)
    assert df.count() > 0


def test_stages_without_rows(workers, sf_dir, tmp_path):
    """Empty documents with extra columns go through every stage."""
    docs = workers.read.parquet(f"{sf_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none")
    docs = workers.read.parquet(f"{tmp_path}/none")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(workers, docs, sf_dir)
        assert out.count() == 0, name
        assert name == "best_fit_packing" or out.columns == docs.columns


def test_models_without_rows(workers, sf_dir, tmp_path):
    """Empty documents, and labels that are missing or all alike."""
    given = workers.read.parquet(f"{sf_dir}/documents.parquet")
    given.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    given.write.parquet(f"{tmp_path}/some/documents.parquet")
    given.write.parquet(f"{tmp_path}/alike/documents.parquet")
    schema = "doc_id long, quality int, toxic int"
    workers.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/labels.parquet")
    workers.createDataFrame([], schema).write.parquet(f"{tmp_path}/some/labels.parquet")
    workers.createDataFrame([(k, 1, 1) for k in range(40)] + [(41, None, None), (None, 1, 1)], schema).write.parquet(f"{tmp_path}/alike/labels.parquet")
    for name in ("op2_language_id", "op5_toxicity", "op10_quality"):
        assert QUERIES[name](workers, f"{tmp_path}/none").count() == 0
    for name in ("op5_toxicity", "op10_quality"):
        for folder in ("some", "alike"):
            rows = QUERIES[name](workers, f"{tmp_path}/{folder}").collect()
            assert len(rows) == given.count() and all(0 <= r.score <= 1 for r in rows)
            assert folder == "some" or all(r.predicted == 1 for r in rows)
