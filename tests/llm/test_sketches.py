"""Sketches and neighbours (operator 13) against plain Python."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from larkmetric.llm import queries, sketches

BIG = 1 << 63


def signed(h):
    return h - 2 * BIG if h >= BIG else h


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return signed(seed)


def hashes(text, shingle=5):
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    return {chained(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def brute_sketch(text, scale=4, shingle=5):
    every = hashes(text, shingle)
    return sorted([h for h in every if h < -BIG + 2 * BIG // scale] or sorted(every)[:1])


def likeness(a, b):
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def as_text(sketch):
    return "".join(f"{h % (2 * BIG):016x}" for h in sketch)


def order_of(row):
    i, t = row
    return (i is None, i or 0, xxhash.xxh64_intdigest(t.encode(), 42) >> 11, t)


def brute(rows):
    rows = sorted([(i, t or "") for i, t in rows], key=order_of)
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        a, b, c = brute_sketch(t), brute_sketch(edited), brute_sketch(u)
        yield (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(b), likeness(a, b), likeness(a, c))


def compared(df, rows):
    def plain(found):
        return sorted(repr(tuple(round(x, 12) if isinstance(x, float) else x for x in r)) for r in found)

    assert plain(df.collect()) == plain(brute(rows))


def test_whole_query(workers, corpus, tmp_path):
    docs = workers.read.parquet(corpus[0])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    compared(queries.op13_document_fingerprints(workers, str(tmp_path)), corpus[1])


@pytest.mark.parametrize("rows", [[], [(7, "only one row of six words")], [(None, None)], [(1, "a b"), (1, "a b"), (1, None), (None, "c d"), (None, "")]])
def test_few_rows(workers, frame, tmp_path, rows):
    frame(rows, 0).write.parquet(f"{tmp_path}/documents.parquet")
    compared(queries.op13_document_fingerprints(workers, str(tmp_path)), rows)


def test_hot_ids(workers, frame, tmp_path):
    """A third of the rows has one id, another third none, and large ids lie unevenly; the number of tasks is of no account."""
    rng = random.Random(3)
    rows = [(rng.choice([5, None, rng.randint(-9, 2000), (1 << 62) + rng.randint(0, 40)]), " ".join(rng.choices("abcdefgh", k=rng.randint(0, 30)))) for _ in range(400)]
    frame(rows, 5).write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.op13_document_fingerprints(workers, str(tmp_path))
    compared(df, rows)


def test_ranges_split_a_hot_id(workers, frame):
    rows = [(5, f"text {k}") for k in range(500)] + [(None, f"other {k}") for k in range(500)]
    df = sketches.with_next(frame(rows, 4), {}).groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in df.collect()]
    assert sum(sizes) == 1000 and max(sizes) < 350


def test_long_text_in_blocks(workers, frame, monkeypatch):
    """Blocks lose no shingle, wherever they end."""
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "bc", "d", " ", "  ", "\n", "É", "日本 "]) for _ in range(n)) for n in (0, 3, 30, 300, 900)]
    texts += [" " * 200 + "one two", "x" * 300, "a b c d " + "y" * 300 + " e f", "k " * 150]
    monkeypatch.setattr(sketches, "BLOCK_CHARS", 40)
    found = frame([(i, t) for i, t in enumerate(texts)]).select("doc_id", sketches.sketch(F.col("text"), 2).alias("s")).collect()
    assert {r.doc_id: list(r.s) for r in found} == {i: brute_sketch(t, 2) for i, t in enumerate(texts)}


def test_containment_and_merging(workers, frame):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(4000)]
    long = " ".join(words)
    parts = [" ".join(words[k : k + 400]) for k in range(0, 4000, 396)]
    rows = [(1, long), (2, parts[4]), (3, " ".join(rng.sample(words, 400)))] + [(10 + k, p) for k, p in enumerate(parts)]
    made = frame(rows).select("doc_id", (F.col("doc_id") >= 10).alias("part"), sketches.sketch(F.col("text")).alias("sketch"))
    held = {r.doc_id: r.sketch for r in made.collect()}
    pair = made.select(sketches.shared_part(F.lit(held[1]), F.col("sketch")).alias("near"), "doc_id").collect()
    near = {r.doc_id: r.near for r in pair}
    assert near[1] == near[2] == 1 and near[3] < 0.05
    assert sorted(r.hash for r in sketches.merged(made, "part").where("part").collect()) == held[1]


def test_native_plan(workers, frame):
    df = sketches.edited_likeness(frame([(1, "a"), (2, "b")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas")) and plan.count("Exchange ") <= 2
