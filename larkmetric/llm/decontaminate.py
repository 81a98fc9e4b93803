"""Benchmark decontamination by winnowing (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays, bloom
from larkmetric.llm.store import stored, tagged

WINDOW = 10
GRAM = 5
#: After A-Z are lower-cased, words are runs of digits, a-z and all beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


class _Words:
    """Words of some texts: a hash for each, and where each text's begin."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        data = arrays.LOWER[data]
        starts, ends, self.first = arrays.word_spans(WORD[data], bounds)
        self.words = arrays.span_hashes(arrays.BYTE_VALUE[data], starts, ends)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.count)), self.count)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of runs of ``size`` words within one text, and their hashes."""
        at = arrays.within(self.first, size)
        return at, arrays.span_hashes(self.words, at, at + size)

    def winnowed(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each run of ``window`` words, the smallest k-gram hash, the last of equals: places and hashes."""
        at = arrays.within(self.first, window)
        if not len(at):
            return at, np.empty(0, np.uint64)
        every = np.arange(len(self.words) - gram + 1)
        hashes = arrays.span_hashes(self.words, every, every + gram)
        best, place = hashes[at], at.copy()
        for i in range(1, window - gram + 1):
            other = hashes[at + i]
            less = other <= best
            best = np.where(less, other, best)
            place[less] = at[less] + i
        place = np.unique(place)
        return place, hashes[place]


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``item_id``, ``size``, ``whash``, ``fps`` of every window of every item.

    An item of fewer words, but not none, is one window of ``size`` words,
    whose own hash is its fingerprint.
    """
    rows = tagged(items, id_col, text_col).select("rid", F.col("doc_id").cast("string").alias("doc_id"), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                words = _Words(data, bounds)
                ids = part.column(1)
                at, whash = words.grams(window)
                place, fp = words.winnowed(window, gram)
                low, high = np.searchsorted(place, at), np.searchsorted(place, at + window - gram, side="right")
                out = [(words.text[at], np.full(len(at), window), whash, fp[arrays.ragged(low, high - low)], high - low)]
                for size in range(1, window):
                    short = words.first[:-1][words.count == size]
                    if len(short):
                        h = arrays.span_hashes(words.words, short, short + size)
                        out.append((words.text[short], np.full(len(h), size), h, h, np.ones(len(h), np.int64)))
                for text, size, h, fps, n in out:
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(text)),
                            pa.array(size.astype(np.int32)),
                            pa.array(h.view(np.int64)),
                            arrays.lists(fps.view(np.int64), n, pa.int64()),
                        ],
                        names=["item_id", "size", "whash", "fps"],
                    )

    return rows.mapInArrow(make, "item_id string, size int, whash long, fps array<long>")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """The words of each row that lie in a passage of ``window`` words of a benchmark item.

    Returns ``rid``, ``doc_id``, ``n_words``, ``n_hit``, ``n_items`` and
    ``items``, the sorted ids as strings, for every row. Null and empty texts
    have no words. Items with a null id count for ``n_hit``, not for ``items``;
    items that share an id are one item; without items nothing is hit.

    Winnowing keeps the smallest ``gram``-word hash of every ``window`` words, so
    each shared passage of that length has a fingerprint in common. Documents'
    fingerprints that a Bloom filter of fixed size rules out stay where they
    are; the others are joined to the benchmark's, and each hit is extended to
    the windows around it, whose hashes must be equal too.
    """
    kept = stored(benchmark_windows(items, item_id_col, item_text_col, window, gram), "windows")
    # Only the number of words of short items is collected, at most ``window - 1`` numbers.
    sizes = sorted(r.size for r in kept.where(F.col("size") < window).select("size").distinct().collect())
    prints = kept.select(F.explode("fps").alias("fp")).distinct()
    held, _ = bloom.build(prints)
    rows = tagged(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, n_words long, fps array<long>, starts array<int>, sizes array<int>, whashes array<long>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                words = _Words(data, bounds)
                place, fp = words.winnowed(window, gram)
                hit = bloom.may_hold(held, fp)
                place, fp = place[hit], fp[hit]
                text = words.text[place]
                low = np.maximum(place - (window - gram), words.first[text])
                high = np.minimum(place, words.first[text + 1] - window)
                n = high - low + 1
                starts, fps = arrays.ragged(low, n), np.repeat(fp, n)
                found = [(starts, np.full(len(starts), window), arrays.span_hashes(words.words, starts, starts + window), fps)]
                for size in sizes:
                    at, h = words.grams(size)
                    hit = bloom.may_hold(held, h)
                    found.append((at[hit], np.full(int(hit.sum()), size), h[hit], h[hit]))
                starts, size, whash, fps = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(starts, kind="stable")
                starts, size, whash, fps = starts[order], size[order], whash[order], fps[order]
                text = words.text[starts]
                n = np.bincount(text, minlength=len(words.count))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(words.count.astype(np.int64)),
                        arrays.lists(fps.view(np.int64), n, pa.int64()),
                        arrays.lists((starts - words.first[text]).astype(np.int32), n, pa.int32()),
                        arrays.lists(size.astype(np.int32), n, pa.int32()),
                        arrays.lists(whash.view(np.int64), n, pa.int64()),
                    ],
                    names=["rid", "doc_id", "n_words", "fps", "starts", "sizes", "whashes"],
                )

    read = stored(rows.mapInArrow(find, schema), "fingerprints")
    candidates = read.where(F.size("fps") > 0).select("rid", F.inline(F.arrays_zip("fps", "starts", "sizes", "whashes")))
    windows = kept.select(F.col("size").alias("wsize"), F.col("whash").alias("of")).distinct()
    hits = (
        candidates.join(prints, candidates["fps"] == prints["fp"], "left_semi")
        .select("rid", F.col("starts").alias("start"), F.col("sizes").alias("size"), F.col("whashes").alias("whash"))
        .distinct()
    )
    hits = hits.join(windows, (hits["whash"] == windows["of"]) & (hits["size"] == windows["wsize"]), "left_semi")
    hits = stored(hits, "hits")
    spans = F.array_sort(F.collect_set(F.struct("start", "size")))
    reach = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["size"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(s["end"], x["start"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    covered = hits.groupBy("rid").agg(spans.alias("spans")).select(F.col("rid").alias("r1"), reach.cast("long").alias("n_hit"))
    of_item = kept.where(F.col("item_id").isNotNull()).select("item_id", F.col("size").alias("wsize"), F.col("whash").alias("of")).distinct()
    seen = hits.select("rid", "size", "whash").distinct()
    named = (
        seen.join(of_item, (seen["whash"] == of_item["of"]) & (seen["size"] == of_item["wsize"]))
        .groupBy("rid")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(F.col("rid").alias("r2"), "items")
    )
    return (
        read.select("rid", "doc_id", "n_words")
        .join(covered, F.col("rid") == F.col("r1"), "left")
        .join(named, F.col("rid") == F.col("r2"), "left")
        .select(
            "rid",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
    )
