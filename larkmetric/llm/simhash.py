"""Near-duplicates by SimHash and multi-index hashing (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays
from larkmetric.llm.graph import components
from larkmetric.llm.store import stored, tagged

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Bits of each segment of a fingerprint. Segments of about log2(rows) bits give
#: buckets of about one fingerprint.
SEGMENTS = (22, 21, 21)
#: Buckets of more fingerprints are searched breadth-first.
SMALL = 64
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
#: For each byte, its bits as eight counters of one byte each.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64).ravel()


def _fingerprints(data: np.ndarray, bounds: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    starts, ends, first = arrays.word_spans(~WHITE[data], bounds)
    n_words = np.diff(first)
    # The words of all texts, one space after each.
    lengths = ends - starts
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=at[1:])
    joined = np.full(at[-1], 32, dtype=np.uint8)
    joined[arrays.ragged(at[:-1], lengths)] = arrays.LOWER[data[arrays.ragged(starts, lengths)]]
    held, digest = joined.tobytes(), xxhash.xxh64_intdigest
    counts = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    from_word = arrays.ragged(first[:-1], counts)
    size = np.repeat(np.minimum(n_words, shingle), counts)
    begin, end = at[from_word].tolist(), (at[from_word + size] - 1).tolist()
    hashes = np.fromiter((digest(held[i:j], seed) for i, j in zip(begin, end)), np.uint64, len(begin))
    # Counters of a byte hold up to 255 hashes: sum blocks of so many, then blocks.
    blocks = -(-counts // 255)
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    if len(hashes):
        some = np.flatnonzero(counts)
        text_start = np.cumsum(counts) - counts
        block_start = np.repeat(text_start, blocks) + 255 * arrays.ragged(np.zeros(len(counts), np.int64), blocks)
        sums = np.add.reduceat(SPREAD[hashes.view(np.uint8).reshape(-1, 8)], block_start, axis=0)
        sums = np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64)
        ones[some] = np.add.reduceat(sums, (np.cumsum(blocks) - blocks)[some], axis=0, dtype=np.int64)
    bits = 2 * ones > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``rid``, ``doc_id``, ``fp`` (64 bits as a long) of every row.

    A-Z are lower-cased and words are what stands between white space. Bit i is
    1 if over half of the shingles' XXH64 hashes, repeats included, have it. A
    text of fewer words is one shingle; one without words, or null, has 0.
    """
    rows = tagged(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                fp = pa.array(_fingerprints(data, bounds, shingle, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), fp], names=["rid", "doc_id", "fp"])

    return rows.mapInArrow(make, f"rid long, doc_id {kind}, fp long")


def _index(fps: DataFrame, segments: tuple[int, ...], radii: list[int]) -> DataFrame:
    """``key``, ``own``, ``fp``: each fingerprint under its own segments' values and under those in the balls around them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            low = 0
            for i, (width, radius) in enumerate(zip(segments, radii)):
                value = (fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1)
                value = value.astype(np.int64) | (i << 40)
                for flip in [0, *((1 << b for b in range(width)) if radius else ())]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value ^ flip), pa.array(np.full(len(fp), flip == 0)), pa.array(fp)],
                        names=["key", "own", "fp"],
                    )
                low += width

    return fps.mapInArrow(emit, "key long, own boolean, fp long")


class _Forest:
    """Keeps links that connect what was not connected yet."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def keep(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.up[p] = q
                kept.append((x, y))
        return kept


def _search(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one bucket; found members are not compared again."""
    rest, a, b = np.unique(members), [], []
    queue: list[int] = []
    while len(rest):
        if not queue:
            queue.append(rest[0])
            rest = rest[1:]
        x = queue.pop()
        near = np.bitwise_count(rest ^ x) <= distance
        if near.any():
            found = rest[near]
            a.append(np.full(len(found), x))
            b.append(found)
            queue.extend(found)
            rest = rest[~near]
    none = np.empty(0, np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _linked(key: np.ndarray, own: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links within the buckets of sorted ``key``."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    start, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
    size = end - start
    owned = np.add.reduceat(own.astype(np.int64), start)
    a, b = [], []
    for i in np.flatnonzero((size > SMALL) & (owned > 0)):
        x, y = _search(fp[start[i] : end[i]], distance)
        a.append(x)
        b.append(y)
    bucket = np.repeat(np.arange(len(size)), size)
    small = np.flatnonzero(own & (size[bucket] > 1) & (size[bucket] <= SMALL))
    for part in np.array_split(small, max(1, len(small) * SMALL >> 21)):
        at = bucket[part]
        left, right = fp[np.repeat(part, size[at])], fp[arrays.ragged(start[at], size[at])]
        near = (np.bitwise_count(left ^ right) <= distance) & (left != right)
        a.append(left[near])
        b.append(right[near])
    return _Forest().keep(np.concatenate(a), np.concatenate(b)) if a else []


def links(fps: DataFrame, distance: int = DISTANCE, segments: tuple[int, ...] = SEGMENTS) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints ``fp`` that connect all with up to ``distance`` differing bits.

    Of ``m`` segments, with ``distance = m * r + rest``, one of the first ``rest + 1``
    differs in at most ``r`` bits or one of the others in at most ``r - 1``. Balls of
    radius ``r`` are listed on the probing side; whole distances are then
    verified within a bucket. Of a bucket's links a spanning forest is kept, so
    a large group of near copies gives no more links than it has members.
    """
    if sum(segments) != 64 or not 0 <= distance < 2 * len(segments):
        raise ValueError("segments must fill 64 bits, and the distance be under twice their number")
    r, rest = divmod(distance, len(segments))
    radii = [r if i <= rest else r - 1 for i in range(len(segments))]
    used = [i for i, radius in enumerate(radii) if radius >= 0]
    index = _index(fps.select("fp"), segments[: len(used)], radii[: len(used)])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def rows(found: list[tuple[int, int]]) -> pa.RecordBatch:
            both = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        def join() -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate(x) for x in zip(*held))

        for batch in batches:
            if not batch.num_rows:
                continue
            key, own, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held.append((key, own, fp.view(np.uint64)))
            # The last bucket may go on in the next batch.
            if key[0] == key[-1] or sum(len(x[0]) for x in held) < 200_000:
                continue
            key, own, fp = join()
            cut = int(np.searchsorted(key, key[-1]))
            held = [(key[cut:], own[cut:], fp[cut:])]
            if cut:
                yield rows(_linked(key[:cut], own[:cut], fp[:cut], distance))
        if held:
            yield rows(_linked(*join(), distance))

    return index.repartition("key").sortWithinPartitions("key").mapInArrow(pairs, "a long, b long").distinct()


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: tuple[int, ...] = SEGMENTS,
) -> DataFrame:
    """``rid``, ``doc_id``, ``fp``, ``component_id``, ``root`` of every row.

    Rows are linked where their fingerprints differ in at most ``distance``
    bits; ``component_id`` is the smallest id that links reach (null if no row
    there has an id), ``root`` its smallest fingerprint. Equal fingerprints are one
    node, whatever their number.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(nodes, distance, segments))
    labelled = stored(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "simhash-roots",
    )
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of_root")
    named = labelled.join(least, labelled["root"] == least["of_root"])
    named = named.select(F.col("fp").alias("of"), "component_id", "root")
    return marked.join(named, marked["fp"] == named["of"]).select("rid", "doc_id", "fp", "component_id", "root")


def repeated(groups: DataFrame) -> DataFrame:
    """``rid`` of all rows of ``near_groups`` but one in each group: the smallest id's, null last, then the first."""
    best = groups.groupBy(F.col("root").alias("of")).agg(
        F.min(F.struct(F.isnull("doc_id"), "doc_id", "rid")).alias("best"), F.count("*").alias("n")
    )
    several = best.where("n > 1").select(F.bitwise_not("of").alias("of"), F.col("best.rid").alias("stays"))
    return groups.join(several, F.bitwise_not(groups["root"]) == several["of"]).where("rid != stays").select("rid")
