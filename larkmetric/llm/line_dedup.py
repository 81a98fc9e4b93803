"""Line de-duplication by pairwise alignment (operator 9)."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays, bloom
from larkmetric.llm.store import free_name, numbered, on_files, stored, tagged

#: A line of fewer bytes is no evidence alone, as unrelated documents share it by chance, but with those after it.
MIN_LINE_BYTES = 32
#: Aligned blocks of fewer bytes stay.
MIN_BLOCK_BYTES = 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9, 11, 12, 13]] = True


def _lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and size of each line without the white space around it, and the lines of each text."""
    breaks = np.flatnonzero(data == 10)
    n = np.diff(np.searchsorted(breaks, bounds)) + 1
    of = np.repeat(np.arange(len(n)), n)
    # Lines in the order of their texts; an empty text is one empty line.
    first = np.cumsum(n) - n
    starts = np.empty(len(of), dtype=np.int64)
    starts[first] = bounds[:-1]
    rest = np.ones(len(of), dtype=bool)
    rest[first] = False
    starts[rest] = breaks + 1
    last = np.append(first[1:] - 1, len(of) - 1)
    ends = np.empty(len(of), dtype=np.int64)
    ends[:-1] = starts[1:] - 1
    ends[last] = bounds[1:]
    inky = ~BLANK[data] & (data != 10)
    inked, ink = np.append(0, np.cumsum(inky)), np.flatnonzero(inky)
    low, high = inked[starts], inked[ends]
    some = high > low
    begin, end = starts.copy(), starts.copy()
    begin[some], end[some] = ink[low[some]], ink[high[some] - 1] + 1
    return arrays.span_hashes(arrays.BYTE_VALUE[data], begin, end), end - begin, n


def _evidence(
    hashes: np.ndarray, sizes: np.ndarray, n: np.ndarray, min_line_bytes: int, min_block_bytes: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines of ``min_line_bytes``, and of the shortest runs of ``min_block_bytes`` from each other line on.

    Also their number in each text. Any block of ``min_block_bytes`` has one of them within it.
    """
    upto = np.append(0, np.cumsum(sizes))
    alone = sizes >= min_line_bytes
    start = np.arange(len(sizes))
    end = np.where(alone, start + 1, np.searchsorted(upto, upto[:-1] + min_block_bytes))
    # A run that begins with a blank line holds no more than the one after it.
    of = np.repeat(np.arange(len(n)), n)
    some = np.flatnonzero((alone | (sizes > 0)) & (end <= np.cumsum(n)[of]))
    return arrays.span_hashes(hashes, start[some], end[some]), np.bincount(of[some], minlength=len(n))


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that increases on both sides; ``pairs`` are sorted by the first."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        tails[k : k + 1] = [j]
        at[k : k + 1] = [i]
        back[i] = at[k - 1] if k else -1
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(pairs[i])
        i = back[i]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of equal lines of ``a`` and ``b``.

    Common lines at both ends match; lines that occur once on either side are
    aligned along their longest increasing chain; what lies between goes the same
    way. Where no line occurs once, the rarest common one is tried.
    """
    found: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {h: i for i, h in enumerate(a[a0:a1], a0) if in_a[h] == 1 and in_b.get(h) == 1}
        anchors = _increasing(sorted((place[h], j) for j, h in enumerate(b[b0:b1], b0) if h in place))
        if not anchors:
            common = [h for h in in_a if h in in_b]
            if not common:
                continue
            rarest = min(common, key=lambda h: (in_a[h] + in_b[h], h))
            anchors = [(a.index(rarest, a0, a1), b.index(rarest, b0, b1))]
        i, j = a0, b0
        for p, q in anchors:
            found.append((p, q))
            work.append((i, p, j, q))
            i, j = p + 1, q + 1
        work.append((i, a1, j, b1))
    return sorted(found)


def common_blocks(a: list[int], b: list[int], sizes: list[int], least: int) -> list[int]:
    """Lines of ``b`` in aligned blocks, without a gap on either side, of at least ``least`` bytes."""
    out: list[int] = []
    block: list[int] = []
    before = (-2, -2)
    for p, q in [*patience(a, b), (-1, -1)]:
        if block and (p, q) != (before[0] + 1, before[1] + 1):
            if sum(sizes[k] for k in block) >= least:
                out += block
            block = []
        block.append(q)
        before = (p, q)
    return out


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_line_bytes: int = MIN_LINE_BYTES,
    min_block_bytes: int = MIN_BLOCK_BYTES,
) -> DataFrame:
    """``rid``, ``lines``: for rows that lose some, the numbers from 0 of the lines that go.

    Of two rows the one with the smaller id (null last), then the first in the
    scan, is the earlier. Lines are equal when they are without white space
    around them. Each line of at least ``min_line_bytes``, long enough to be rare,
    pairs a row with the first row that holds it, and so does each run of lines
    that begins with a shorter one and goes on until it has ``min_block_bytes``:
    each gives one partner, however many rows share it, and a line in a third of
    all rows gives one pair a row. Pairs are aligned by patience diff over whole
    texts; a block that only other holders have in the same order stays. Null and
    empty texts have no such line.
    """
    rows = tagged(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                h, size, n = _lines(data, bounds)
                keys, n_keys = _evidence(h, size, n, min_line_bytes, min_block_bytes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        arrays.lists(h.view(np.int64), n, pa.int64()),
                        arrays.lists(size.astype(np.int32), n, pa.int32()),
                        arrays.lists(keys.view(np.int64), n_keys, pa.int64()),
                    ],
                    names=["rid", "doc_id", "hashes", "sizes", "keys"],
                )

    fields = f"rid long, doc_id {kind}, hashes array<long>, sizes array<int>, keys array<long>"
    held = stored(rows.mapInArrow(make, fields), "lines")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "rid")
    each = held.select(order.alias("row"), F.explode(F.array_distinct("keys")).alias("h"))
    homes = each.groupBy("h").agg(F.min("row").alias("home"), F.count("*").alias("n")).where("n > 1")
    # Joined on expressions: both sides get a shuffle of their own, so AQE can split a hot line.
    homes = homes.select(F.bitwise_not("h").alias("of"), "home")
    pairs = (
        each.join(homes, F.bitwise_not(each["h"]) == homes["of"])
        .where(F.col("row.rid") != F.col("home.rid"))
        .select(F.col("home.rid").alias("earlier"), F.col("row.rid").alias("later"))
        .distinct()
    )
    first = held.select(F.col("rid").alias("r1"), F.col("hashes").alias("a"))
    second = held.select(F.col("rid").alias("r2"), F.col("hashes").alias("b"), "sizes")
    pairs = pairs.join(first, pairs["earlier"] == first["r1"]).select("later", "a")
    pairs = pairs.join(second, pairs["later"] == second["r2"]).select("later", "a", "b", "sizes")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            later, gone = [], []
            for rid, a, b, sizes in zip(*(batch.column(i) for i in range(4))):
                found = common_blocks(a.as_py(), b.as_py(), sizes.as_py(), min_block_bytes)
                if found:
                    later.append(rid.as_py())
                    gone.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(later, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["rid", "gone"]
            )

    aligned = pairs.mapInArrow(align, "rid long, gone array<int>")
    return aligned.groupBy("rid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("lines"))


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_line_bytes: int = MIN_LINE_BYTES,
    min_block_bytes: int = MIN_BLOCK_BYTES,
) -> tuple[DataFrame, str, str]:
    """``docs`` with what is left of each text, and the names of two columns more: lines it had, lines it lost.

    Rows keep all their columns, whatever their names; a null text stays null.
    """
    docs = on_files(docs)
    rid, of, mark, lost, had = (free_name(docs, x) for x in ("_rid", "_rid_of", "_touched", "_lost", "_had"))
    gone = stored(repeated_lines(docs, id_col, text_col, min_line_bytes, min_block_bytes), "gone")
    gone = gone.select(F.col("rid").alias(of), F.col("lines").alias(lost))
    touched = bloom.among(gone.select(F.col(of).alias("rid")))
    rows = numbered(docs, rid)
    rows = rows.withColumn(mark, touched(F.col(rid)))
    # Most rows lose nothing and do not move.
    whole = rows.where(~F.col(mark)).select(*docs.columns, F.lit(None).cast("array<int>").alias(lost))
    cut = rows.where(F.col(mark)).hint("merge").join(gone, F.col(rid) == F.col(of), "left")
    joined = whole.unionByName(cut.select(*docs.columns, lost))
    lines = F.split(F.col(text_col).cast("string"), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col(lost), i)), "\n")
    out = joined.select(
        *[F.when(F.col(lost).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.when(lines.isNull(), 0).otherwise(F.size(lines)).alias(had),
        F.when(F.col(lost).isNull(), 0).otherwise(F.size(F.col(lost))).alias(lost),
    )
    return out, had, lost
