"""Removal of repeated long byte strings with suffix sorting (operator 1).

A string of ``LENGTH`` bytes is found by its anchor, the smallest hash of
``GRAM`` bytes within it. Equal strings have equal anchors at the same offset, so
only suffixes and prefixes around anchors with one hash have to be sorted, and
an anchor stands for the run of all strings that chose it, some 35 of them.

Equal strings also agree in ``SIDE`` bytes before the anchor or ``SIDE`` bytes
behind its hash, whichever lie within them. Anchors are compared only where
these agree too, and strings of which one surrounding is very frequent by a hash of
each whole string, so that no task gets all documents with one phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays, bloom, suffix_sort
from larkmetric.llm.store import stored, tagged

LENGTH = 100
GRAM = 32
PLACE_BITS = 30
#: Of a string, so many bytes before the anchor or behind its hash.
SIDE = (LENGTH - GRAM) // 2
#: Anchors of one surrounding beyond which their strings are settled one by one, by hash.
HOT = 20_000
#: Buckets are four times the shuffle partitions, within these numbers of bits.
LEAST_BUCKET_BITS, MOST_BUCKET_BITS = 8, 16
#: Texts whose anchors are sent on together.
BLOCK_BYTES = 4 << 20
NO_ID = (1 << 63) - 1
#: One row for each block of documents and bucket of anchor hashes.
RECORDS = "bucket int, block long, docs binary, rids binary, g binary, w binary, left binary, right binary, low binary, at binary, run binary, known binary"
FOUND = "rid long, doc long, low int, run int, at int, g long"
SPANS = "rid long, low int, high int"


def _planes(values: np.ndarray, width: int) -> bytes:
    """``width`` bytes of each value, first all low bytes: planes of zeros compress to nothing."""
    held = np.ascontiguousarray(values).astype("<i8", copy=False).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(held[:, :width].T).tobytes()


def _from_planes(held: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(held, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def _steps(values: np.ndarray) -> bytes:
    return _planes(np.diff(values, prepend=np.int64(0)), 8)


def _from_steps(held: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(held, 8))


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, first start, number of further starts, anchor's offset from the first, anchor hash, hashes of the run's bytes and of both sides."""
    n = len(data) - LENGTH + 1
    sizes = np.diff(bounds)
    if n < 1 or not (sizes >= LENGTH).any():
        return tuple(np.empty(0, np.int64) for _ in range(4)) + tuple(np.empty(0, np.uint64) for _ in range(4))
    values = arrays.BYTE_VALUE[data]
    places = np.arange(len(data) - GRAM + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values * arrays.powers(arrays.INVERSE, len(data)), dtype=np.uint64, out=sums[1:])
    power = arrays.powers(arrays.BASE, len(data) + 1)
    gram = arrays.mix((sums[GRAM:] - sums[:-GRAM]) * power[: len(places)])
    least = (gram & ~np.uint64((1 << PLACE_BITS) - 1)) | places.astype(np.uint64)
    # The smallest of ever longer windows, up to that of all grams within LENGTH bytes.
    reach, window = LENGTH - GRAM + 1, 1
    while window < reach:
        step = min(window, reach - window)
        least = np.minimum(least[:-step], least[step:])
        window += step
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    starts = np.arange(n)
    whole = np.zeros(n + 1, dtype=np.int32)
    long = sizes >= LENGTH
    np.add.at(whole, bounds[:-1][long], 1)
    np.add.at(whole, bounds[1:][long] - LENGTH + 1, -1)
    starts = starts[np.cumsum(whole[:n]) > 0]
    anchor = anchor[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    low = starts[first]
    run = np.diff(np.append(first, len(starts))) - 1
    at = anchor[first] - low
    end = low + run + LENGTH
    w = arrays.mix((sums[end] - sums[low]) * power[low] + at.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + run.astype(np.uint64))
    place = anchor[first]

    def side(begin: np.ndarray, there: np.ndarray) -> np.ndarray:
        begin = np.where(there, begin, 0)
        return np.where(there, arrays.mix((sums[begin + SIDE] - sums[begin]) * power[begin]) >> np.uint64(32), np.uint64(0))

    left, right = side(place - SIDE, _has_left(at)), side(place + GRAM, _has_right(at, run))
    return np.searchsorted(bounds, low, side="right") - 1, low, run, at, gram[place], w, left, right


def _has_left(at: np.ndarray) -> np.ndarray:
    """Whether some string of the run has ``SIDE`` bytes before the anchor."""
    return at >= SIDE


def _has_right(at: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether some string of the run has fewer, so more than ``SIDE`` bytes behind the anchor's hash."""
    return at - run < SIDE


def _records(rows: DataFrame, bits: int) -> DataFrame:
    """Anchors by block and one of ``2 ** bits`` buckets.

    Of a block's anchors with equal bytes around them only the first can be
    the first of all; the others' bytes are repeated whatever comes
    later, and are sent along as such. A passage in a third of all documents so
    sends a few anchors a block, not one a document.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, bounds in arrays.chunks(batch, BLOCK_BYTES):
                found, before = [], 0
                for few, data, own in arrays.chunks(part):
                    text, low, *rest = anchors(data, own)
                    found.append((text + before, low + bounds[before], *rest))
                    before += few.num_rows
                text, low, run, at, g, w, left, right = (np.concatenate(x) for x in zip(*found))
                if not len(text):
                    continue
                rid = part.column(0).to_numpy(zero_copy_only=False)[text]
                doc = part.column(1).to_numpy(zero_copy_only=False)[text]
                low = low - bounds[text]
                order = np.lexsort((low, rid, doc, w, g))
                same = np.zeros(len(order), dtype=bool)
                same[1:] = (g[order][1:] == g[order][:-1]) & (w[order][1:] == w[order][:-1])
                known = np.zeros(len(order), dtype=bool)
                known[order[same]] = True
                # Anchors are smallest hashes, so their high bits are alike; the low ones are not.
                bucket = (g & np.uint64((1 << bits) - 1)).astype(np.int64)
                g = g >> np.uint64(bits)
                by = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[by], np.arange((1 << bits) + 1))
                for b in np.flatnonzero(np.diff(cuts)):
                    mine = by[cuts[b] : cuts[b + 1]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([b], pa.int32()),
                            "block": pa.array([int(rid[0])], pa.int64()),
                            "docs": [_steps(doc[mine])],
                            "rids": [_steps(rid[mine])],
                            "g": [_planes(g[mine][~known[mine]].view(np.int64), 5)],
                            "w": [_planes(w[mine][~known[mine]].view(np.int64), 6)],
                            "left": [_planes(left[mine][~known[mine]].view(np.int64), 4)],
                            "right": [_planes(right[mine][~known[mine]].view(np.int64), 4)],
                            "low": [_planes(low[mine], 4)],
                            "at": [_planes(at[mine], 1)],
                            "run": [_planes(run[mine], 1)],
                            "known": [np.packbits(known[mine], bitorder="little").tobytes()],
                        }
                    )

    return rows.mapInArrow(make, RECORDS)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: strings known to be repeated (``g`` null), and first anchors that share a side with others.

    Anchors with equal hashes and equal bytes around them are one class; all of
    it but the first is repeated. Firsts of classes that agree under one hash on a side have to
    be compared further, in the strings that hold this side; ``g`` is then the hash of both.
    """

    def settle(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        parts = []
        for row in rows:
            low = _from_planes(row["low"], 4)
            known = np.unpackbits(np.frombuffer(row["known"], np.uint8), bitorder="little")[: len(low)].astype(bool)
            hashes = [np.zeros(len(low), np.int64) for _ in range(4)]
            for h, (name, width) in zip(hashes, (("g", 5), ("w", 6), ("left", 4), ("right", 4))):
                h[~known] = _from_planes(row[name], width)
            place = (_from_planes(row[name], 1) for name in ("run", "at"))
            parts.append((_from_steps(row["docs"]), _from_steps(row["rids"]), low, *place, *hashes, known))
        doc, rid, low, run, at, g, w, left, right, known = (np.concatenate(x) for x in zip(*parts))
        yield _found(rid[known], doc[known], low[known], run[known], at[known], None)
        order = np.flatnonzero(~known)
        order = order[np.lexsort((low[order], rid[order], doc[order], w[order], g[order]))]
        doc, rid, low, run, at, g, w, left, right = (x[order] for x in (doc, rid, low, run, at, g, w, left, right))
        new_g = np.ones(len(g), dtype=bool)
        new_g[1:] = g[1:] != g[:-1]
        new_w = new_g.copy()
        new_w[1:] |= w[1:] != w[:-1]
        again = ~new_w
        yield _found(rid[again], doc[again], low[again], run[again], at[again], None)
        bucket = np.uint64(rows[0]["bucket"])
        for of, there, which in ((left, _has_left(at), 1), (right, _has_right(at, run), 2)):
            on = np.flatnonzero(new_w & there)
            g2 = arrays.mix(arrays.mix(g[on].view(np.uint64) << np.uint64(16) | bucket) ^ (of[on].view(np.uint64) << np.uint64(2) | np.uint64(which)))
            _, back, n = np.unique(g2, return_inverse=True, return_counts=True)
            on, g2 = on[n[back] > 1], g2[n[back] > 1]
            # Of the run, the strings that hold this side.
            skip = np.zeros(len(on), np.int64) if which == 1 else np.maximum(0, at[on] - SIDE + 1)
            last = np.minimum(run[on], at[on] - SIDE) if which == 1 else run[on]
            yield _found(rid[on], doc[on], low[on] + skip, last - skip, at[on] - skip, g2.view(np.int64))

    yield from _by_bucket(batches, "bucket", settle)


def _by_bucket(batches: Iterator[pa.RecordBatch], key: str, settle) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield from settle(held)
                held = []
            held.append(row)
    if held:
        yield from settle(held)
    del held
    arrays.release()


def _found(rid, doc, low, run, at, g) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rid, pa.int64()),
            pa.array(doc, pa.int64()),
            pa.array(low.astype(np.int32)),
            pa.array(run.astype(np.int32)),
            pa.array(at.astype(np.int32)),
            pa.nulls(len(rid), pa.int64()) if g is None else pa.array(g, pa.int64()),
        ],
        names=["rid", "doc", "low", "run", "at", "g"],
    )


def _contexts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` with ``bytes``: those of all the run's strings."""
    per_row = asked.groupBy(F.col("rid").alias("of")).agg(
        F.collect_list(F.struct("doc", "low", "run", "at", "g")).alias("asked")
    )
    joined = rows.hint("merge").join(per_row, rows["rid"] == per_row["of"]).select("rid", "asked", "text")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, texts = batch.column(1), batch.column(2)
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            data, bounds = arrays.flat(texts)
            of = np.repeat(np.arange(len(n)), n)
            items = lists.flatten()
            columns = [items.field(i) for i in range(5)]
            low, run = (columns[i].to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            begin, size = bounds[of] + low, run + LENGTH
            for part in np.array_split(np.arange(len(of)), max(1, int(size.sum()) >> 22)):
                ends = np.zeros(len(part) + 1, dtype=np.int32)
                np.cumsum(size[part], out=ends[1:])
                held = data[arrays.ragged(begin[part], size[part])]
                ctx = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(held)])
                pick = pa.array(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of[part])), *[c.take(pick) for c in columns], ctx],
                    names=["rid", "doc", "low", "run", "at", "g", "bytes"],
                )

    return joined.mapInArrow(take, "rid long, doc long, low int, run int, at int, g long, bytes binary")


def _repeats(g: np.ndarray, order_of: np.ndarray, low: np.ndarray, run: np.ndarray, at: np.ndarray, held: list[bytes]):
    """Rows and starts of strings that an earlier anchor of the same hash has too.

    Suffixes from the anchor and reversed prefixes before it are sorted. Two
    strings with their anchor at one offset are equal if neither order has a
    shorter common prefix between them than what lies on that side.
    """
    group = np.unique(g, return_inverse=True)[1]
    n = len(g)
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, LENGTH - GRAM), np.uint8)
    n_right, n_left = np.minimum(run + LENGTH - at, LENGTH), at
    for i, (ctx, k) in enumerate(zip(held, at.tolist())):
        after = np.frombuffer(ctx, np.uint8, offset=k)[:LENGTH]
        right[i, : len(after)] = after
        left[i, :k] = np.frombuffer(ctx, np.uint8)[:k][::-1]
    # All share the anchor's bytes: what is sorted begins behind them.
    by_right, lcp_right = suffix_sort.sort(group, right[:, GRAM:], n_right - GRAM)
    lcp_right = np.where(lcp_right < 0, -1, lcp_right + GRAM)
    by_left, lcp_left = suffix_sort.sort(group, left, n_left)
    rows, starts = [], []
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(LENGTH - GRAM + 1):
        on = np.flatnonzero((at >= offset) & (at - run <= offset))
        if len(on) < 2:
            continue
        right_class[by_right] = np.cumsum(lcp_right < LENGTH - offset)
        left_class[by_left] = np.cumsum(lcp_left < offset)
        by = on[np.lexsort((order_of[on], left_class[on], right_class[on]))]
        again = (right_class[by][1:] == right_class[by][:-1]) & (left_class[by][1:] == left_class[by][:-1])
        rows.append(by[1:][again])
        starts.append(low[rows[-1]] + at[rows[-1]] - offset)
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(starts)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated strings of anchors sorted by hash; a hash's anchors stay together."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        rid, doc, low, run, at, g = (table[c].to_numpy().astype(np.int64) for c in ("rid", "doc", "low", "run", "at", "g"))
        order_of = np.empty(len(g), np.int64)
        order_of[np.lexsort((low, rid, doc))] = np.arange(len(g))
        rows, starts = _repeats(g, order_of, low, run, at, table["bytes"].to_pylist())
        by = np.lexsort((starts, rows))
        rows, starts = rows[by], starts[by]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(rows)) - 1 if len(first) else first
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rid[rows[first]]),
                pa.array(starts[first].astype(np.int32)),
                pa.array((starts[last] + LENGTH).astype(np.int32)),
            ],
            names=["rid", "low", "high"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        g = batch.column(batch.schema.get_field_index("g")).to_numpy()
        if g[0] == g[-1] or sum(b.num_rows for b in held) < 40_000:
            continue
        cut = int(np.searchsorted(g, g[-1]))
        yield settle(pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]))
        held = [batch.slice(cut)]
    if held:
        yield settle(pa.Table.from_batches(held))
    del held
    arrays.release()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of the anchors, by two hashes of its bytes and its anchor's offset."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rid, doc, low, run, at, g = (batch.column(i).to_numpy().astype(np.int64) for i in range(6))
        data, bounds = arrays.flat(batch.column(6))
        of = np.repeat(np.arange(len(run)), run + 1)
        k = arrays.ragged(np.zeros(len(run), np.int64), run + 1)
        begin = bounds[of] + k
        h = arrays.span_hashes(arrays.BYTE_VALUE[data], begin, begin + LENGTH)
        second = arrays.mix(g[of].view(np.uint64) + (at[of] - k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rid[of]), pa.array(doc[of]), pa.array((low[of] + k).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(second.view(np.int64))],
            names=["rid", "doc", "low", "h", "h2"],
        )
    arrays.release()


def _settled_by_hash(contexts: DataFrame) -> DataFrame:
    """Spans of all strings but the first of equal ones, for anchors of very frequent surroundings.

    Firsts are found with a sum before the shuffle, and a join that AQE can split gives them back.
    """
    strings = stored(contexts.mapInArrow(_strings, "rid long, doc long, low int, h long, h2 long"), "strings")
    firsts = strings.groupBy("h", "h2").agg(F.min(F.struct("doc", "rid", "low")).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select(F.bitwise_not("h").alias("of"), F.bitwise_not("h2").alias("of2"), "first")
    same = (F.bitwise_not(strings["h"]) == firsts["of"]) & (F.bitwise_not(strings["h2"]) == firsts["of2"])
    again = strings.join(firsts, same).where(F.struct("doc", "rid", "low") != F.col("first"))
    return again.select("rid", "low", (F.col("low") + LENGTH).alias("high"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (``rid``, ``doc``, ``text``), and ``rid``, ``low``, ``high`` of byte spans that are repeated."""
    rows = tagged(docs, id_col, text_col).select("rid", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    spark = docs.sparkSession
    wanted_buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(MOST_BUCKET_BITS, max(LEAST_BUCKET_BITS, (wanted_buckets - 1).bit_length()))
    found = stored(
        _records(rows, bits).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_classes, FOUND), "anchors"
    )
    asked = found.where("g IS NOT NULL")
    wanted = bloom.among(asked)
    contexts = stored(_contexts(rows.where(wanted(F.col("rid"))), asked), "contexts")
    frequent = contexts.groupBy("g").count().where(F.col("count") > HOT).select(F.bitwise_not("g").alias("of"))
    frequent = stored(frequent, "frequent")
    is_hot = F.bitwise_not(contexts["g"]) == frequent["of"]
    cold = contexts.join(frequent, is_hot, "left_anti")
    compared = cold.repartition("g").sortWithinPartitions("g").mapInArrow(_compare, SPANS)
    by_hash = _settled_by_hash(contexts.join(frequent, is_hot, "left_semi"))
    whole = found.where("g IS NULL").select("rid", "low", (F.col("low") + F.col("run") + LENGTH).alias("high"))
    return rows, stored(whole.unionByName(compared).unionByName(by_hash), "spans")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (byte ``low``, ``high``) and ``kept`` (binary) of every row.

    Each byte goes that a string of ``LENGTH`` bytes covers which also starts
    earlier: in a row with a smaller id, or earlier in the same one. Ids are
    integers; rows without one come last, and of rows with equal ids the first in the scan is the
    earlier. Null texts are empty; shorter ones than ``LENGTH`` stay whole.
    ``kept`` may be no valid UTF-8, as spans may cut characters.
    """
    rows, spans = repeated_spans(docs, id_col, text_col)
    merged = spans.groupBy(F.col("rid").alias("of")).agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"))
    touched = bloom.among(spans)
    kind = docs.schema[id_col].dataType.simpleString()
    named = rows.withColumn("touched", touched(F.col("rid")))
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias("doc_id")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    plain = named.where("NOT touched").select(
        doc_id,
        size,
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<low:int,high:int>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    cut = named.where("touched").select("rid", doc_id, size, "text").hint("merge")
    cut = cut.join(merged, F.col("rid") == F.col("of"), "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                out = []
                for doc, low, high, found in zip(
                    part.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), part.column(3).to_pylist()
                ):
                    text = data[low:high].tobytes()
                    union: list[list[int]] = []
                    for span in found or []:
                        if union and span["low"] <= union[-1][1]:
                            union[-1][1] = max(union[-1][1], span["high"])
                        else:
                            union.append([span["low"], span["high"]])
                    edges = [0, *(x for span in union for x in span), len(text)]
                    kept = b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2]))
                    spans = [{"low": i, "high": j} for i, j in union]
                    out.append((doc, len(text), len(text) - len(kept), spans, kept))
                kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), SPAN_LIST, pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
                )

    fields = f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<low:int,high:int>>, kept binary"
    return plain.unionByName(cut.select("doc_id", "n_bytes", "text", "spans").mapInArrow(remove, fields))


SPAN_LIST = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
