"""Best-fit packing planned on the histogram of lengths (operator 7)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkmetric.llm import arrays, pretokens
from larkmetric.llm.store import stored, tagged

CAPACITY = 1024
END = 2


def cut(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """``rid``, ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and the ``ids`` themselves.

    A row's ids are the tokenizer's, then ``end``; a null or empty text is
    ``end`` alone. Of more than ``capacity`` ids, the first piece has what is left
    over from whole ones.
    """
    rows = tagged(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holder = pretokens.pieces(path)
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                starts = pretokens.split(data, bounds, holder.special)
                ends, keys = pretokens.hashes(data, starts)
                keys, one, back = np.unique(keys, return_index=True, return_inverse=True)
                at = holder.look_up(keys, data.tobytes(), starts[one], ends[one])
                counts = holder.count[at][back]
                n = np.bincount(pretokens.text_of(starts, bounds), weights=counts, minlength=part.num_rows).astype(np.int64)
                ids = np.insert(holder.ids[arrays.ragged(holder.start[at][back], counts)], np.cumsum(n), np.uint32(end))
                n += 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = arrays.ragged(np.zeros(len(n), np.int64), pieces)
                first = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                held = ids.astype("<u4").tobytes()
                place = ((np.cumsum(n) - n)[doc] + start).tolist()
                crc = [zlib.crc32(held[4 * i : 4 * (i + k)]) for i, k in zip(place, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc)),
                        part.column(1).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crc, pa.int64()),
                        arrays.lists(ids.astype(np.int32), length, pa.int32()),
                    ],
                    names=["rid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return rows.mapInArrow(
        make, f"rid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids array<int>"
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows of ``length``, ``low``, ``high``, ``first``, ``offset``.

    The pieces of ``length`` with rank ``low <= rank < high`` go into sequences
    ``first + rank - low``, each at ``offset``. Sequences filled alike are one kind, and a
    kind is split only where pieces of a length end within it, so the rows are
    bounded by the number of lengths, not by that of documents.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[list[int]]] = {}  # by what is left: [first sequence, number of sequences]
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            fit = next((r for r in range(length, capacity + 1) if room.get(r)), None)
            if fit is None:
                n = -(-left // (capacity // length))
                room.setdefault(capacity, []).append([opened, n])
                opened += n
                continue
            first, n = room[fit].pop()
            # A sequence that took one is the tightest for the next: each takes as many as it can.
            each = min(fit // length, left)
            full = min(n, left // each)
            if full < n:
                room[fit].append([first + full, n - full])
            for i in range(each):
                rows.append((length, rank, rank + full, first, capacity - fit + i * length))
                rank += full
            left -= each * full
            room.setdefault(fit - each * length, []).append([first, full])
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``rid``, ``piece``, ``length`` (1 to ``capacity``).

    Only the histogram, at most ``capacity`` counts, reaches the driver, and only
    the plan, bounded by ``capacity`` too, goes back to all tasks. A piece's rank
    within its length comes from its rank in a bucket of that length and the
    counts of the buckets before, so no length meets in one task.
    """
    spark = pieces.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("rid", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity), "_length long, _low long, _high long, _first long, _offset long"
    )
    before = counts.select(
        F.col("length").alias("_of"),
        F.col("_bucket").alias("_b"),
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"),
    )
    within = Window.partitionBy("length", "_bucket").orderBy("rid", "piece")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("_of")) & (F.col("_bucket") == F.col("_b")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    return ranked.join(
        F.broadcast(slots),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")),
    ).select(
        *pieces.columns,
        (F.col("_first") + F.col("_rank") - F.col("_low")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def packed(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """Every row's pieces with their place in a sequence; without the ids, which ``cut`` gives again."""
    return pack(stored(cut(docs, path, id_col, text_col, capacity, end).drop("ids"), "pieces"), capacity)
