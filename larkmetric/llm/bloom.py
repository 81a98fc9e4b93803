"""Bloom filters of a fixed size, built by all tasks and merged by Spark.

A filter of ``BITS`` bits is 4 MiB whatever the data's size; that bound is what
lets it be collected and sent to all tasks. A fuller filter lets more rows
through, which later joins then settle: results do not depend on it. Keys are
64-bit hashes whose every part is well mixed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkmetric.llm.arrays import mix, release

BITS = 1 << 25
PROBES = 3
CHUNK_BITS = 1 << 18
SLICES = "chunk int, once binary, twice binary"


def probes(keys: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """The bits of each key; ``bits`` is a power of two."""
    return [((keys >> np.uint64(17 * i)) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


def may_hold(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter, as packed bytes, may hold each key. Never false for one that it holds."""
    found = np.ones(len(keys), dtype=bool)
    for at in probes(keys, len(filled) * 8):
        found &= (filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for chunk, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            once, twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
            if chunk not in held:
                held[chunk] = [once.copy(), twice.copy()]
            else:
                held[chunk][1] |= twice | (held[chunk][0] & once)
                held[chunk][0] |= once
    for chunk, (once, twice) in held.items():
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array([chunk], pa.int32()), "once": [once.tobytes()], "twice": [twice.tobytes()]}
        )


def build(keys: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two filters over the one long column ``keys``: bits set by any key, and by two or more rows.

    Each task fills its own filter and sends it on in slices; a slice is merged
    row by row where it arrives, and the merged ones, ``bits / 4`` bytes in
    all, go to the driver.
    """
    size = min(CHUNK_BITS, bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits, dtype=bool), np.zeros(bits, dtype=bool)
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            # A key's bits count once for the key, even where two of them coincide.
            at = np.sort(np.stack(probes(values, bits)), axis=0)
            own = np.ones(at.shape, dtype=bool)
            own[1:] = at[1:] != at[:-1]
            places, counts = np.unique(at[own], return_counts=True)
            twice[places[(counts > 1) | once[places]]] = True
            once[places] = True
        for chunk in range(bits // size):
            part = slice(chunk * size, (chunk + 1) * size)
            if once[part].any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([chunk], pa.int32()),
                        "once": [np.packbits(once[part], bitorder="little").tobytes()],
                        "twice": [np.packbits(twice[part], bitorder="little").tobytes()],
                    }
                )
        del once, twice
        release()

    merged = keys.mapInArrow(fill, SLICES).repartition("chunk").mapInArrow(_merge, SLICES)
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        part = slice(row.chunk * size // 8, (row.chunk + 1) * size // 8)
        once[part] = np.frombuffer(row.once, np.uint8)
        twice[part] = np.frombuffer(row.twice, np.uint8)
    return once, twice


def among(rows: DataFrame, bits: int = BITS >> 1) -> Callable[[Column], Column]:
    """A test for ``rid`` columns: false only for rids that ``rows`` does not have.

    Lets rows that a join does not concern pass it by.
    """

    def key(rid: np.ndarray) -> np.ndarray:
        return mix(rid.view(np.uint64) + np.uint64(1))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = np.unique(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(key(rid).view(np.int64))], names=["key"])

    once, _ = build(rows.select("rid").mapInArrow(hashed, "key long"), bits)

    @F.arrow_udf("boolean")
    def test(rid: pa.Array) -> pa.Array:
        return pa.array(may_hold(once, key(rid.to_numpy(zero_copy_only=False))))

    return test
