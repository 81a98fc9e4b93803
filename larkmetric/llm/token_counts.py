"""Token counts from pre-token frequencies (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays, pretokens
from larkmetric.llm.store import tagged

BLOCK_BYTES = 3 << 20
FREQUENCIES = "bucket int, block long, n_docs int, lengths binary, words binary, n_docs_of binary, docs binary, counts binary"
SUMS = "block long, docs binary, sums binary"


def _pack(values: np.ndarray) -> bytes:
    """Four bytes a value, first all low bytes: these compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(held: bytes) -> np.ndarray:
    planes = np.frombuffer(held, np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(planes).view("<u4").ravel().astype(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch whose rows follow each other in one file."""
    rid = batch.column(0).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(rid) != 1) + 1).tolist(), len(rid)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield from arrays.chunks(batch.slice(low, high - low), BLOCK_BYTES)


def _frequencies(rows: DataFrame, special: tuple[bytes, ...], buckets: int) -> DataFrame:
    """Per block of documents and bucket of pre-tokens: each pre-token, and in which documents it is how often.

    A pre-token's bucket comes from its hash. One that is in an eighth of a
    block's documents is dealt by block too, so no bucket gets all of a very
    frequent pre-token's rows.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in _blocks(batch):
                block, n = part.column(0)[0].as_py(), part.num_rows
                starts = pretokens.split(data, bounds, special)
                if not len(starts):
                    continue
                ends, keys = pretokens.hashes(data, starts)
                text = pretokens.text_of(starts, bounds)
                order = np.lexsort((text, keys))
                keys, text = keys[order], text[order]
                new = np.ones(len(keys), dtype=bool)
                new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                counts = np.diff(np.append(at, len(keys)))
                docs, word_keys, one = text[at], keys[at], order[at]
                word = np.ones(len(at), dtype=bool)
                word[1:] = word_keys[1:] != word_keys[:-1]
                word_at = np.flatnonzero(word)
                n_docs_of = np.diff(np.append(word_at, len(at)))
                word_keys = word_keys[word_at]
                begin, length = starts[one[word_at]], (ends - starts)[one[word_at]]
                spread = arrays.mix(np.array([block], np.int64).view(np.uint64))[0]
                frequent = (n_docs_of * 8 >= n) & (n >= 64)
                bucket = ((word_keys + np.where(frequent, spread, np.uint64(0))) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cuts)):
                    mine = by[cuts[b] : cuts[b + 1]]
                    posts = arrays.ragged(word_at[mine], n_docs_of[mine])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": pa.array([b], pa.int32()),
                            "block": pa.array([block], pa.int64()),
                            "n_docs": pa.array([n], pa.int32()),
                            "lengths": [_pack(length[mine])],
                            "words": [data[arrays.ragged(begin[mine], length[mine])].tobytes()],
                            "n_docs_of": [_pack(n_docs_of[mine])],
                            "docs": [_pack(docs[posts])],
                            "counts": [_pack(counts[posts])],
                        }
                    )

    return rows.mapInArrow(make, FREQUENCIES)


def _count(path: str, hold: int = 4_000_000):
    """Counts each distinct pre-token of a bucket once and adds up what it gives to each document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holder = pretokens.Pieces(path)
        sums: dict[int, np.ndarray] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block, total in sums.items():
                docs = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int64()), "docs": [_pack(docs)], "sums": [_pack(total[docs])]}
                )
            sums.clear()

        for batch in batches:
            for row in batch.to_pylist():
                ends = np.cumsum(_unpack(row["lengths"]))
                data = np.frombuffer(row["words"], np.uint8)
                starts = np.append(0, ends[:-1])
                keys = arrays.span_hashes(arrays.BYTE_VALUE[data], starts, ends)
                order = np.argsort(keys)
                at = holder.look_up(keys[order], row["words"], starts[order], ends[order])
                n = np.empty(len(keys), np.int64)
                n[order] = holder.count[at]
                weight = np.repeat(n, _unpack(row["n_docs_of"])) * _unpack(row["counts"])
                total = sums.get(row["block"])
                if total is None:
                    total = sums[row["block"]] = np.zeros(row["n_docs"], np.int64)
                    size += row["n_docs"]
                np.add.at(total, _unpack(row["docs"]), weight)
            if size > hold:
                yield from flush()
                size = 0
        yield from flush()

    return make


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of sorted blocks."""
    now, docs, sums = None, [], []

    def whole() -> pa.RecordBatch:
        at, total = np.concatenate(docs), np.concatenate(sums)
        added = np.bincount(at, weights=total).astype(np.int64)
        some = np.flatnonzero(added)
        return pa.RecordBatch.from_arrays([pa.array(now + some), pa.array(added[some])], names=["of", "n"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != now and docs:
                yield whole()
                docs, sums = [], []
            now = row["block"]
            docs.append(_unpack(row["docs"]))
            sums.append(_unpack(row["sums"]))
    if docs:
        yield whole()


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid``, ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` of every row under the byte-level BPE file at ``path``.

    Counts what the library gives without added special tokens; special strings
    in a text are tokens, its default. Null and empty texts have none.

    Each block of documents gives its pre-tokens' frequencies per document,
    packed and dealt by pre-token; a bucket's distinct pre-tokens are counted
    once and joined to the frequencies there. No id is ever made for a document.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tagged(docs, id_col, text_col)
    special = pretokens.Pieces(path).special
    counted = (
        _frequencies(rows, special, buckets)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_count(path), SUMS)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_add_up, "of long, n long")
    )
    sizes = rows.select("rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(counted, sizes["rid"] == counted["of"], "left").select(
        "rid", "doc_id", "n_bytes", F.coalesce("n", F.lit(0)).alias("n_tokens")
    )
