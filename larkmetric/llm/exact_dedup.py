"""Exact de-duplication with two passes over Bloom filters (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import bloom
from larkmetric.llm.store import stored

SPACE = r"[\x20\x09-\x0D]"


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ignore: str = SPACE, bits: int = bloom.BITS
) -> DataFrame:
    """The group of equal texts that each row is in, and the row that stays.

    Texts are equal when identical after removal of what matches ``ignore``; a
    null text is an empty one. The row with most code points stays, then the
    smallest id (null last), then the first in the scan, so that of rows equal
    in all one stays. Returns ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256`` for every row; an empty table gives none.

    The first pass adds all hashes to a filter that also notes bits set twice.
    The second finds rows whose hash may be repeated; only those shuffle. A
    group with a third of all rows is summed before its shuffle, and AQE splits
    it in the join that gives its rows their result.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    hashed = stored(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            docs[id_col].alias("doc_id"),
            F.length(text).alias("n"),
            F.sha2(F.regexp_replace(text, ignore, ""), 256).alias("sha"),
        ).withColumn("key", F.xxhash64("sha")),
        "exact",
    )
    _, repeated = bloom.build(hashed.select("key"), bits)
    schema = hashed.drop("key").schema.add("again", "boolean")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            again = pa.array(bloom.may_hold(repeated, keys))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], again], names=[*batch.schema.names[:4], "again"])

    marked = hashed.mapInArrow(mark, schema)
    single = marked.where("not again").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    several = marked.where("again")
    groups = several.groupBy("sha").agg(
        F.min(F.struct(-F.col("n"), F.isnull("doc_id"), "doc_id", "rid")).alias("best"),
        F.count("*").alias("group_size"),
    )
    # An expression as key: the groups get a shuffle of their own, so AQE can split the rows' side.
    groups = groups.select(F.concat(F.lit(""), "sha").alias("of"), "best", "group_size")
    return single.unionByName(
        several.join(groups, several["sha"] == groups["of"]).select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("rid") == F.col("best.rid")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )
