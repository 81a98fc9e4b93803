"""Lifetime value as a stream of checkout files (STM-1)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LTV_COUNTS, LTV_VALUES, EventNames, LtvRules
from ..operators.identity import devices_to_users
from ..operators.ltv import contributions, sum_per_user
from ..session import SETTINGS
from ..sources.listing import list_files


def run_ltv_stream(
    checkouts: DataFrame,
    out: str,
    checkpoint: str,
    names: EventNames = EventNames(),
    rules: LtvRules = LtvRules(),
) -> None:
    """Take in what has arrived, and log the new sums of the users it touched.

    The running sums of all users are kept on disk by the RocksDB state store, which
    is set here. Each micro-batch replaces its own folder, so a batch run again after a
    failure leaves the same log.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    checkouts.sparkSession.conf.set(key, SETTINGS[key])
    sums = sum_per_user(contributions(checkouts, names, rules))

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        sums.writeStream.outputMode("update")
        .foreachBatch(log)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def compact_ltv(spark: SparkSession, out: str) -> None:
    """One folder with each user's newest sums in place of all batches up to now; nothing to do without a new batch.

    Batches it covers are ignored from then on and may be deleted, all of them too. Run it between
    streams. The folder is a new one each time, and counts only when a note of it is written
    last: a run that ends half-way, or is run again, changes nothing.
    """
    base = _base(spark, out)
    batches = _batches(spark, out)
    last = None if batches is None else batches.agg(F.max("batch")).first()[0]
    if last is None or (base and base[0] >= last):
        return
    name = f"upto={last}-{uuid.uuid4().hex}"
    _newest(_current(spark, out)).write.parquet(f"{_base_path(out)}/{name}")
    note = spark.createDataFrame([(last, name)], NOTE)
    note.coalesce(1).write.json(f"{_base_path(out)}/notes/{name}")


#: What tells that a base is whole: up to which batch, and its folder.
NOTE = "upto long, folder string"


def _base_path(out: str) -> str:
    return f"{out.rstrip('/')}-base"


def _base(spark: SparkSession, out: str) -> tuple[int, str] | None:
    """The newest whole base: the batch it goes up to, and its folder."""
    notes = list_files(spark, f"{_base_path(out)}/notes", r"[.]json$")
    if not notes:
        return None
    newest = spark.read.schema(NOTE).json(notes).agg(F.max(F.struct("upto", "folder"))).first()[0]
    return (newest["upto"], f"{_base_path(out)}/{newest['folder']}")


def _batches(spark: SparkSession, out: str) -> DataFrame | None:
    """The log's batches; None when there are none, or none any more."""
    if not list_files(spark, out, r"/batch=\d+/[^/]*[.]parquet$"):
        return None
    return spark.read.parquet(out)


def _current(spark: SparkSession, out: str) -> DataFrame:
    """The newest base, if there is one, and the batches after it."""
    base, batches = _base(spark, out), _batches(spark, out)
    if base is None and batches is None:
        raise LookupError(f"no batch in {out}")
    if base is None:
        return batches
    rows = spark.read.parquet(base[1]).withColumn("batch", F.lit(base[0]))
    return rows if batches is None else rows.unionByName(batches.where(F.col("batch") > base[0]))


def _newest(rows: DataFrame) -> DataFrame:
    names = [*LTV_COUNTS, *LTV_VALUES]
    newest = rows.groupBy("distinct_id").agg(F.max_by(F.struct(*names), "batch").alias("s"))
    return newest.select("distinct_id", *[F.col(f"s.{c}").alias(c) for c in names])


def read_ltv(spark: SparkSession, out: str, user_info: DataFrame) -> DataFrame:
    """The state the log describes, with device ids given to their users.

    A running sum cannot change its key, so devices are mapped on reading.
    """
    return sum_per_user(devices_to_users(_newest(_current(spark, out)), user_info))
