"""Identity repair (JOIN-12, JOIN-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_custom_id, is_uuid_like
from .firstrow import first_per_key
from .joins import hot_join


def use_alternate_id(df: DataFrame, id_col: str, alternates: list[str]) -> DataFrame:
    """A device-like id gives way to a custom id in an alternate column."""
    for alt in alternates:
        if alt in df.columns:
            swap = is_uuid_like(F.col(id_col)) & is_custom_id(F.col(alt))
            df = df.withColumn(id_col, F.when(swap, F.col(alt)).otherwise(F.col(id_col))).drop(alt)
    return df


def known_ids(df: DataFrame, device: str, id_col: str, order: list[str]) -> DataFrame:
    """One custom id per device: the one of the last row in ``order``.

    An aggregate, not a window, so a device with very many rows is combined
    before the shuffle.
    """
    custom = df.where(is_custom_id(F.col(id_col)) & F.col(device).isNotNull())
    return first_per_key(custom, [device], [*order, id_col], [id_col], last=True)


def map_ids(df: DataFrame, device: str, id_col: str, order: list[str]) -> DataFrame:
    """Give every row of a device the custom id found for it in the batch."""
    ids = known_ids(df, device, id_col, order).withColumnRenamed(id_col, "_known")
    return (
        hot_join(df, ids, device)
        .withColumn(id_col, F.coalesce("_known", id_col))
        .select(*df.columns)
    )


def device_owners(user_info: DataFrame) -> DataFrame:
    """One user per device id (the smallest when several are on record)."""
    return (
        user_info.where(F.contains("device_id", F.lit("-")))
        .groupBy("device_id")
        .agg(F.min("distinct_id").alias("owner_id"))
    )


def devices_to_users(df: DataFrame, user_info: DataFrame, id_col: str = "distinct_id") -> DataFrame:
    """Replace device ids by the user who owns the device; one hop.

    The rows are read once: those under no device id have no key in the join and
    are spread over its tasks.
    """
    device = F.when(is_uuid_like(F.col(id_col)), F.col(id_col))
    owners = device_owners(user_info).withColumnRenamed("device_id", "_device")
    return (
        hot_join(df.withColumn("_device", device), owners, "_device")
        .withColumn(id_col, F.coalesce("owner_id", id_col))
        .select(*df.columns)
    )
