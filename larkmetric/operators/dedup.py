"""Event de-duplication (AGG-21, AGG-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows that hardly repeat are made distinct in at least so many tasks.
LEAST_WAYS = 200


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per event and collected id: a group's ids are its rows.

    NULLs count as equal, and an event without an id is kept once. Rows are combined
    before one shuffle whose key is the whole row, so a group with very many
    ids is spread over all tasks and its shape depends on nothing but the rows.
    """
    return df.dropDuplicates()


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def spread_distinct(df: DataFrame) -> DataFrame:
    """Distinct rows, grouped in as many tasks as the session has shuffle partitions, and in ``LEAST_WAYS`` at least.

    Each task has two hash tables of its rows, which in a session of few partitions would be large. For rows that hardly repeat. AQE would join partitions up to a size in compressed bytes: narrow rows
    take few there, and many times that in the hash table of one task. Combining before the shuffle would
    keep a second table of them all, beside the sorts of the join they come from.
    """
    ways = max(LEAST_WAYS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    places = [f"_{i}" for i in range(len(df.columns))]  # names may come twice
    return df.toDF(*places).repartition(ways, *places).distinct().toDF(*df.columns)
