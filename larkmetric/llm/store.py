"""Tables kept between jobs, row tags and column names that do not clash."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts lineage, so a lost executor costs no earlier work, and lets several
    later steps read one result.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


#: Bits of a row's number for its file and for its place in the file.
FILE_BITS, ROW_BITS = 40, 23
SEEDS = 4


def _file_hash(path: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), path).bitwiseAND(F.lit((1 << FILE_BITS) - 1))


def _row_number(docs: DataFrame) -> Column | None:
    """A number for each row from its file and its place there; None where rows do not come straight from Parquet files.

    It does not depend on how a scan is split, so it is the same in every scan, whatever executors there
    are. Files are told apart by a hash of their paths that is checked to differ for each.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        path, place = meta["file_path"], meta["row_index"]
        files = docs.select(path.alias("f"), place.alias("i")).groupBy("f").agg(F.max("i").alias("i"))
        files.schema  # asks whether there are such columns
    except AnalysisException:
        return None
    each = [F.count_distinct(_file_hash(F.col("f"), seed)).alias(f"s{seed}") for seed in range(SEEDS)]
    found = files.agg(F.count("*").alias("n"), F.max("i").alias("most"), *each).first()
    seed = next((seed for seed in range(SEEDS) if found[f"s{seed}"] == found["n"]), None)
    if seed is None or (found["most"] or 0) >= 1 << ROW_BITS:
        return None
    return F.shiftleft(_file_hash(path, seed), ROW_BITS).bitwiseOR(place)


def on_files(docs: DataFrame) -> DataFrame:
    """``docs`` itself where its rows come straight from Parquet files, else written once: rows that can be told apart in every scan."""
    if _row_number(docs) is not None:
        return docs
    path = f"{shared_dir(docs.sparkSession)}/rows-{uuid.uuid4().hex}"
    docs.write.option("compression", "zstd").option("maxRecordsPerFile", 1 << (ROW_BITS - 1)).parquet(path)
    return docs.sparkSession.read.schema(docs.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` from :func:`on_files` with a column that names each row, the same in every scan of these files."""
    number = _row_number(docs)
    if number is None:
        raise ValueError("rows must come straight from Parquet files: see on_files")
    return docs.withColumn(name, number)


def tagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid``, ``doc_id``, ``text`` of each row; a null text becomes empty.

    ``rid`` tells rows with the same id apart; see :func:`numbered`. Rows that do not come straight from Parquet
    files are written first.
    """
    docs = on_files(docs)
    rid = free_name(docs, "_rid")
    return numbered(docs, rid).select(
        F.col(rid).alias("rid"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def without_rows(docs: DataFrame, rids: DataFrame, name: str) -> DataFrame:
    """``docs``, all columns, less the rows that ``tagged`` gave one of ``rids``; ``docs`` are from :func:`on_files`.

    The rids are written first, so Spark knows their size before it picks the join.
    """
    rid = free_name(docs, "_rid")
    of = free_name(docs, f"{rid}_gone")
    gone = stored(rids.select(F.col("rid").alias(of)), name)
    return numbered(docs, rid).join(gone, F.col(rid) == F.col(of), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
