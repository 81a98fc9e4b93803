"""Which rows a model may learn from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def held_out(id_col: Column, folds: int, held: int) -> Column:
    """Rows of fold ``held``. A row without an id is not held out, and not learned from either."""
    return F.coalesce(fold(id_col, folds) == held, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held: int,
    max_rows: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``y``, ``text`` and ``extra`` of about ``max_rows`` labelled rows outside fold ``held``.

    Rows are taken by a hash of their id, so they are the same on each run.
    Null labels are left out; of several labels of a document the largest
    counts. The sample's ids and labels are bounded by ``max_rows`` (a few
    more by chance), which is why they may be broadcast: texts without a label
    do not move.
    """
    known = (
        labels.where(F.col(label).isNotNull() & (fold(F.col(id_col), folds) != held))
        .groupBy(F.col(id_col).alias("of"))
        .agg((F.max(label) > 0).cast("int").alias("y"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.where((F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) & F.col("of").isNotNull())
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    rows = docs.select(docs[id_col].alias("doc_id"), text, *[docs[c] for c in extra])
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).drop("of")
