"""Total orders without a single-partition window: ranges and global row numbers (L1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import cut_lineage

BEFORE = (Window.unboundedPreceding, -1)
THROUGH = (Window.unboundedPreceding, Window.currentRow)


def ranged(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``_pid``, a range number that rises with ``order``.

    Range bounds come from a sample that Spark draws anew for every exchange, so two plans
    over the same data can be cut differently. The rows are therefore checkpointed with
    their range number: whatever reads the result sees one and the same assignment."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (which must be total).

    Each range numbers its own rows and a table of per-range counts (one row per range —
    a proven bound, broadcast) supplies the offsets. ``Window.orderBy`` without a
    partition would pull every row through one task."""
    rows = ranged(df, order, partitions)
    local = rows.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pn"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_pn").over(
        Window.orderBy("_pid").rowsBetween(*BEFORE)), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_pid", "_lrn", "_off"))
