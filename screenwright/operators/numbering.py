"""Gapless numbers in a global or per-group order, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenwright.storage import materialize


def numbered(df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "n") -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the order of ``order`` within each value of ``by``.

    Rows are range-partitioned by (by, order), written once, numbered within
    their partition and shifted by the counts of earlier partitions.  A group may
    span many partitions, but only the first group of a partition can have begun
    before it, so the shifts are a row for each partition at most.
    """
    by = by or []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *by, *order).withColumn("_p", F.spark_partition_id())
    held = materialize(ranged, "ranged")
    counts = held.groupBy("_p", *by).agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("_p").alias("_q"), *[F.col(f"`{c}`").alias(f"_b{i}") for i, c in enumerate(by)],
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s")
    )
    own = held.withColumn("_r", F.row_number().over(Window.partitionBy("_p", *by).orderBy(*order)))
    on = F.col("_p") == F.col("_q")
    for i, c in enumerate(by):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"_b{i}"))
    out = own.join(F.broadcast(shifts.where("_s > 0")), on, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.coalesce("_s", F.lit(0)) + F.col("_r")).alias(name))
