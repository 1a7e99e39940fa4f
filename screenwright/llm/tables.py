"""Reading the tables and small things that several operators need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType

from screenwright.storage import bounded_broadcast, materialize, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    held = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(held) if name in ("documents", "pages") else held


def _has_map(kind: DataType) -> bool:
    inner = [getattr(kind, "elementType", None), *[f.dataType for f in getattr(kind, "fields", [])]]
    return isinstance(kind, MapType) or any(_has_map(x) for x in inner if x is not None)


def without_maps(df: DataFrame) -> list[str]:
    """The columns that can be hashed and ordered: those that hold no map."""
    return [f.name for f in df.schema if not _has_map(f.dataType)]


def fingerprint(df: DataFrame, seed: int = 0) -> Column:
    """128 bits of a row's content as a struct: of every column, maps by their sorted entries; maps within other columns take no part."""
    columns = [F.col(f"`{c}`") for c in without_maps(df)]
    columns += [
        F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) for f in df.schema if isinstance(f.dataType, MapType) and not (
            _has_map(f.dataType.valueType) or _has_map(f.dataType.keyType)
        )
    ]
    return F.struct(F.xxhash64(F.lit(seed), *columns).alias("a"), F.xxhash64(F.lit(seed + 1), F.lit("b"), *columns).alias("b"))


#: Repeated rows are made again in runs of so many.
COPIES = 10_000


def with_copies(df: DataFrame, from_: int, keys: int = 1_000_000) -> DataFrame:
    """``df`` with ``_sw_copy``: 0, 1, ... among rows equal in every column, if there are ``from_`` of them or more; else 0.

    Numbered without a window: such rows are counted on the map side to one row
    each and made again from their number, in runs of bounded length.  Rows that
    only differ in maps within other columns are not told apart, so with such
    columns every row gets 0.
    """
    plain = df.withColumn("_sw_copy", F.lit(0).cast("long"))
    if any(_has_map(f.dataType) and not (isinstance(f.dataType, MapType) and not _has_map(f.dataType.valueType)) for f in df.schema):
        return plain
    own = [F.col(f"`{c}`") for c in df.columns]
    known = df.select(fingerprint(df).alias("_sw_f"))
    often = materialize(known.groupBy("_sw_f").agg(F.count("*").alias("_sw_n")).where(F.col("_sw_n") >= from_), "equal-rows")
    if often.isEmpty():
        return plain
    often = bounded_broadcast(often, keys)
    marked = df.withColumn("_sw_f", fingerprint(df))
    once = marked.join(often, "_sw_f", "left_anti").select(*own, F.lit(0).cast("long").alias("_sw_copy"))
    held = marked.join(often, "_sw_f", "left_semi").groupBy("_sw_f").agg(F.first(F.struct(*own)).alias("_sw_row"), F.count("*").alias("_sw_n"))
    runs = held.withColumn("_sw_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_sw_n - 1) div {COPIES}"))))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(n, "_sw_f", "_sw_run")
    last = F.least(F.col("_sw_n"), (F.col("_sw_run") + 1) * COPIES) - 1
    copies = runs.withColumn("_sw_copy", F.explode(F.sequence(F.col("_sw_run") * COPIES, last)))
    return once.unionByName(copies.select(*[F.col(f"_sw_row.`{c}`") for c in df.columns], "_sw_copy"))
