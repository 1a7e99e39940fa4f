"""Which file, chunk or unit things go to, and which rows are looked at."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwright.operators.numbering import numbered


def balanced(files: DataFrame, shards: int) -> DataFrame:
    """(path, bytes, shard): whole files dealt to shards, the largest first, each to the lightest shard (the first of equals).

    The list of files (path, bytes) is a manifest: the driver holds a name and a
    size for each, never their contents.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = files.sparkSession
    heap = [(0, k) for k in range(shards)]
    out = []
    for path, size in sorted(files.select("path", "bytes").collect(), key=lambda r: (-r[1], r[0])):
        total, k = heapq.heappop(heap)
        out.append((path, size, k))
        heapq.heappush(heap, (total + size, k))
    return spark.createDataFrame(out, "path string, bytes long, shard int")


def dealt(files: DataFrame, chunks: int, order: list[str]) -> DataFrame:
    """``files`` with ``chunk``: file *i* of the order goes to chunk ``i mod chunks``."""
    return numbered(files, order, name="_n").withColumn("chunk", ((F.col("_n") - 1) % chunks).cast("int")).drop("_n")


def parts(rows: DataFrame, lines_per_part: int, chunks: int, file: str = "source_file", line: str = "source_line") -> DataFrame:
    """``rows`` with ``part`` (runs of lines of a file, from 0) and ``chunk`` (part mod chunks); ``line`` counts from 1 without gaps."""
    part = F.expr(f"(`{line}` - 1) div {lines_per_part}")
    return rows.withColumn("part", part).withColumn("chunk", (part % chunks).cast("int"))


def first_rows(rows: DataFrame, order: list[str], n: int) -> tuple[DataFrame, int]:
    """The first ``n`` rows of an order, and how many are left out."""
    return rows.orderBy(*order).limit(n), max(0, rows.count() - n)


def window_of(rows: DataFrame, order: list[str], start: int, n: int) -> DataFrame:
    """``n`` rows from position ``start`` (from 0) of an order, without gathering those before."""
    held = numbered(rows, order, name="_n")
    return held.where((F.col("_n") > start) & (F.col("_n") <= start + n)).drop("_n")


def seeded(key: Column, seed: int) -> Column:
    """A sort key that puts rows in an order that only ``seed`` and the key decide."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"), 256)


def shuffled(rows: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """``rows`` with their position (from 1) in a seeded order, by range partitions."""
    return numbered(rows.withColumn("_sw_seeded", seeded(F.col(key), seed)), ["_sw_seeded", key], name=name).drop("_sw_seeded")


def first_of_each(rows: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps k rows a group on the map side already."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= k).drop("_k")


def units(lines: DataFrame, target: int, file: str = "source_file", line: str = "source_line", size: str = "bytes") -> DataFrame:
    """(file, unit, start_line, end_line, bytes): runs of whole lines that begin in the same ``target`` bytes of their file.

    A line belongs to the stretch in which its first byte lies, as with input
    splits, so units come from offsets alone (prefix sums by range partitions)
    and hold about ``target`` bytes, or one longer line.
    """
    held = numbered(lines.select(file, line, size), [line], [file], "_n")
    chunk = F.expr("_n div 4096")
    sums = held.groupBy(file, chunk.alias("_c")).agg(F.sum(size).alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(file).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col(file).alias("_f"), "_c", before.alias("_before"))
    run = F.coalesce(F.sum(size).over(Window.partitionBy(file, "_c").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = held.withColumn("_c", chunk).withColumn("_run", run)
    placed = placed.join(sums, placed[file].eqNullSafe(sums["_f"]) & (placed["_c"] == sums["_c"])).withColumn("unit", F.expr(f"(_before + _run) div {target}"))
    return placed.groupBy(file, "unit").agg(F.min(line).alias("start_line"), F.max(line).alias("end_line"), F.sum(size).alias("bytes"))
