"""Runs, the files that they list, and whether a scan has covered them.

Frames: runs (run, status, lists), where ``lists`` says that the run's summary
names its files; listed (run, path, rows, bytes, sha256) with paths inside the
run; present (path, bytes) of what lies under the folder.  Paths are relative
and use slashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINISHED = "finished"
COUNTS = ("rows_read", "rows_with_text", "rows_without_text", "findings")


def proper_path(path: Column) -> Column:
    """Relative, without empty, ``.`` or ``..`` steps."""
    steps = F.split(path, "/")
    return F.coalesce((F.length(path) > 0) & ~F.exists(steps, lambda s: s.isin("", ".", "..")), F.lit(False))


def ancestors(path: Column) -> Column:
    """The folders that hold a path, the nearest last."""
    steps = F.split(path, "/")
    return F.when(
        F.size(steps) > 1, F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    ).otherwise(F.array().cast("array<string>"))


def with_owner(files: DataFrame, runs: DataFrame, path: str = "path") -> DataFrame:
    """``files`` with ``owner``, the nearest run whose folder holds the path, or null; an equi-join on the path's folders."""
    each = files.select(F.col(path).alias("_p")).distinct().select("_p", F.posexplode(ancestors(F.col("_p"))).alias("_n", "run"))
    owner = each.join(runs.select("run").distinct(), "run").groupBy("_p").agg(F.max_by("run", "_n").alias("owner"))
    return files.join(owner, files[path].eqNullSafe(owner["_p"]), "left").drop("_p")


def unfinished(status: Column, lists: Column) -> Column:
    """Why a run is left out, or null."""
    return F.when(~status.eqNullSafe(FINISHED), F.lit("not finished")).when(~F.coalesce(lists, F.lit(False)), F.lit("lists no files"))


def selection(runs: DataFrame, listed: DataFrame) -> DataFrame:
    """(path, run, rows, bytes, sha256): the files of finished runs that list them, paths from the folder's root."""
    good = runs.where(unfinished(F.col("status"), F.col("lists")).isNull()).select("run")
    return listed.join(good, "run", "left_semi").select(F.concat_ws("/", "run", "path").alias("path"), "run", "rows", "bytes", "sha256")


def skipped(runs: DataFrame, listed: DataFrame, present: DataFrame) -> DataFrame:
    """(kind, path, reason): runs left out as a whole, and files that no finished run lists (those inside runs left out go with them)."""
    why = unfinished(F.col("status"), F.col("lists"))
    whole = runs.select(F.lit("run").alias("kind"), F.col("run").alias("path"), why.alias("reason")).where("reason is not null")
    strays = with_owner(present.join(selection(runs, listed).select("path"), "path", "left_anti"), runs)
    strays = strays.join(runs.select(F.col("run").alias("owner"), why.alias("_why")), "owner", "left")
    reason = F.when(F.col("owner").isNull(), F.lit("outside of runs")).when(F.col("_why").isNull(), F.lit("not listed by its run"))
    return whole.union(strays.select(F.lit("file").alias("kind"), "path", reason.alias("reason")).where("reason is not null"))


def damaged(runs: DataFrame, listed: DataFrame, present: DataFrame) -> DataFrame:
    """(path, problem) of listed files of finished runs that can't be trusted: must be empty before a scan."""
    good = runs.where(unfinished(F.col("status"), F.col("lists")).isNull()).select("run")
    held = listed.join(good, "run", "left_semi").withColumn("full", F.concat_ws("/", "run", "path"))
    twice = held.groupBy("full").agg(F.count("*").alias("_n"))
    there = present.select(F.col("path").alias("full"), F.col("bytes").alias("_size"))
    bad = (
        F.when(~proper_path(F.col("path")) | ~F.col("path").endswith(".jsonl"), F.lit("not a path inside the run"))
        .when(F.col("_n") > 1, F.lit("listed twice"))
        .when(~F.coalesce((F.col("rows") >= 0) & (F.col("bytes") >= 0) & F.col("sha256").rlike(r"^[0-9a-f]{64}\z"), F.lit(False)), F.lit("no proper counts"))
        .when(F.col("_size").isNull(), F.lit("missing"))
        .when(F.col("_size") != F.col("bytes"), F.lit("another size"))
    )
    return held.join(twice, "full").join(there, "full", "left").select(
        F.col("full").alias("path"), bad.alias("problem")
    ).where("problem is not null").distinct()


def problems(files: DataFrame, read: DataFrame, open_files: DataFrame | None = None) -> DataFrame:
    """(run, path, problem): where a scan's record differs from the selected files.

    ``read`` has path, sha256 and COUNTS (null if it doesn't say); files of
    ``open_files`` (path), whose part of the scan hasn't ended, are left out.  A
    file that was read but not selected belongs to its nearest run.
    """
    if open_files is not None:
        files, read = (x.join(open_files.select("path"), "path", "left_anti") for x in (files, read))
    a = files.select("path", "run", F.col("rows").alias("_rows"), F.col("sha256").alias("_sha"))
    b = with_owner(read, files.select("run").distinct()).withColumn("_read", F.lit(True))
    both = a.join(b, "path", "full_outer")
    known = F.col("_read") & F.col("_sha").isNotNull()
    counted = F.lit(True)
    for c in COUNTS:
        counted = counted & F.col(c).isNotNull()
    found = F.array_compact(F.array(
        F.when(F.col("_read").isNull(), F.lit("not read")), F.when(F.col("_sha").isNull(), F.lit("no finished run lists it")),
        F.when(known & (F.col("_sha") != F.col("sha256")), F.lit("another sha256")), F.when(known & ~counted, F.lit("no row counts")),
        F.when(known & counted & (F.col("rows_read") != F.col("_rows")), F.lit("another number of rows")),
        F.when(known & counted & (F.col("rows_with_text") + F.col("rows_without_text") != F.col("rows_read")), F.lit("rows with and without text don't add up")),
    ))
    return both.select(F.coalesce("run", "owner").alias("run"), "path", F.explode(found).alias("problem"))


def per_run(files: DataFrame, read: DataFrame, found: DataFrame, open_files: DataFrame | None = None) -> DataFrame:
    """(run, status, files, files_read, COUNTS): a run fails if it has a problem, and every run if a problem has no run."""
    done = read if open_files is None else read.join(open_files.select("path"), "path", "left_anti")
    held = files.select("run", "path").join(done.select("path", *COUNTS).withColumn("_r", F.lit(1)), "path", "left")
    sums = held.groupBy("run").agg(F.count("*").alias("files"), F.count("_r").alias("files_read"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    bad = found.groupBy("run").agg(F.count("*").alias("_n"))
    everywhere = F.lit(not bad.where("run is null").isEmpty())
    out = sums.join(bad, "run", "left")
    return out.select(
        "run", F.when(everywhere | F.col("_n").isNotNull(), F.lit("fail")).otherwise(F.lit("pass")).alias("status"), "files", "files_read", *COUNTS
    )
