"""Writers: JSONL, exact chunk layouts, byte-preserving partitions, summaries."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwright.operators.numbering import numbered


def write_jsonl(rows: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """One JSON object per line, UTF-8 as it stands, nulls left out."""
    out = rows.write.option("compression", "none")
    (out.option("maxRecordsPerFile", rows_per_file) if rows_per_file else out).json(path)


def write_chunks(rows: DataFrame, path: str, order: list[str], rows_per_file: int, chunks: int) -> None:
    """Batch *i* of ``rows_per_file`` rows in ``chunk=<i mod chunks>/batch=<i>``: the layout doesn't depend on partitions."""
    held = numbered(rows, order, name="_n").withColumn("batch", F.expr(f"(_n - 1) div {rows_per_file}")).withColumn("chunk", F.col("batch") % chunks)
    held.repartition("chunk", "batch").sortWithinPartitions("chunk", "batch", "_n").drop("_n").write.partitionBy("chunk", "batch").json(path)


def write_lines(lines: DataFrame, path: str, by: str = "source_file", order: tuple[str, ...] = ("source_file", "source_line")) -> None:
    """Lines as they were (``raw`` without its line end), a folder per source file, in order."""
    text = F.regexp_replace(F.col("raw").cast("string"), r"\n\z", "")
    out = lines.select(F.col(by).alias("file"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], text.alias("value"))
    out.repartitionByRange(
        *[f"_o{i}" for i in range(len(order))]
    ).sortWithinPartitions(*[f"_o{i}" for i in range(len(order))]).select("file", "value").write.partitionBy("file").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header, UTF-8 as it stands; line ends within a value stay, quoted."""
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def write_partition(lines: DataFrame, gone: DataFrame, path: str, key: tuple[str, ...] = ("source_file", "source_line")) -> None:
    """Both sides of a decision, byte for byte: lines (``raw`` and the key) under ``path``/filtered, those of ``gone`` under ``path``/filtered_out."""
    keys = list(key)
    which = gone.select(*keys).distinct()
    write_lines(lines.join(which, keys, "left_anti"), f"{path}/filtered", keys[0], key)
    write_lines(lines.join(which, keys, "left_semi"), f"{path}/filtered_out", keys[0], key)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, raw) of lines that ``write_lines`` has written."""
    return spark.read.option("lineSep", "\n").option("basePath", path).text(path).select(
        F.col("file").cast("string").alias("source_file"), F.col("value").alias("raw")
    )


def write_filter_run(decided: DataFrame, path: str, text: str = "text") -> None:
    """A filter's result under ``path``: kept rows, the line map (where each kept row came from) and removed rows with their reasons.

    ``decided`` has the location, its fingerprint, ``reasons`` and the text.  Kept
    rows are numbered anew, gapless within each file.
    """
    from screenwright.storage import materialize

    held = materialize(decided, "decided")
    at = ["source_file", "source_line"]
    kept = numbered(held.where(F.size("reasons") == 0), ["source_line"], ["source_file"], "line")
    kept.select(F.col("source_file").alias("file"), "line", text).write.parquet(f"{path}/kept")
    kept.select("source_file", "line", "source_line", "source_sha256").write.parquet(f"{path}/line_map")
    held.where(F.size("reasons") > 0).select(*at, "source_sha256", "reasons").write.parquet(f"{path}/removed")


def check_filter_run(spark: SparkSession, path: str, decided: DataFrame, text: str = "text") -> DataFrame:
    """(source_file, kept, removed, problems): the run read again and held against the decisions; problems must be 0."""
    kept, lines, removed = (spark.read.parquet(f"{path}/{n}") for n in ("kept", "line_map", "removed"))
    back = kept.withColumnRenamed("file", "source_file").join(lines, ["source_file", "line"], "full_outer")
    back = back.select(
        "source_file", "source_line", F.lit(True).alias("_kept"),
        F.col("source_sha256").eqNullSafe(F.sha2(F.col(text).cast("binary"), 256)).alias("_same")
    )
    out = removed.select("source_file", "source_line", F.lit(False).alias("_kept"), F.lit(True).alias("_same"))
    all_ = back.union(out).groupBy("source_file", "source_line").agg(F.count("*").alias("_n"), F.first("_kept").alias("_kept"), F.min("_same").alias("_same"))
    want = decided.select("source_file", "source_line", (F.size("reasons") == 0).alias("_want"))
    both = want.join(all_, ["source_file", "source_line"], "full_outer")
    fine = F.coalesce((F.col("_n") == 1) & F.col("_same") & (F.col("_kept") == F.col("_want")), F.lit(False))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return both.groupBy("source_file").agg(n(F.col("_kept")).alias("kept"), n(~F.col("_kept")).alias("removed"), n(~fine).alias("problems"))


def write_summary(spark: SparkSession, path: str, summary: dict, marker: bool = False) -> None:
    """A summary as one JSON file, written under another name and renamed over the old one, through the file system that holds it.

    The rename replaces the target in one step, so a crash leaves the old
    summary or the new one.  With ``marker`` an empty ``_SUCCESS`` beside it goes
    before the summary changes and comes back last.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target, temporary = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    fs = target.getFileSystem(conf)
    done = hadoop.Path(target.getParent(), "_SUCCESS")
    if marker:
        fs.delete(done, False)
    stream = fs.create(temporary, True)
    stream.write(bytearray(json.dumps(summary, ensure_ascii=False, sort_keys=True, indent=1).encode()))
    stream.close()
    rename = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    rename[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(temporary), fs.makeQualified(target), rename)
    if marker:
        fs.create(done, True).close()


def resume(rows: DataFrame, done: DataFrame, key: list[str], good: str | None = None) -> DataFrame:
    """The rows that earlier results don't cover; ``good`` is a SQL condition on results that count (say, those without an error)."""
    return rows.join((done.where(good) if good else done).select(*key).distinct(), key, "left_anti")


def with_row_key(rows: DataFrame, fields: list[str], name: str = "row_key") -> DataFrame:
    """``rows`` with the SHA-256 of some fields: the key of a resume cache, which a changed row doesn't hit."""
    from screenwright.functions.text import row_key

    return rows.withColumn(name, row_key(*[F.col(f) for f in fields]))
