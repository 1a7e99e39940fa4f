"""Joining, comparing and merging the results of several stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines in a bucket of a range join.
BUCKET_LINES = 4096


def _null_safe(a: DataFrame, b: DataFrame, key: list[str], suffix: str) -> Column:
    on = F.lit(True)
    for c in key:
        on = on & a[c].eqNullSafe(b[f"{c}{suffix}"])
    return on


def differences(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """(key..., status): keys that only one side has, ``missing`` or ``unexpected``; no rows if the key sets are equal.

    Null keys are keys; a key that a side has twice is reported as ``repeated``.
    """
    a = expected.groupBy(*key).agg(F.count("*").alias("_e")).withColumn("_a", F.lit(0).cast("long"))
    b = actual.groupBy(*key).agg(F.lit(0).cast("long").alias("_e"), F.count("*").alias("_a"))
    both = a.unionByName(b).groupBy(*key).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    status = F.when(F.col("_a") == 0, F.lit("missing")).when(F.col("_e") == 0, F.lit("unexpected")).when(
        (F.col("_a") > 1) | (F.col("_e") > 1), F.lit("repeated")
    )
    return both.select(*key, status.alias("status")).where("status is not null")


def agreed(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """``actual``, or an error if the key sets differ."""
    n = {r.status: r["count"] for r in differences(expected, actual, key).groupBy("status").count().collect()}
    if n:
        raise ValueError(f"the stages don't cover the same keys: {n}")
    return actual


def in_scope(rows: DataFrame, units: DataFrame, file: str = "source_file", line: str = "source_line") -> DataFrame:
    """The rows that some unit (file, start_line, end_line; both ends included) covers.

    A range join by buckets of lines: a unit is a row for each bucket that it
    touches, so the join is an equi-join and never a product.
    """
    spans = units.select(F.col("file").alias("_f"), "start_line", "end_line").where("start_line <= end_line")
    spans = spans.withColumn("_b", F.explode(F.sequence(F.expr(f"start_line div {BUCKET_LINES}"), F.expr(f"end_line div {BUCKET_LINES}"))))
    held = rows.withColumn("_b", F.expr(f"`{line}` div {BUCKET_LINES}"))
    on = (held[file] == spans["_f"]) & (held["_b"] == spans["_b"]) & F.col(line).between(F.col("start_line"), F.col("end_line"))
    return held.join(spans, on, "left_semi").drop("_b")


def hydrated(samples: DataFrame, results: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """``samples`` with ``fields`` of the result of the same key, null keys alike; a sample without a result stops the run."""
    one = results.groupBy(*[F.col(k).alias(f"{k}_r") for k in key]).agg(F.min(F.struct(*fields)).alias("_r"))
    out = samples.join(one, _null_safe(samples, one, key, "_r"), "left")
    found = F.when(F.col("_r").isNotNull(), F.col("_r")).otherwise(F.raise_error(F.lit("a sample has no result")).cast(one.schema["_r"].dataType))
    return out.withColumn("_r", found).select(*[samples[c] for c in samples.columns], *[F.col(f"_r.{c}").alias(c) for c in fields])


def three_way(samples: DataFrame, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of three results side by side, by a key that all must have once."""
    agreed(samples.select(key), left.select(key), [key])
    agreed(samples.select(key), right.select(key), [key])
    return samples.join(left, key).join(right, key)


def general_action(safety: Column) -> Column:
    """KEEP_GENERAL, NOT_GENERAL or REVIEW for a guard's verdict."""
    return F.when(safety == "Safe", F.lit("KEEP_GENERAL")).when(safety.isin("Controversial", "Unsafe"), F.lit("NOT_GENERAL")).otherwise(F.lit("REVIEW"))


def merged(units: DataFrame, group: list[str], sums: list[str]) -> DataFrame:
    """Totals of the units' counts by group."""
    return units.groupBy(*group).agg(F.count("*").alias("n_units"), *[F.sum(c).alias(c) for c in sums])


def unit_rows(units: DataFrame) -> DataFrame:
    """(source_file, rows_expected, rows_covered, whole): whether units (source_file, start_line, end_line) cover each file without gap or overlap."""
    per = units.groupBy("source_file").agg(F.max("end_line").alias("rows_expected"), F.sum(F.col("end_line") - F.col("start_line") + 1).alias("rows_covered"))
    return per.withColumn("whole", F.col("rows_expected") == F.col("rows_covered"))


def candidates(found: DataFrame, fields: list[str]) -> DataFrame:
    """Findings of all units, each once: repeats by the SHA-256 of ``fields`` go, the earliest unit's stays."""
    key = F.sha2(F.concat_ws("\x00", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]).cast("binary"), 256)
    rest = [c for c in found.columns if c not in fields]
    return found.withColumn("candidate", key).groupBy("candidate", *fields).agg(F.min(F.struct(*rest)).alias("_r")).select(
        "candidate", *fields, *[F.col(f"_r.{c}").alias(c) for c in rest]
    )


def guard_counts(flagged: Column, lines: Column, records: Column, judged: Column, errors: Column, unknown: Column) -> Column:
    """What doesn't add up between the flagged messages and the judged ones: empty if every message was judged."""
    return F.array_compact(F.array(
        F.when(lines != flagged, F.lit("flagged lines")), F.when(records != flagged, F.lit("records read")), F.when(judged + errors + unknown != flagged, F.lit("verdicts, errors and unknown")),
    ))


def probe_summary(results: DataFrame) -> DataFrame:
    """(category, rows, trials, trial_errors, error_rows, partial_error_rows, regurgitated, not_regurgitated), ``TOTAL`` over all.

    ``results`` has category, decision, status, trial_count and error_count.
    """
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    hit = F.coalesce(F.col("decision") == "regurgitated", F.lit(False))
    out = results.cube("category").agg(
        F.grouping("category").alias("_g"), F.count("*").alias("rows"), F.coalesce(F.sum("trial_count"), F.lit(0)).alias("trials"), F.coalesce(F.sum("error_count"), F.lit(0)).alias("trial_errors"),
        n(F.col("status") == "error").alias("error_rows"), n(F.col("status") == "partial_error").alias("partial_error_rows"), n(hit).alias("regurgitated"), n(~hit).alias("not_regurgitated"),
    )
    return out.withColumn("category", F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("category"))).drop("_g")
