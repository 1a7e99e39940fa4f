"""Row decisions out of confirmed findings, and the order of removal stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_class(toxicity: Column, pii: Column) -> Column:
    """error > both > pii > toxicity > kept; ``toxicity`` is an outcome, ``pii`` a boolean."""
    bad = toxicity.isin("unsafe", "controversial")
    return F.when(
        toxicity == "error", F.lit("error")
    ).when(bad & pii, F.lit("both")).when(pii, F.lit("pii")).when(bad, F.lit("toxicity")).otherwise(F.lit("kept"))


def pii_rejects(status: Column, decision: Column) -> Column:
    """A model's PII verdict removes a row only if it came through and keeps the candidate as personal data; errors leave the row (fail open)."""
    return F.coalesce((status == "ok") & (decision == "keep"), F.lit(False))


def toxicity_rejects(outcome: Column) -> Column:
    """Guard errors remove a row (fail closed)."""
    return F.coalesce(outcome.isin("unsafe", "controversial", "error"), F.lit(False))


def sequential(rows: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """(stage, n_removed, n_first, n_left): rows each stage would remove, removes first, and what it leaves."""
    flags = [F.coalesce(c, F.lit(False)).cast("int").alias(f"f{i}") for i, (_, c) in enumerate(stages)]
    flat = rows.select(*flags)
    aggs = []
    for i in range(len(stages)):
        earlier = sum((F.col(f"f{j}") for j in range(i)), F.lit(0))
        aggs += [
            F.sum(f"f{i}").alias(f"r{i}"), F.sum(F.when((earlier == 0) & (F.col(f"f{i}") == 1), 1).otherwise(0)).alias(f"n{i}"),
            F.sum(F.when(earlier + F.col(f"f{i}") == 0, 1).otherwise(0)).alias(f"l{i}")
        ]
    one = flat.agg(*aggs)
    each = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(n).alias("stage"), F.col(f"r{i}").alias("n_removed"), F.col(f"n{i}").alias("n_first"),
                F.col(f"l{i}").alias("n_left")
            ) for i,
            (n, _) in enumerate(stages)
        ]
    )
    return one.select(F.explode(each).alias("s")).select("s.position", "s.stage", "s.n_removed", "s.n_first", "s.n_left")


def overlap(rows: DataFrame, flags: list[str]) -> DataFrame:
    """(flags..., n_rows): rows by which of the flags they bear."""
    return rows.groupBy(*flags).agg(F.count("*").alias("n_rows"))


def finalize(rows: DataFrame, pii: DataFrame, guard: DataFrame, location: list[str], size: str) -> DataFrame:
    """``location``, ``size``, ``reasons`` (sorted, empty if the row is clean) and ``class`` of every row.

    ``pii`` has the location, status and decision of each candidate, ``guard`` the
    location, verdict and error of each judged message.  Both are aggregated to
    one row per location before they meet the rows; decisions on locations that
    ``rows`` doesn't have stop the run.
    """
    from screenwright.operators.toxicity import guard_outcome_final

    a = pii.where(pii_rejects(F.col("status"), F.col("decision"))).select(*location, F.lit("pii").alias("_l"))
    outcome = guard_outcome_final(F.col("verdict"), F.col("error"))
    b = guard.where(toxicity_rejects(outcome)).select(*location, F.concat(F.lit("toxicity_"), outcome).alias("_l"))
    per = a.union(b).groupBy(*location).agg(F.array_sort(F.collect_set("_l")).alias("reasons"))
    known = rows.select(*location, F.col(size).alias("size"), F.lit(True).alias("_known"))
    both = known.join(per, location, "full_outer")
    stray = F.raise_error(F.lit("a decision points outside of the rows")).cast("array<string>")
    reasons = F.when(F.col("_known").isNull(), stray).otherwise(F.coalesce("reasons", F.array().cast("array<string>")))
    out = both.select(*location, F.col("size").alias(size), reasons.alias("reasons"))
    bad = F.exists("reasons", lambda r: r.startswith("toxicity"))
    kind = F.when(
        F.exists("reasons", lambda r: r.endswith("_error")), F.lit("error")
    ).when(bad & F.array_contains("reasons", "pii"), F.lit("both")).when(F.array_contains("reasons", "pii"), F.lit("pii"))
    return out.withColumn("class", kind.when(bad, F.lit("toxicity")).otherwise(F.lit("kept")))


def final_cleaning(rows: DataFrame, quality: DataFrame, contaminated: DataFrame, location: list[str]) -> DataFrame:
    """``rows`` with ``removed_by``: quality, contamination, both or none; the union of two location sets, their overlap named."""
    sets = quality.select(*location).distinct().withColumn("_s", F.lit(1)).union(contaminated.select(*location).distinct().withColumn("_s", F.lit(2)))
    per = sets.groupBy(*location).agg(F.sum("_s").alias("_s"))
    names = F.when(F.col("_s") == 1, F.lit("quality")).when(
        F.col("_s") == 2, F.lit("contamination")
    ).when(F.col("_s") == 3, F.lit("both")).otherwise(F.lit("none"))
    return rows.join(per, location, "left").withColumn("removed_by", names).drop("_s")


def set_counts(left: DataFrame, right: DataFrame, location: list[str]) -> DataFrame:
    """(in_union, in_both, only_left, only_right) of two location sets."""
    a, b = left.select(*location).distinct().withColumn("_a", F.lit(1)), right.select(*location).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, location, "full_outer")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return both.agg(
        F.count("*").alias("in_union"), n(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("in_both"),
        n(F.col("_b").isNull()).alias("only_left"), n(F.col("_a").isNull()).alias("only_right")
    )
