"""Row removal: findings of all scanners, rules, kept and removed rows, line maps, checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwright.operators.toxicity import guard_outcome

LOCATION = ["source_file", "source_line"]


@dataclass(frozen=True)
class Rules:
    """Which findings remove a row."""

    ignored_categories: tuple[str, ...] = ()
    ignored_labels: tuple[str, ...] = ()
    verdicts: tuple[str, ...] = ("unsafe",)
    guard_errors_remove: bool = False
    duplicates: tuple[str, ...] = ("global", "cross")
    protected: tuple[str, ...] = field(default=())


def hit(reason: str | Column, scanner: str, finding: Column) -> list[Column]:
    return [
        *LOCATION, "source_sha256", (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), F.lit(scanner).alias("scanner"),
        finding.alias("finding")
    ]


def pii_hits(found: DataFrame, rules: Rules) -> DataFrame:
    return found.where(~F.col("category").isin(*rules.ignored_categories, "")).select(*hit("regex_pii", "regex_pii", F.concat_ws(":", "category", "value")))


def ner_hits(spans: DataFrame, rules: Rules) -> DataFrame:
    return spans.where(
        F.col("eligible") & ~F.col("label").isin(*rules.ignored_labels, "")
    ).select(*hit("ner_pii", "ner_pii", F.concat_ws(":", "label", "text")))


def toxicity_hits(guard: DataFrame, rules: Rules) -> DataFrame:
    """``guard`` has verdict, and may have error and policy; a policy of KEEP_GENERAL clears a row."""
    error = F.col("error") if "error" in guard.columns else None
    out = guard.withColumn("outcome", guard_outcome(F.col("verdict"), error))
    if "policy" in guard.columns:
        out = out.where(~F.coalesce(F.col("policy") == "KEEP_GENERAL", F.lit(False)))
    wanted = [*rules.verdicts, *(["guard_error"] if rules.guard_errors_remove else []), ""]
    return out.where(F.col("outcome").isin(*wanted)).select(*hit(F.concat(F.lit("toxicity_"), F.col("outcome")), "toxicity", F.col("outcome")))


def duplicate_hits(decided: DataFrame, rules: Rules, mode: str = "global") -> DataFrame:
    if mode not in rules.duplicates:
        decided = decided.limit(0)
    return decided.select(*hit(f"duplicate_{mode}", "dedup", F.col("duplicate_of")))


def findings(*hits: DataFrame, protected: tuple[str, ...] = ()) -> DataFrame:
    """The union of all findings; those of protected files are forgotten."""
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out.where(~F.col("source_file").isin(*protected, ""))


def decide(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (with LOCATION and source_sha256) plus ``reasons`` (sorted, empty if kept) and ``n_findings``.

    Findings are aggregated per location before they meet the rows; a finding
    made on another version of a line (another fingerprint) stops the run.
    """
    per = found.groupBy(*LOCATION).agg(
        F.array_sort(F.collect_set("reason")).alias("reasons"), F.count("*").alias("n_findings"), F.min("source_sha256").alias("_lo"),
        F.max("source_sha256").alias("_hi")
    )
    out = rows.join(per, LOCATION, "left")
    stale = F.col("_lo").isNotNull() & ((F.col("_lo") != F.col("source_sha256")) | (F.col("_hi") != F.col("source_sha256")))
    reasons = F.when(
        stale, F.raise_error(F.lit("a finding was made on another version of its line")).cast("array<string>")
    ).otherwise(F.coalesce("reasons", F.array().cast("array<string>")))
    return out.select(*rows.columns, reasons.alias("reasons"), F.coalesce("n_findings", F.lit(0)).alias("n_findings"))


def kept(decided: DataFrame) -> DataFrame:
    return decided.where(F.size("reasons") == 0)


def removed(decided: DataFrame) -> DataFrame:
    return decided.where(F.size("reasons") > 0)


def by_reason(decided: DataFrame) -> DataFrame:
    """(reason, n_rows): a row counts once under each of its reasons."""
    return decided.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def per_file(decided: DataFrame, size: Column) -> DataFrame:
    """(source_file, rows, kept, removed, bytes, kept_bytes, removed_bytes): conserved by construction, checked by ``conserved``."""
    gone = F.size("reasons") > 0
    return decided.groupBy("source_file").agg(
        F.count("*").alias("rows"), F.sum((~gone).cast("long")).alias("kept"), F.sum(gone.cast("long")).alias("removed"),
        F.sum(size).alias("bytes"), F.sum(F.when(~gone, size).otherwise(0)).alias("kept_bytes"), F.sum(F.when(gone, size).otherwise(0)).alias("removed_bytes"),
    )


def conserved(files: DataFrame) -> DataFrame:
    """Files whose kept and removed rows or bytes don't add up: must be empty."""
    return files.where("rows <> kept + removed or bytes <> kept_bytes + removed_bytes")


def check_written(written: DataFrame, decided: DataFrame) -> DataFrame:
    """Lines of a re-read output (LOCATION, source_sha256) that should not be there, or differ, or are missing: must be empty."""
    want = kept(decided).select(*LOCATION, F.col("source_sha256").alias("want"))
    both = written.select(*LOCATION, "source_sha256").join(want, LOCATION, "full_outer")
    return both.where(~F.col("source_sha256").eqNullSafe(F.col("want")))


def drop_list(index: DataFrame, names: list[str], scanner: str, scan_id: str, automatic: bool = False) -> DataFrame:
    """A drop list from a selection of flagged rows: any of ``names`` among their reasons."""
    return index.where(F.arrays_overlap("reasons", F.array(*map(F.lit, names)))).select(
        F.col("source_file").alias("file"), F.col("source_line").alias("line"), F.col("source_sha256").alias("sha256"), F.lit(scanner).alias("scanner"), F.lit(scan_id).alias("scan_id"), "reasons", F.lit(automatic).alias("automatic")
    )


def invalid_locations(found: DataFrame, files: DataFrame) -> DataFrame:
    """Findings in unknown files, beyond the last line, or without a proper fingerprint."""
    known = files.select(F.col("source_file").alias("_f"), F.col("rows").alias("_rows"))
    out = found.join(known, F.col("source_file") == F.col("_f"), "left")
    ok = F.col("_f").isNotNull() & (F.col("source_line") >= 1) & (F.col("source_line") <= F.col("_rows")) & F.col("source_sha256").rlike(r"^[0-9a-f]{64}\z")
    return out.where(~F.coalesce(ok, F.lit(False))).select(*found.columns)


def automatic_drop(index: DataFrame, problems: DataFrame, names: list[str], scanner: str, scan_id: str) -> DataFrame:
    """A drop list that no one has chosen: all of the scan or, if its coverage has a problem, nothing."""
    out = drop_list(index, names, scanner, scan_id, automatic=True)
    return out.where(F.lit(problems.isEmpty()))


def hits_by_row(found: DataFrame) -> DataFrame:
    """(LOCATION, hits): the findings of each row as a sorted array of category and value, keyed by place."""
    return found.groupBy(*LOCATION).agg(F.array_sort(F.collect_set(F.struct("category", "value"))).alias("hits"))
