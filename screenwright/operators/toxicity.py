"""Toxicity: scores of an injected classifier, guard verdicts, policy judgements, tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERDICTS = ("Safe", "Unsafe", "Controversial")
BINS, BIN_WIDTH = 20, 0.05


def units(rows: DataFrame, location: list[str], candidates: Column) -> DataFrame:
    """(location..., message_index, role, text): the candidates of each row."""
    one = rows.select(*location, F.explode(candidates).alias("u"))
    return one.select(*location, F.col("u.index").alias("message_index"), F.col("u.role").alias("role"), F.col("u.text").alias("text"))


def flagged(scores: Column, threshold: float = 0.5) -> Column:
    """struct<toxicity, trigger_category, flagged> of a map of scores: the largest, its first category in key order, and whether it is above the threshold."""
    entries = F.transform(F.array_sort(F.map_entries(scores)), lambda e, i: F.struct(e["value"].alias("s"), (-i).alias("i"), e["key"].alias("k")))
    top = F.array_max(entries)
    return F.struct(top["s"].alias("toxicity"), top["k"].alias("trigger_category"), F.coalesce(top["s"] > threshold, F.lit(False)).alias("flagged"))


def score_bin(score: Column) -> Column:
    """The bin of a score: 20 of width 0.05, truncated in double arithmetic, the last one closed."""
    return F.least(F.floor(score / F.lit(BIN_WIDTH)), F.lit(BINS - 1)).cast("int")


def guard_outcome(verdict: Column, error: Column | None = None) -> Column:
    """For filters: exact-case verdicts; an error key, even an empty one, or any other verdict is guard_error."""
    known = F.when(verdict == "Safe", F.lit("safe")).when(verdict == "Unsafe", F.lit("unsafe")).when(
        verdict == "Controversial", F.lit("controversial")
    ).otherwise(F.lit("guard_error"))
    return known if error is None else F.when(error.isNotNull(), F.lit("guard_error")).otherwise(known)


def guard_outcome_final(verdict: Column, error: Column | None = None) -> Column:
    """For the quality decision: verdicts in any case; only a non-empty error counts."""
    low = F.lower(verdict)
    known = F.when(low.isin(*[v.lower() for v in VERDICTS]), low).otherwise(F.lit("error"))
    return known if error is None else F.when(F.length(error) > 0, F.lit("error")).otherwise(known)


# The categories that the guard names.
CATEGORIES = (
    "Violent", "Non-violent Illegal Acts", "Sexual Content or Sexual Acts", "PII", "Suicide & Self-Harm", "Unethical Acts",
    "Politically Sensitive Topics", "Copyright Violation", "Jailbreak", "None"
)


def parse_guard(reply: Column, last_role: Column | None = None) -> Column:
    """struct<safety, categories, refusal> of a guard reply; every category that it names, without repeats, in order; a refusal only after an assistant's message."""
    first = lambda p: F.nullif(F.regexp_extract(reply, p, 1), F.lit(""))
    said = F.array_distinct(F.regexp_extract_all(reply, F.lit("(" + "|".join(CATEGORIES) + ")"), F.lit(1)))
    refusal = first(r"Refusal:\s*(Yes|No)")
    refusal = refusal if last_role is None else F.when(last_role == "assistant", refusal)
    return F.struct(
        first(r"Safety:\s*(Safe|Unsafe|Controversial)").alias("safety"), F.coalesce(said, F.array().cast("array<string>")).alias("categories"),
        refusal.alias("refusal")
    )


def atoms(verdict: Column, categories: Column) -> Column:
    """``error``, or ``verdict|category`` for each category (an empty one if there is none)."""
    named = F.when(F.coalesce(F.size(categories), F.lit(0)) > 0, categories).otherwise(F.array(F.lit("")))
    return F.when(verdict.isin(*VERDICTS), F.transform(named, lambda c: F.concat(verdict, F.lit("|"), c))).otherwise(F.array(F.lit("error")))


def counted(atom: Column, verdicts: list[str], categories: list[str], known: list[str]) -> Column:
    """Whether an atom counts under a choice: errors always; unknown or empty categories with their verdict."""
    v, c = F.split_part(atom, F.lit("|"), F.lit(1)), F.split_part(atom, F.lit("|"), F.lit(2))
    return (atom == "error") | (v.isin(*verdicts) & (c.isin(*categories) | ~c.isin(*known)))


def row_atoms(messages: DataFrame, location: list[str], verdict: str, categories: str) -> DataFrame:
    """(location..., atoms): the sorted set of atoms of each row's messages."""
    one = messages.select(*location, F.explode(atoms(F.col(verdict), F.col(categories))).alias("atom"))
    return one.groupBy(*location).agg(F.array_sort(F.collect_set("atom")).alias("atoms"))


def tally(row_sets: DataFrame) -> DataFrame:
    """(atoms, n_rows): rows by their set of atoms."""
    return row_sets.groupBy(F.array_join("atoms", ",").alias("atoms")).agg(F.count("*").alias("n_rows"))


def verdicts_by_role(messages: DataFrame, folder: str, role: str, outcome: str) -> DataFrame:
    """(folder, role, outcome counts): per folder and role, with ``total`` over the roles and ``*`` over the folders."""
    names = ("unsafe", "controversial", "safe", "error")
    out = [F.sum(F.when(F.col(outcome) == n, 1).otherwise(0)).cast("long").alias(n) for n in names]
    out.append(F.sum(F.when(F.col(outcome).isin(*names), 0).otherwise(1)).cast("long").alias("unknown"))
    cube = messages.select(F.col(folder).alias("folder"), F.col(role).alias("role"), outcome).cube("folder", "role").agg(
        F.grouping("folder").alias("_f"), F.grouping("role").alias("_r"), *out
    )
    return cube.select(
        F.when(F.col("_f") == 1, F.lit("*")).otherwise(F.col("folder")).alias("folder"),
        F.when(F.col("_r") == 1, F.lit("total")).otherwise(F.col("role")).alias("role"), *names, "unknown"
    )


def record_impact(messages: DataFrame, location: list[str], outcome: str, names: tuple[str, ...] = ("unsafe", "controversial", "error")) -> DataFrame:
    """Records by which outcomes they hold: (has_<name>..., n_records, n_messages)."""
    per = messages.groupBy(*location).agg(*[F.max(F.col(outcome) == n).alias(f"has_{n}") for n in names], F.count("*").alias("n"))
    return per.groupBy(*[f"has_{n}" for n in names]).agg(F.count("*").alias("n_records"), F.sum("n").alias("n_messages"))


def locate(messages: Column, text: Column) -> Column:
    """struct<index, kind>: which message a scored text ``role: content`` is: the last one equal to it (exact), else the last of its role (fallback), else missing.

    Texts of other roles than user and assistant fall back to the user.
    """
    role, content = F.regexp_extract(text, r"(?s)^(.*?): ", 1), F.regexp_extract(text, r"(?s)^.*?: (.*)$", 1)
    other = F.when(role.isin("user", "assistant"), role).when(text.startswith("assistant:"), F.lit("assistant")).otherwise(F.lit("user"))
    at = F.transform(
        messages,
        lambda m, i: F.struct(
            i.alias("i"), (m["role"] == other).alias("r"),
            (role.isin("user", "assistant", "system", "tool") & (m["role"] == role) & (m["content"] == content)).alias("e")
        )
    )
    exact = F.try_element_at(F.filter(at, lambda x: x["e"]), F.lit(-1))["i"]
    same = F.try_element_at(F.filter(at, lambda x: x["r"]), F.lit(-1))["i"]
    return F.struct(
        F.coalesce(exact, same).alias("index"),
        F.when(exact.isNotNull(), F.lit("exact")).when(same.isNotNull(), F.lit("fallback")).otherwise(F.lit("missing")).alias("kind")
    )


def policy_keeps(policy: Column) -> Column:
    """Whether the policy judge called a message suitable, which un-flags it; no policy changes nothing."""
    return F.coalesce(policy == "KEEP_GENERAL", F.lit(False))


def needs_policy(outcome: Column, policy: Column) -> Column:
    """Messages that go to the policy judge: flagged by the guard, and not judged yet."""
    return outcome.isin("unsafe", "controversial") & policy.isNull()


def agreement(left: Column, right: Column) -> Column:
    """Share of equal actions; REVIEW and missing ones are left out; null if nothing is comparable."""
    comparable = left.isin("KEEP", "FILTER") & right.isin("KEEP", "FILTER")
    return F.avg(F.when(comparable, (left == right).cast("double")))


def what_if(messages: DataFrame, location: list[str], outcome: str, steps: tuple[tuple[str, ...], ...]) -> DataFrame:
    """(removed, n_removed, n_left): records that go if messages of these outcomes remove theirs, for each of ``steps``."""
    names = sorted({n for s in steps for n in s})
    per = messages.groupBy(*location).agg(*[F.max((F.col(outcome) == n).cast("int")).alias(f"o{i}") for i, n in enumerate(names)])
    gone = [sum((F.col(f"o{names.index(n)}") for n in s), F.lit(0)) > 0 for s in steps]
    one = per.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(g.cast("long")), F.lit(0)).alias(f"g{i}") for i, g in enumerate(gone)])
    each = F.array(
        *[
            F.struct(F.lit("+".join(s)).alias("removed"), F.col(f"g{i}").alias("n_removed"), (F.col("n") - F.col(f"g{i}")).alias("n_left")) for i,
            s in enumerate(steps)
        ]
    )
    return one.select(F.explode(each).alias("s")).select("s.removed", "s.n_removed", "s.n_left")
