"""Coverage, indexes, pages, samples and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwright.operators.numbering import numbered


def coverage(expected: DataFrame, read: DataFrame, key: str = "path", compare: tuple[str, ...] = ("rows", "sha256")) -> DataFrame:
    """(key, status): missing, extra, different or same, for each file expected or read."""
    a = expected.select(F.col(key), *[F.col(c).alias(f"_e_{c}") for c in compare], F.lit(1).alias("_e"))
    b = read.select(F.col(key), *[F.col(c).alias(f"_r_{c}") for c in compare], F.lit(1).alias("_r"))
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"_e_{c}").eqNullSafe(F.col(f"_r_{c}"))
    return a.join(b, key, "full_outer").select(
        key,
        F.when(
            F.col("_r").isNull(), F.lit("missing")
        ).when(F.col("_e").isNull(), F.lit("extra")).when(same, F.lit("same")).otherwise(F.lit("different")).alias("status")
    )


def text_coverage(rows: DataFrame, group: str, text: Column) -> DataFrame:
    """(group, rows, rows_with_text, ratio, characters, mean_characters)."""
    n = F.length(text)
    out = rows.groupBy(group).agg(
        F.count("*").alias("rows"), F.sum(F.when(n > 0, 1).otherwise(0)).alias("rows_with_text"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("characters")
    )
    return out.select(
        group, "rows", "rows_with_text", F.round(F.col("rows_with_text") / F.col("rows"), 6).alias("ratio"), "characters",
        F.round(F.col("characters") / F.greatest("rows_with_text", F.lit(1)), 4).alias("mean_characters")
    )


def accounting(lines: DataFrame, group: str, blank: Column, skip_reason: Column) -> DataFrame:
    """(group, n_lines, n_blank, n_read, n_skipped, n_written): lines = blank + read, read = skipped + written."""
    read = ~blank
    return lines.groupBy(group).agg(
        F.count("*").alias("n_lines"), F.sum(blank.cast("long")).alias("n_blank"), F.sum(read.cast("long")).alias("n_read"),
        F.sum((read & skip_reason.isNotNull()).cast("long")).alias("n_skipped"), F.sum((read & skip_reason.isNull()).cast("long")).alias("n_written"),
    )


def schema_tree(rows: DataFrame, raw: str) -> DataFrame:
    """(path, type, n): types of the top-level and nested object fields of JSON lines, arrays by their first items' fields."""
    def leaf(batches):
        import json

        import pyarrow as pa

        names = {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object", type(None): "null"}

        def walk(value, path, out):
            out.append((path, names[type(value)]))
            if isinstance(value, dict):
                for k, v in value.items():
                    walk(v, f"{path}.{k}" if path else k, out)
            elif isinstance(value, list):
                for v in value:
                    walk(v, f"{path}[]", out)

        for batch in batches:
            out = []
            for line in batch.column("raw").to_pylist():
                try:
                    walk(json.loads(line), "", out)
                except (TypeError, ValueError):
                    out.append(("", "invalid"))
            paths, kinds = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(paths, type=pa.string()), pa.array(kinds, type=pa.string())], names=["path", "type"])

    return rows.select(F.col(raw).alias("raw")).mapInArrow(leaf, "path string, type string").groupBy("path", "type").agg(F.count("*").alias("n"))


def index(decided: DataFrame, text: Column) -> DataFrame:
    """The removed rows with a preview and their reasons: what pages are cut from."""
    from screenwright.functions.text import preview

    return decided.where(F.size("reasons") > 0).select("source_file", "source_line", "source_sha256", preview(text).alias("preview"), "reasons", "n_findings")


def page(rows: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """The rows of a page (counted from 0) in a total order, with ``total`` and ``has_next``.

    Rows are numbered by range partitions, so a page far behind costs what the
    first one does: no task gathers what stands before it.
    """
    total = rows.count()
    held = numbered(rows, order, name="_n").where((F.col("_n") > number * size) & (F.col("_n") <= (number + 1) * size))
    return held.orderBy("_n").drop("_n").withColumn("total", F.lit(total).cast("long")).withColumn("has_next", F.lit((number + 1) * size < total))


def top(rows: DataFrame, group: str, k: int) -> DataFrame:
    """The ``k`` groups with the most rows, ties by name."""
    return rows.groupBy(group).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), group).limit(k)


def evenly_spaced(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """``n`` rows at positions floor(i * len / n) of the ordered rows; all rows if there are no more."""
    total = rows.count()
    if total <= n:
        return rows
    held = numbered(rows, order, name="_n").withColumn("_n", F.col("_n") - 1)
    # position p is taken if some i has floor(i * total / n) = p
    i = F.expr(f"(_n * {n}L + {total - 1}L) div {total}L")
    return held.where((i < n) & (F.expr(f"((_n * {n}L + {total - 1}L) div {total}L) * {total}L div {n}L") == F.col("_n"))).drop("_n")


def hash_sample(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """The ``n`` rows with the smallest SHA-256 of a key."""
    return rows.withColumn("_h", F.sha2(key.cast("binary"), 256)).orderBy("_h").limit(n).drop("_h")


def stratified(rows: DataFrame, group: str, size: Column, target: int, n: int, tie: str) -> DataFrame:
    """``n`` rows round-robin over the groups, each group's rows by their distance from a target size."""
    from pyspark.sql import Window

    ranked = rows.withColumn("_d", F.abs(size - target))
    ranked = ranked.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy("_d", tie)))
    return ranked.where(F.col("_k") <= n).orderBy("_k", group).limit(n).drop("_d", "_k")


def first_prefix(rows: DataFrame, path: str, groups: DataFrame) -> DataFrame:
    """``rows`` with ``group``: the first group (smallest ``rank``) whose ``prefix`` starts the path, else null.

    ``groups`` (rank, group, prefix) is configuration.  Instead of a theta join
    each path is exploded to those of its own prefixes that have the length of
    some group's prefix, and these join by equality.
    """
    lengths = F.array(*map(F.lit, sorted({r[0] for r in groups.select(F.length("prefix")).distinct().collect()}) or [0]))
    keyed = rows.select(F.col(path).alias("_path")).distinct().select("_path", F.explode(lengths).alias("_n")).where(F.length("_path") >= F.col("_n"))
    met = keyed.withColumn("prefix", F.expr("substring(_path, 1, _n)")).join(groups, "prefix").groupBy("_path").agg(F.min_by("group", "rank").alias("group"))
    return rows.join(met, F.col(path) == F.col("_path"), "left").drop("_path")


def traced(notes: DataFrame, originals: DataFrame, key: list[str]) -> DataFrame:
    """(key..., status): unchanged, changed or not_found, for each noted original row and its fingerprint."""
    now = originals.select(*key, F.col("fingerprint").alias("_now"))
    return notes.join(now, key, "left").select(
        *key,
        F.when(F.col("_now").isNull(), F.lit("not_found")).when(
            F.col("_now") == F.col("fingerprint"), F.lit("unchanged")
        ).otherwise(F.lit("changed")).alias("status")
    )


def word_diff(pairs: DataFrame, left: str, right: str, limit: int = 10_000) -> DataFrame:
    """``pairs`` with ``ratio`` and ``same_words`` of a case-insensitive word alignment; null beyond ``limit`` words, where an alignment says little."""
    from pyspark.sql.types import StructType

    out = StructType(pairs.schema.fields + StructType.fromDDL("ratio double, same_words long").fields)

    def run(frames):
        import difflib
        import re

        for f in frames:
            ratio, same = [], []
            for a, b in zip(f[left], f[right], strict=True):
                a, b = (re.findall(r"\w+", (x or "").lower()) for x in (a, b))
                if max(len(a), len(b)) > limit:
                    ratio.append(None)
                    same.append(None)
                    continue
                m = difflib.SequenceMatcher(None, a, b, autojunk=False)
                ratio.append(m.ratio())
                same.append(sum(x.size for x in m.get_matching_blocks()))
            yield f.assign(ratio=ratio, same_words=same)

    return pairs.mapInPandas(run, out)
