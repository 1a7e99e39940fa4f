"""Mixing sources to target weights by a low-discrepancy schedule.

The words of each source, its documents in a seeded shuffled order, form one
stream that is cut into blocks of equal length (the last one is shorter).  The
schedule has N = 2**k slots.  Slot j stands at the golden-ratio lattice point
``j * odd mod N`` (``odd`` the odd number next to N / phi); the cumulative
number of blocks that each source needs maps that point to a source, or to no
source beyond the last.  As the lattice is a permutation, every source gets
exactly as many slots as it needs, and any run of slots holds the sources in
proportion, up to the small discrepancy of the golden ratio.  The slots of a
source are ranked in time; rank r takes block ``r mod blocks`` in epoch
``r div blocks``, and the last slot is cut where the target is reached.

Ranks and stream positions come from two-level prefix sums over chunks of
bounded size, so a source with a third of all words is not one task.  The order
of a stream hashes the id and the text, and rows equal in id, source and text
are one entry with a count until their places are known, so neither null ids
nor repeated rows make a chunk large.

Targets: sources ordered by code point, null last, weigh 5, 2, 1, repeating,
and share ``total`` times all words; a target stops at ``most`` times the words
of its source, and the excess is shared again by weight.

Defined results: a null or empty text has size 0 and is taken 0 times; rows
equal in id, source and text are interchangeable (one of them stands for all in
``mixed_documents``); a source without words has
target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenwright.llm.words import Block, map_texts
from screenwright.storage import bounded_broadcast, materialize

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_SLOTS, CHUNK_ROWS, CELLS = 8192, 512, 1024
BROADCAST_SOURCES = 20_000


def _count_words(texts: list[bytes]) -> list:
    b = Block(texts)
    return [b.hi - b.lo]


@dataclass
class Mixture:
    """``docs``: a row per document; ``sources``: a row per source; ``slots``: the schedule; ``pieces``: what each slot takes of which document."""

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame, total: float, most: int, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, i, source_size, target): ``sizes`` has (source, source_size), a row per source."""
    everything, by = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    own = sizes.withColumn("i", (F.row_number().over(by) - 1).cast("int"))
    own = own.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("i") % len(weights) + 1)).withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy(F.col("cap").cast("double") / F.col("w"), "i")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(total) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    own = own.withColumn("level", level).withColumn("at", F.row_number().over(fill))
    free = F.when(F.col("cap") > F.col("w") * F.col("level"), F.struct("at", "level"))
    own = own.withColumn("level", F.min(free).over(everything)["level"])
    return own.select("source", "i", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")), F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame, total: float = 1.5, most: int = 2, seed: int = 17, block_words: int = 512, key: str = "doc_id", source: str = "source",
    text: str = "text"
) -> Mixture:
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(key).alias("id"), F.col(source).alias("source"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("h"),
        F.col(text).alias("text")
    )
    counted = map_texts(narrow, ["id", "source", "h"], "text", _count_words, "size long")
    base = materialize(counted.groupBy("id", "source", "h", "size").agg(F.count("*").alias("n")), "mix-docs")
    n_rows = base.count()
    sums = base.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    s = targets(sums, total, most).withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    s = s.withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}"))
    s = s.withColumn(
        "need",
        F.when(
            F.col("source_size") > 0, F.expr(f"(quota div source_size) * blocks + (quota % source_size + {block_words - 1}) div {block_words}")
        ).otherwise(F.lit(0)).cast("long")
    )
    s = materialize(s.withColumn("upto", F.sum("need").over(Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))), "mix-sources")
    few = bounded_broadcast(s, BROADCAST_SOURCES)

    # the stream of each source: where each document starts
    digits = max(1, math.ceil(math.log(max(n_rows, 2) / CHUNK_ROWS, 16)))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("h")).cast("binary"))
    rows = base.join(
        few.select("source", "i", "source_size", "target"), base["source"].eqNullSafe(few["source"])
    ).select("id", base["source"], "h", "size", "n", "i", "source_size", "target", order.alias("o"))
    rows = rows.withColumn("chunk", F.substring("o", 1, digits)).withColumn("words", F.col("size") * F.col("n"))
    sizes = rows.groupBy("i", "chunk").agg(F.sum("words").alias("words"))
    offset = F.coalesce(F.sum("words").over(Window.partitionBy("i").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("i", "chunk", offset.alias("offset"))
    within = Window.partitionBy("i", "chunk").orderBy("o", "id", "size", "h").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.sum("words").over(within)).join(sizes, ["i", "chunk"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("offset") + F.col("run") - F.col("words") + F.col("copy") * F.col("size")
    rows = materialize(rows.select("id", "source", "h", "size", "i", "source_size", "target", start.alias("start")), "mix-streams")

    # the schedule
    need = s.agg(F.sum("need")).first()[0] or 0
    k = max(1, math.ceil(math.log2(max(need, 2))))
    n, odd = 1 << k, round((1 << k) / ((1 + math.sqrt(5)) / 2)) | 1
    point = F.expr(f"(id * {odd}L) % {n}L") if k <= 31 else F.expr(f"cast((cast(id as decimal(19,0)) * {odd}) % {n} as bigint)")
    cell = max(1, n // CELLS)
    cells = s.where("need > 0").select("i", "source_size", "quota", "blocks", (F.col("upto") - F.col("need")).alias("lo"), F.col("upto").alias("hi"))
    cells = cells.withColumn("cell", F.explode(F.sequence(F.expr(f"lo div {cell}"), F.expr(f"(hi - 1) div {cell}"))))
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("p")).withColumn("cell", F.expr(f"p div {cell}"))
    slots = points.join(bounded_broadcast(cells, BROADCAST_SOURCES + CELLS), "cell").where("p >= lo and p < hi")
    slots = slots.select("slot", "i", "source_size", "quota", "blocks", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk"))
    counts = slots.groupBy("i", "chunk").agg(F.count("*").alias("c"))
    earlier = F.coalesce(F.sum("c").over(Window.partitionBy("i").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("i", "chunk", earlier.alias("earlier"))
    slots = slots.withColumn("rn", F.row_number().over(Window.partitionBy("i", "chunk").orderBy("slot"))).join(counts, ["i", "chunk"])
    slots = slots.withColumn(
        "rank", F.col("earlier") + F.col("rn") - 1
    ).withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.col("rank") % F.col("blocks"))
    lo = F.col("block") * block_words
    hi = F.least(lo + block_words, F.col("source_size"), F.col("quota") - F.col("epoch") * F.col("source_size"))
    slots = slots.select("slot", "i", "rank", "epoch", "block", lo.alias("lo"), hi.alias("hi")).where("hi > lo")

    # blocks of documents meet the slots that take them
    spans = rows.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")))
    )
    a, b = F.greatest("start", "lo"), F.least(F.col("start") + F.col("size"), "hi")
    pieces = spans.join(slots, ["i", "block"]).where(a < b)
    pieces = pieces.select("slot", "epoch", "id", "h", "source", "i", "start", "size", (a - F.col("start")).alias("first"), (b - F.col("start")).alias("end"))
    return Mixture(rows, s, slots, pieces)


def taken(m: Mixture) -> DataFrame:
    """A row per document: id, source, size, source_size, target, taken (words the mix takes, repeats counted), first_slot (null if none takes it)."""
    got = m.pieces.groupBy("i", "start").agg(F.sum(F.col("end") - F.col("first")).alias("taken"), F.min("slot").alias("first_slot"))
    mine, its = m.docs.where("size > 0").alias("m"), got.alias("g")
    # documents with words differ in (i, start); those without are taken 0 times
    out = mine.join(its, (F.col("m.i") == F.col("g.i")) & (F.col("m.start") == F.col("g.start")), "left")
    fields = ("id", "source", "size", "source_size", "target")
    with_words = out.select(
        *[F.col(f"m.{c}") for c in fields], F.coalesce("g.taken", F.lit(0)).cast("long").alias("taken"), F.col("g.first_slot").alias("first_slot")
    )
    return with_words.union(m.docs.where("size = 0").select(*fields, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot")))


def mixed_documents(docs: DataFrame, m: Mixture, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix as rows of ``docs``: one for each epoch in which a document is taken.

    Blocks only cut a document where the target of its source is reached: that
    copy holds the words taken, with the white space between them.
    """
    got = m.pieces.groupBy("id", "source", "h", "i", "start", "size", "epoch").agg(F.min("first").alias("_sw_first"), F.max("end").alias("_sw_end"))
    got = got.select(
        F.col("id").alias("_sw_id"), F.col("source").alias("_sw_source"), F.col("h").alias("_sw_h"), F.col("size").alias("_sw_size"), "_sw_first",
        "_sw_end"
    )
    own = docs.columns
    h = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    one = docs.withColumn("_sw_text_h", h).dropDuplicates([key, source, "_sw_text_h"])
    rows = one.join(got, one[f"`{key}`"].eqNullSafe(got["_sw_id"]) & one[f"`{source}`"].eqNullSafe(got["_sw_source"]) & (one["_sw_text_h"] == got["_sw_h"]))
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("_sw_first") + 1).cast("int"), (F.col("_sw_end") - F.col("_sw_first")).cast("int")), "")
    whole = (F.col("_sw_first") == 0) & (F.col("_sw_end") == F.col("_sw_size"))
    return rows.select(*[F.when(whole, F.col(f"`{c}`")).otherwise(cut).alias(c) if c == text else F.col(f"`{c}`") for c in own])


def op9(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    return taken(mix(table(spark, sf_dir, "documents"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", F.coalesce("first_slot", F.lit(-1)).cast("long").alias("first_slot")
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(i % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
f AS (SELECT *, row_number() OVER fill AS nth,
    (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE)
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM w WINDOW fill AS (ORDER BY cap::DOUBLE / w, i), before AS (ORDER BY cap::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, i, source_size, coalesce(least(f0.cap::DOUBLE, f0.w * (SELECT min_by(f.level, f.nth) FROM f WHERE f.cap > f.w * f.level)), 0.0) AS target FROM f AS f0),
q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota, (source_size + 511) // 512 AS blocks FROM t),
n AS (SELECT *, CASE WHEN source_size > 0 THEN (quota // source_size) * blocks + (quota % source_size + 511) // 512 ELSE 0 END AS need FROM q),
c AS (SELECT *, (sum(need) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM n),
k AS (SELECT (1::BIGINT << greatest(1, ceil(log2(greatest(sum(need), 2)))::INT)) AS size FROM n),
g AS (SELECT size, CASE WHEN round_even(size / ((1 + sqrt(5::DOUBLE)) / 2), 0)::BIGINT % 2 = 0 THEN round_even(size / ((1 + sqrt(5::DOUBLE)) / 2), 0)::BIGINT + 1 ELSE round_even(size / ((1 + sqrt(5::DOUBLE)) / 2), 0)::BIGINT END AS odd FROM k),
pt AS (SELECT j AS slot, ((j::HUGEINT * odd) % size)::BIGINT AS p FROM (SELECT unnest(range(0, (SELECT size FROM k))) AS j), g),
sl AS (SELECT slot, i, blocks, quota, source_size, row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS rank FROM pt JOIN c ON p >= upto - need AND p < upto),
sb AS (SELECT slot, i, rank // blocks AS epoch, rank % blocks AS block, (rank % blocks) * 512 AS lo,
  least((rank % blocks) * 512 + 512, source_size, quota - (rank // blocks) * source_size) AS hi FROM sl),
p AS (SELECT d.rid, d.doc_id, d.size, q.i, q.source_size, q.target, q.quota,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size, d.rid ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
fs AS (SELECT rid, min(slot) AS first_slot FROM (SELECT *, unnest(range(start // 512, (start + size - 1) // 512 + 1)) AS block FROM p WHERE size > 0) AS p JOIN sb USING (i, block)
  WHERE greatest(start, lo) < least(start + size, hi) GROUP BY rid)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0
  ELSE (quota // source_size) * size + greatest(0, least(start + size, quota % source_size) - start) END::BIGINT AS taken, coalesce(first_slot, -1)::BIGINT AS first_slot FROM p LEFT JOIN fs USING (rid)
"""
