"""Perspective rotation of multi-party dialogues.

For every participant of a conversation the dialogue is rendered once with that
speaker as ``assistant`` and all others as named users; system turns stay what
they are.  The mask lists the code-point ranges (end exclusive) of the
assistant's contents with their end marks: what a model is trained on.

A rendering is stored in parts of ``part_turns`` consecutive turns, so that no
task holds more than one part, however large a conversation is.  Nothing is
cut: the parts of a speaker, laid end to end, are the rendering of the whole
conversation, ``start`` says where a part begins in it, and masks count from the
beginning of the whole.  Turns are numbered by a range partitioning, not by a
window over a conversation; where parts begin comes from sums over parts.  Only conversations
of more turns than a part has need either.

Defined results: a null text is an empty turn; a null turn number counts as -1
and comes first; turns with equal numbers are ordered by role and text, and
repeated rows are repeated turns; a null role is a user named ``unknown`` and
has no perspective of its own; a null conversation id is a conversation like
any other; a conversation of system turns alone gives no rows; control marks in
a text or a role are broken by a space, and line ends in a role become spaces,
so that neither can end a turn or begin one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwright.operators.numbering import numbered
from screenwright.storage import bounded_broadcast, materialize

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART_TURNS = 256
BROADCAST_PARTS = 200_000
_SPANS = "array<struct<start:bigint,end:bigint>>"


def _broken(text: Column) -> Column:
    """A text that holds no control mark."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _who(role: Column) -> Column:
    """How a message of another speaker is headed."""
    name = F.coalesce(_broken(F.translate(role, "\r\n", "  ")), F.lit("unknown"))
    return F.when(role == "system", F.lit("system")).otherwise(F.concat(F.lit("user name="), name))


def _starts(rows: DataFrame, speakers: DataFrame) -> DataFrame:
    """(tc, ts, tp, start): where the later parts of long conversations begin, for each speaker (ts)."""
    plain = F.lit(len(OPEN)) + F.length(_who(F.col("role"))) + 1 + F.length("text") + len(CLOSE) + 1
    saved = F.length("who") - len("assistant")
    sizes = rows.groupBy("c", "part", "role").agg(F.sum(plain).alias("chars"), F.count("*").alias("n"))
    sizes = materialize(sizes.withColumn("who", _who(F.col("role"))), "chat-sizes")
    whole = sizes.groupBy("c", "part").agg(F.sum("chars").alias("chars"))
    own = sizes.select(F.col("c").alias("oc"), F.col("part").alias("op"), F.col("role").alias("speaker"), (F.col("n") * saved).alias("less"))
    each = whole.join(speakers, whole["c"].eqNullSafe(speakers["sc"])).drop("sc")
    each = each.join(
        own.withColumnRenamed("speaker", "os"),
        F.col("c").eqNullSafe(F.col("oc")) & (F.col("part") == F.col("op")) & (F.col("speaker") == F.col("os")), "left"
    )
    before = Window.partitionBy("c", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum(F.col("chars") - F.coalesce("less", F.lit(0))).over(before)
    return each.select(F.col("c").alias("tc"), F.col("speaker").alias("ts"), F.col("part").alias("tp"), start.cast("long").alias("start")).where("tp > 0")


def rotations(turns: DataFrame, part_turns: int = PART_TURNS, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, speaker, part, start, n_turns, n_target, rendered, mask): ``mask`` is array<struct<start, end>>.

    ``n_turns`` and ``n_target`` count the turns of the part and those of the speaker among them.
    """
    number = F.coalesce(F.col(turn).cast("long"), F.lit(-1))
    rows = turns.select(F.col(conv).alias("c"), number.alias("turn"), F.col(role).alias("role"), _broken(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    speakers = rows.where(F.col("role").isNotNull() & (F.col("role") != "system")).select(F.col("c").alias("sc"), F.col("role").alias("speaker")).distinct()
    # one conversation in part_turns turns at most is long
    many = materialize(rows.groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") > part_turns).select(F.col("c").alias("mc")), "chat-long")
    some = not many.isEmpty()
    later = None
    if some:
        few, same = bounded_broadcast(many, BROADCAST_PARTS), F.col("c").eqNullSafe(F.col("mc"))
        later = numbered(rows.join(few, same, "left_semi"), ["turn", "role", "text"], ["c"], "nth")
        later = materialize(later.withColumn("part", F.expr(f"(nth - 1) div {part_turns}")).drop("nth"), "chat-turns")
        rows = rows.join(few, same, "left_anti")
    rows = rows.withColumn("part", F.lit(0).cast("long"))
    rows = rows.unionByName(later) if some else rows
    parts = rows.groupBy("c", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    each = parts.join(speakers, F.col("c").eqNullSafe(F.col("sc")))
    if not some:
        each = each.withColumn("start", F.lit(0).cast("long"))
    else:
        begins = _starts(later, speakers)
        same = F.col("c").eqNullSafe(F.col("tc")) & (F.col("speaker") == F.col("ts")) & (F.col("part") == F.col("tp"))
        each = each.join(begins, same, "left").withColumn("start", F.coalesce("start", F.lit(0)))

    def message(m):
        own = F.coalesce(m["role"] == F.col("speaker"), F.lit(False))
        who = F.when(own, F.lit("assistant")).otherwise(_who(m["role"]))
        return F.struct(F.concat(F.lit(OPEN), who, F.lit("\n")).alias("head"), F.concat(m["text"], F.lit(CLOSE)).alias("body"), own.alias("own"))

    def place(acc, m):
        start = acc["pos"] + F.length(m["head"])
        end = start + F.length(m["body"])
        said = F.when(m["own"], F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast(_SPANS))
        return F.struct((end + 1).alias("pos"), F.concat(acc["mask"], said).alias("mask"))

    each = each.withColumn("ms", F.transform("turns", message))
    none = F.struct(F.col("start").alias("pos"), F.array().cast(_SPANS).alias("mask"))
    return each.select(
        F.col("c").alias(conv), "speaker", "part", "start", F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("ms", lambda m: m["own"])).cast("long").alias("n_target"),
        F.array_join(F.transform("ms", lambda m: F.concat(m["head"], m["body"], F.lit("\n"))), "").alias("rendered"), F.aggregate("ms", none, place, lambda acc: acc["mask"]).alias("mask"),
    )


def op2(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    said = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rotations(table(spark, sf_dir, "conversations")).withColumn("mask", said)


SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(turn, -1), role NULLS FIRST, replace(coalesce(text, ''), '<|', '< |')) AS nth, role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
m AS (SELECT t.conv_id, (nth - 1) // 256 AS part, speaker, coalesce(role = speaker, false) AS own, nth AS n,
  '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
    ELSE 'user name=' || coalesce(replace(translate(role, chr(13) || chr(10), '  '), '<|', '< |'), 'unknown') END || chr(10) AS head, text || '<|im_end|>' AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (SELECT *, (sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker ORDER BY n) - length(body) - 1)::BIGINT AS beg FROM m)
SELECT conv_id, speaker, part, min(beg - length(head))::BIGINT AS "start", count(*)::BIGINT AS n_turns, count(*) FILTER (own)::BIGINT AS n_target, string_agg(head || body || chr(10), '' ORDER BY n) AS rendered,
  coalesce(string_agg(beg || ':' || (beg + length(body)), ',' ORDER BY n) FILTER (own), '') AS mask FROM p GROUP BY conv_id, speaker, part
"""
