"""Personal data: direct identifiers, and terms that give them away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers
(leftmost non-overlapping matches of a pattern per kind, then a check).  Each
distinct value is a *protected entity*.  The corpus tells how strongly the terms
around its mentions reveal it.  With n(t) rows that hold term t, n(e) that hold
entity e, n(t, e) that hold t beside it, and N rows in all,

    p(e | t) = (n(t, e) + prior * n(e) / N) / (n(t) + prior)
    share    = PMI(t; e) / IC(e) = log2(p(e | t) N / n(e)) / log2(N / n(e))

is the part of the information in e that t discloses.  The prior (one row that
says nothing) keeps a single observation from counting as certainty; entities of
any number of texts take part.  Terms are words, and names of several words
(runs of capitalised words).

A term with a share of ``generalise`` or more gives way to its class (number,
code, name, word), if that class discloses less than ``generalise`` of the same
entity by the same measure; otherwise, and from a share of ``remove`` on, it is
cut.  Both hold wherever the term stands beside that entity.

All of it is DataFrame functions.  The corpus is read three times: for base
spans, of which only texts that have one go on, each distinct text once with the
number of its rows; for the counts n(t), aggregated on the map side; and to hand
out the results.  Patterns are written so that the matcher never scans a run of
characters twice: lookbehinds let a match start only where a run starts, and
possessive quantifiers do not back up; the matches are those of the plain
patterns.

Defined results: null and empty texts have no spans; repeated rows are reported
each and counted each; an empty table gives no rows; offsets are code points,
end exclusive; only the id and the text of the input are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwright.storage import materialize

#: Terms, and spans of affected texts, are broadcast up to so many; beyond, the joins shuffle.
BROADCAST_TERMS = 1_000_000
TERM = r"[\p{L}\p{N}]+"
#: Two capitalised words or more.
NAME = r"(?<![\p{L}\p{N}])\p{Lu}[\p{L}\p{N}]*+(?: \p{Lu}[\p{L}\p{N}]*+)++"
#: Classes of terms, the first that fits: what a term as a whole looks like, and what shows that a text has one.
CLASSES = (
    ("number", r"^\p{N}+$", r"(?<![\p{L}\p{N}])\p{N}++(?!\p{L})"),
    ("code", r"\p{N}", r"\p{L}\p{N}|\p{N}\p{L}"),
    ("name", r"^\p{Lu}", r"(?<![\p{L}\p{N}])\p{Lu}"),
    ("word", "", r"(?<![\p{L}\p{N}])[\p{L}&&[^\p{Lu}]]"),
)
CUT = len(CLASSES)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _octets(c: Column) -> Column:
    """Every dotted part is at most 255."""
    plain = F.transform(F.split(c, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(plain, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A cheap test that every text with a match passes.
    hint: object
    valid: object


_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@"), lambda m: F.lit(True)),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", lambda t: t.rlike(r"[0-9]\.[0-9]"), _octets),
    Kind("card", r"(?<![0-9])[0-9](?:[ -]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){13}"), lambda m: F.length(_digits(m)).between(14, 19) & _luhn(m)),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda t: t.contains("+"), lambda m: F.length(_digits(m)).between(10, 15)),
)


def _luhn(c: Column) -> Column:
    return F.call_function("luhn_check", _digits(c))


def found(text: Column, pattern: str, valid) -> Column:
    """array<struct<start, end, value>> of the valid matches of a pattern.

    The gaps between the matches and the matches alternate, so one fold over
    both gives the positions.  Positions are gathered in a string, whose growth
    is a memory copy, and parsed once.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(hits)).alias("gap"), hits.alias("hit"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        said = F.concat(F.lit(","), start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.when(valid(x["hit"]), said).otherwise(F.lit(""))).alias("out"))

    out = F.aggregate(both, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step, lambda acc: acc["out"])
    return F.transform(
        F.filter(F.split(out, ","), lambda s: s != ""),
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(1)).cast("int").alias("start"), F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("end")
        )
    )


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> by start, then kind as listed."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of(i: int, k: Kind) -> Column:
        spans = F.transform(found(text, k.pattern, k.valid), lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))
        return F.when(k.hint(text), spans).otherwise(none)

    return F.array_sort(F.concat(*[of(i, k) for i, k in enumerate(KINDS)]))


def count_of(kind: int, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def class_of(term: Column) -> Column:
    """The index of a term's class."""
    out = F.lit(len(CLASSES) - 1)
    for i, (_, pattern, _) in reversed(list(enumerate(CLASSES[:-1]))):
        out = F.when(term.rlike(pattern), F.lit(i)).otherwise(out)
    return out


def class_term(kind: Column) -> Column:
    """The name under which a class is counted among the terms; no term has a colon."""
    return F.concat(F.lit("class:"), F.get(F.array(*[F.lit(n) for n, _, _ in CLASSES]), kind))


def affected(docs: DataFrame, text: str) -> DataFrame:
    """(h, n, text, spans): the distinct texts with a base span, their rows and their spans."""
    rows = docs.select(F.col(text).alias("text")).withColumn("spans", base_spans(F.col("text"))).where(F.size("spans") > 0)
    return rows.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(
        F.count("*").alias("n"), F.first("text").alias("text"), F.first("spans").alias("spans")
    )


def mentions(rows: DataFrame, context: int) -> DataFrame:
    """(h, n, entity, term, kind, start, end): the terms within ``context`` characters of each base span, but for those in base spans.

    A span without terms around it has one row with a null term.
    """
    none = F.array().cast("array<struct<term:string,kind:int,start:int,end:int>>")

    def around(s):
        lo = F.greatest(s["start"] - context, F.lit(0))
        left = F.substring(F.col("text"), lo + 1, s["start"] - lo)
        right = F.substring(F.col("text"), s["end"] + 1, F.lit(context))
        # a word that the window cuts is no term: left out, so that offsets stay
        cut_left = F.when(lo > 0, F.length(F.regexp_extract(left, f"^{TERM}", 0))).otherwise(F.lit(0))
        cut_right = F.when(F.length(right) == context, F.length(F.regexp_extract(right, f"{TERM}$", 0))).otherwise(F.lit(0))
        value = F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])
        return F.struct(
            F.concat(s["kind"].cast("string"), F.lit(":"), F.lower(value)).alias("entity"),
            F.filter("spans", lambda o: (o["end"] > lo) & (o["start"] < s["end"] + context)).alias("near"),
            F.array(
                F.struct((lo + cut_left).alias("at"), F.substring(left, cut_left + 1, F.length(left)).alias("part")),
                F.struct(s["end"].alias("at"), F.substring(right, F.lit(1), F.length(right) - cut_right).alias("part")),
            ).alias("sides"),
        )

    one = rows.select("h", "n", F.explode(F.transform("spans", around)).alias("s"))
    one = one.select("h", "n", "s.entity", "s.near", F.explode("s.sides").alias("c")).select("h", "n", "entity", "near", "c.at", "c.part")
    one = one.withColumn("w", F.concat(found(F.col("part"), TERM, lambda m: F.lit(True)), found(F.col("part"), NAME, lambda m: F.lit(True))))
    free = F.filter("w", lambda w: ~F.exists("near", lambda o: (o["start"] < F.col("at") + w["end"]) & (F.col("at") + w["start"] < o["end"])))
    one = one.select("h", "n", "entity", "at", "part", free.alias("w"))

    def term(w):
        said = F.substring(F.col("part"), w["start"] + 1, w["end"] - w["start"])
        return F.struct(
            F.lower(said).alias("term"), class_of(said).alias("kind"), (F.col("at") + w["start"]).alias("start"),
            (F.col("at") + w["end"]).alias("end")
        )

    return one.select(
        "h", "n", "entity", F.explode_outer(F.coalesce(F.transform("w", term), none)).alias("t")
    ).select("h", "n", "entity", "t.term", "t.kind", "t.start", "t.end")


def occurrences(docs: DataFrame, terms: DataFrame, text: str) -> DataFrame:
    """(term, n_t): in how many rows each of ``terms`` occurs, classes included."""
    t = F.col(text)
    words = F.split(F.lower(t), r"[^\p{L}\p{N}]+")
    names = F.transform(F.regexp_extract_all(t, F.lit(NAME), F.lit(0)), lambda x: F.lower(x))
    kinds = F.array(*[F.when(t.rlike(shows), class_term(F.lit(i))) for i, (_, _, shows) in enumerate(CLASSES)])
    held = docs.select(F.explode(F.array_distinct(F.concat(words, names, kinds))).alias("term"))
    if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        return held.join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("n_t"))
    # too many to be sent to all tasks: words are counted on the map side before they move
    return held.groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term")


def disclosing(docs: DataFrame, near: DataFrame, text: str, generalise: float, remove: float, prior: float) -> DataFrame:
    """(entity, term, kind, action, share): the terms that disclose at least ``generalise`` of an entity; ``action`` is a class or CUT.

    ``kind`` is the class of the term; a term written in several ways has a row for each.
    """
    total = float(docs.count())
    entities = near.select("entity", "h", "n").distinct().groupBy("entity").agg(F.sum("n").alias("n_e"))
    said = near.where("term is not null")
    both = said.select("entity", "term", "kind", "h", "n").unionByName(
        said.select("entity", class_term(F.col("kind")).alias("term"), F.lit(-1).alias("kind"), "h", "n")
    )
    both = both.groupBy("entity", "term", "h").agg(F.first("n").alias("n"), F.collect_set("kind").alias("kinds"))
    both = both.groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"))
    pairs = materialize(both.join(entities, "entity"), "pii-pairs")
    counts = occurrences(docs, pairs.select("term").distinct(), text)
    ic = F.log2(total / F.col("n_e"))
    chance = (F.col("n_te") + prior * F.col("n_e") / total) / (F.col("n_t") + prior)
    shares = pairs.join(counts, "term").withColumn("share", F.when(ic > 0, (F.log2(chance) + ic) / ic)).where(F.col("share") >= generalise)
    shares = materialize(shares.select("entity", "term", F.explode("kinds").alias("kind"), "share"), "pii-shares")
    telling = shares.where("kind = -1").select("entity", F.col("term").alias("class"))
    found_ = shares.where("kind >= 0").withColumn("class", class_term(F.col("kind")))
    cut = (F.col("share") >= remove) | F.col("telling")
    found_ = found_.join(telling.withColumn("telling", F.lit(True)), ["entity", "class"], "left").withColumn("telling", F.coalesce("telling", F.lit(False)))
    return found_.select("entity", "term", "kind", F.when(cut, F.lit(CUT)).otherwise(F.col("kind")).alias("action"), "share")


def term_spans(near: DataFrame, giving: DataFrame) -> DataFrame:
    """(h, start, end, action): the disclosing terms of each text; of overlapping ones the first and longest, and its strictest action."""
    at = near.where("term is not null").join(giving, ["entity", "term", "kind"]).groupBy("h", "start", "end").agg(F.max("action").alias("action"))
    before = Window.partitionBy("h").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return at.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0))).where("start >= reached").drop("reached")


def _said(spans: Column, names: list[str]) -> Column:
    name = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_MARKED = "array<struct<start:int,kind:int,end:int,action:int>>"


def spanned(docs: DataFrame, text: str = "text", context: int = 60, generalise: float = 0.7, remove: float = 0.9, prior: float = 1.0) -> DataFrame:
    """(h, base, spans): the base spans of each distinct text that has any, and all its spans; ``h`` is the MD5 of the text.

    ``spans`` has the disclosing terms as kind ``len(KINDS)`` with their
    ``action``, a class or CUT; base spans have the action -1.
    """
    known = docs.where(F.col(text).isNotNull())
    rows = materialize(affected(known, text), "pii-texts")
    near = materialize(mentions(rows, context), "pii-mentions")
    at = term_spans(near, disclosing(known, near, text, generalise, remove, prior))
    kind = F.lit(len(KINDS))
    terms = at.groupBy("h").agg(F.collect_list(F.struct("start", kind.alias("kind"), "end", "action")).alias("terms"))
    whole = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(-1).alias("action")))
    out = rows.select("h", "spans").join(terms, "h", "left")
    return materialize(
        out.select("h", F.col("spans").alias("base"), F.array_sort(F.concat(whole, F.coalesce("terms", F.array().cast(_MARKED)))).alias("spans")),
        "pii-spans"
    )


def handed_out(docs: DataFrame, found_: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """(key, base, spans) and ``more`` of every row of ``docs``; texts without spans get empty arrays."""
    n = found_.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    few = F.broadcast(found_) if n <= BROADCAST_TERMS else found_
    rows = docs.select(F.col(key).alias("_sw_id"), F.col(text).alias("_sw_text"), F.md5(F.col(text).cast("binary")).alias("h"))
    out = rows.join(few, "h", "left")
    return out.select(
        F.col("_sw_id").alias(key), F.coalesce("base", F.array().cast(_SPAN)).alias("base"),
        F.coalesce("spans", F.array().cast(_MARKED)).alias("spans"), *more
    )


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, base, spans, sanitised) of every row.

    ``base``: array<struct<start, kind, end>>, kind an index into KINDS;
    ``spans``: the same with the disclosing terms (kind ``len(KINDS)``) and
    ``action``; ``sanitised``: the text with identifiers and generalised terms
    replaced by their class, and the other terms cut.
    """
    out = handed_out(docs, spanned(docs, text, **options), key, text, F.coalesce("_sw_text", F.lit("")).alias("_sw_text"))
    marks = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
    classes = F.array(*[F.lit(f"[{n.upper()}]") for n, _, _ in CLASSES], F.lit(""))

    def step(acc, s):
        fresh = s["end"] > acc["pos"]
        mark = F.when(s["action"] < 0, F.get(marks, s["kind"])).otherwise(F.get(classes, s["action"]))
        piece = F.concat(F.substring(F.col("_sw_text"), acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0))), mark)
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(
        "spans", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substring(F.col("_sw_text"), acc["pos"] + 1, F.length("_sw_text")))
    )
    return out.select(key, "base", "spans", clean.alias("sanitised"))


def op1(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    docs = table(spark, sf_dir, "documents")
    out = handed_out(docs, spanned(docs), "doc_id", "text")
    names = [k.name for k in KINDS]
    counts = [count_of(i).alias(f"n_{n}") for i, n in enumerate(names)]
    terms = F.filter("spans", lambda s: s["kind"] == len(KINDS))
    n_cut = F.size(F.filter(terms, lambda s: s["action"] == CUT)).cast("long")
    return out.select(
        "doc_id", *counts, F.sha2(_said(F.col("base"), names).cast("binary"), 256).alias("base_sha256"), _said(F.col("spans"), [*names, "term"]).alias("spans"),
        (F.size(terms) - n_cut).cast("long").alias("n_generalised"), n_cut.alias("n_removed"),
    )
