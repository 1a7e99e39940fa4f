"""Text and message functions as Columns.

A chat is ``array<struct<role: string, content: string>>``.  Each scanner reads
a row in its own way; the four extractors below must not be unified.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: ASCII punctuation, in the order of its code points: the class [!-/:-@\\[-`{-~].
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normalize(text: Column) -> Column:
    """Lower-cased, ASCII punctuation deleted, runs of Unicode white space to one space, trimmed."""
    bare = F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]++", "")
    # only runs that aren't a single space are replaced
    return F.trim(F.regexp_replace(bare, r"(?U)[\s&&[^ ]]\s*+| \s++", " "))


def ngrams(text: Column, width: int = 60) -> Column:
    """All windows of ``width`` code points; a shorter text is one window, an empty one none.

    Meant for tests and short texts; signatures roll over the text instead.
    """
    n = F.length(text)
    starts = F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)))
    return F.when(n > 0, F.transform(starts, lambda i: F.substring(text, i, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def content_text(content: Column) -> Column:
    """Text of a message content held as VARIANT: a string, or blocks (strings, {"text": ...}) joined by newlines."""
    kind = F.schema_of_variant(content)

    def block(b: Column) -> Column:
        one = F.schema_of_variant(b)
        return F.when(one == "STRING", b.cast("string")).when(one.startswith("OBJECT"), F.try_variant_get(b, "$.text", "string"))

    blocks = F.transform(F.when(kind.startswith("ARRAY"), content.try_cast("array<variant>")), block)
    return F.when(kind == "STRING", content.try_cast("string")).when(
        kind.startswith("ARRAY"), F.array_join(F.filter(blocks, lambda b: b.isNotNull()), "\n")
    ).otherwise(F.lit(""))


def filled(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def record_text(text: Column, messages: Column) -> Column:
    """For pattern scans: a non-empty text, else ``ROLE:\\ncontent`` of the messages with content, numbered from 1 if they have no role."""
    numbered = F.transform(
        messages,
        lambda m, i: F.struct(
            F.upper(F.coalesce(m["role"], F.concat(F.lit("MESSAGE_"), (i + 1).cast("string")))).alias("who"), m["content"].alias("said")
        )
    )
    told = F.transform(F.filter(numbered, lambda m: filled(m["said"])), lambda m: F.concat(m["who"], F.lit(":\n"), m["said"]))
    return F.when(filled(text), text).otherwise(F.coalesce(F.array_join(told, "\n\n"), F.lit("")))


def span_units(text: Column, messages: Column) -> Column:
    """For span models: one unit (index, role, text) for a non-empty text, else one per message with content; the index is null or counts from 0."""
    alone = F.array(F.struct(F.lit(None).cast("int").alias("index"), F.lit("text").alias("role"), text.alias("text")))
    each = F.filter(
        F.transform(messages, lambda m, i: F.struct(i.alias("index"), m["role"].alias("role"), m["content"].alias("text"))),
        lambda u: filled(u["text"])
    )
    return F.when(filled(text), alone).otherwise(F.coalesce(each, F.array().cast("array<struct<index:int,role:string,text:string>>")))


def toxicity_units(text: Column, messages: Column) -> Column:
    """For classifiers: any text, even an empty one, is one unit of role ``user``; else ``role: content`` per message with content."""
    alone = F.array(F.struct(F.lit(None).cast("int").alias("index"), F.lit("user").alias("role"), text.alias("text")))
    each = F.filter(
        F.transform(
            messages,
            lambda m, i: F.struct(
                i.alias("index"), m["role"].alias("role"),
                F.when(filled(m["content"]), F.concat(F.coalesce(m["role"], F.lit("")), F.lit(": "), m["content"])).alias("text")
            )
        ),
        lambda u: u["text"].isNotNull()
    )
    return F.when(text.isNotNull(), alone).otherwise(F.coalesce(each, F.array().cast("array<struct<index:int,role:string,text:string>>")))


def compared_messages(messages: Column, scope: str = "all", exclude_system: bool = False) -> Column:
    """The messages that duplicates are judged by; ``prompt`` drops a final assistant message unless it is the only usable one."""
    usable = F.filter(messages, lambda m: filled(m["content"]) & ((F.coalesce(m["role"], F.lit("")) != "system") if exclude_system else F.lit(True)))
    if scope == "all":
        return usable
    if scope != "prompt":
        raise ValueError(f"unknown scope {scope!r}")
    last = F.element_at(usable, -1)["role"]
    return F.when((F.size(usable) > 1) & (last == "assistant"), F.slice(usable, F.lit(1), F.size(usable) - 1)).otherwise(usable)


def dedup_text(text: Column, messages: Column, scope: str = "all", exclude_system: bool = False) -> Column:
    """For duplicate search: any text, even an empty one, wins; else the compared contents joined by newlines."""
    said = F.array_join(F.transform(compared_messages(messages, scope, exclude_system), lambda m: m["content"]), "\n")
    return F.when(text.isNotNull(), text).otherwise(F.coalesce(said, F.lit("")))


def preview(text: Column, width: int = 160) -> Column:
    """White space folded, at most ``width`` characters."""
    return F.substring(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 1, width)


def loose(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def compact(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"(?U)[\W_]", "")


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def csv_cell(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\\n")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\n"))


def line_fingerprint(raw: Column) -> Column:
    """SHA-256 of a line without its trailing CR and LF bytes."""
    return F.sha2(F.regexp_replace(raw.cast("string"), r"[\r\n]+\z", "").cast("binary"), 256)


def row_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x00", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256)


def midpoint(bands: int, rows: int) -> float:
    """The similarity at which ``bands`` of ``rows`` collide with probability one half."""
    return (1 - 0.5 ** (1 / bands)) ** (1 / rows)


def truncated(text: Column, limit: int, candidate: Column | None = None, mark: str = "\n...[truncated]...\n") -> Column:
    """The head of a text, or a window centred on ``candidate`` if that occurs in it, with marks where text is missing."""
    head = F.concat(F.substring(text, 1, limit), F.lit(mark))
    if candidate is None:
        return F.when(F.length(text) <= limit, text).otherwise(head)
    at = F.call_function("instr", text, candidate)
    start = F.greatest(F.lit(1), F.least(at + F.floor(F.length(candidate) / 2).cast("int") - limit // 2, F.length(text) - limit + 1))
    body = F.substring(text, start, F.lit(limit))
    around = F.concat(F.when(start > 1, F.lit(mark)).otherwise(F.lit("")), body, F.when(start + limit <= F.length(text), F.lit(mark)).otherwise(F.lit("")))
    return F.when(F.length(text) <= limit, text).when(at > 0, around).otherwise(head)
