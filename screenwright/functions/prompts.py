"""Records of unlike shapes, held as VARIANT: prompts, identifiers, replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenwright.functions.text import content_text

MESSAGES = "array<struct<role:string,content:string>>"
# The fields of a record in which a prompt, a context or a name is looked for, in this order.
TEXT_FIELDS = ("question", "Question", "QUESTION", "harmful_medical_request", "Text", "text", "query", "instruction", "prompt")
CONTEXT_FIELDS = ("CONTEXTS", "Knowledge")
OPTION_FIELDS = ("options", "answer_options")
LETTERED_FIELDS = ("opa", "opb", "opc", "opd")
SOURCE_ID_FIELDS = ("id", "sample_id", "question_id", "prompt_id", "Text ID", "canary", "canary_string")
RECORD_ID_FIELDS = ("id", "uuid", "sample_id", "question_id", "task_id")
METADATA_ID_FIELDS = ("benchmark_id", "id", "uuid", "sample_id", "question_id")


def at(record: Column, *path: str) -> Column:
    """What stands at a path of field names, as VARIANT; null if nothing does."""
    return F.try_variant_get(record, "$" + "".join(f"['{p}']" for p in path), "variant")


def kind(value: Column) -> Column:
    """STRING, BIGINT, ARRAY, OBJECT, ...; null for a missing value, VOID for JSON's null."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _string(value: Column) -> Column:
    """The value if it is a string."""
    return F.when(kind(value) == "STRING", value.try_cast("string"))


def normal_messages(value: Column) -> Column:
    """Messages of a list of objects whose content is a string or a list; a missing or empty role is ``user``."""
    each = F.when(kind(value) == "ARRAY", value.try_cast("array<variant>"))
    good = F.filter(each, lambda m: (kind(m) == "OBJECT") & kind(at(m, "content")).isin("STRING", "ARRAY"))
    role = lambda m: F.coalesce(F.nullif(F.try_variant_get(m, "$.role", "string"), F.lit("")), F.lit("user"))
    return F.coalesce(F.transform(good, lambda m: F.struct(role(m).alias("role"), content_text(at(m, "content")).alias("content"))), F.array().cast(MESSAGES))


def options_text(record: Column) -> Column:
    """The options of a question, a line each: ``A. first``; a string that is no JSON stands as it is."""
    given = F.coalesce(*[F.when(kind(at(record, f)) != "VOID", at(record, f)) for f in OPTION_FIELDS])
    parsed = F.when(kind(given) == "STRING", F.try_parse_json(given.try_cast("string"))).otherwise(given)
    empty = F.array().cast("array<struct<k:string,v:string>>")
    listed = F.transform(parsed.try_cast("array<variant>"), lambda v, i: F.struct(F.call_function("char", i + 65).alias("k"), v.try_cast("string").alias("v")))
    named = F.transform(
        F.map_entries(parsed.try_cast("map<string,variant>")), lambda e: F.struct(e["key"].alias("k"), e["value"].try_cast("string").alias("v"))
    )
    has = F.lit(True)
    for f in LETTERED_FIELDS:
        has = has & at(record, f).isNotNull()
    lettered = F.array(*[F.struct(F.lit("ABCD"[i]).alias("k"), at(record, f).try_cast("string").alias("v")) for i, f in enumerate(LETTERED_FIELDS)])
    pairs = F.when(kind(parsed) == "OBJECT", named).when(kind(parsed) == "ARRAY", listed).when(has, lettered).otherwise(empty)
    lines = F.transform(F.filter(pairs, lambda p: F.coalesce(p["v"] != "", F.lit(False))), lambda p: F.concat(p["k"], F.lit(". "), p["v"]))
    raw = given.try_cast("string")
    return F.coalesce(F.when((kind(given) == "STRING") & F.try_parse_json(raw).isNull(), raw).otherwise(F.array_join(lines, "\n")), F.lit(""))


def prompt_messages(record: Column) -> Column:
    """The messages that a benchmark record asks with: its own, or one that is built of its question, context and options; empty if it has none."""
    own = [normal_messages(x) for x in (at(record, "messages"), at(record, "conversation", "messages"), at(record, "prompt"))]
    text = F.coalesce(*[F.nullif(F.regexp_replace(_string(at(record, f)), r"(?U)^\s+|\s+$", ""), F.lit("")) for f in TEXT_FIELDS], F.lit(""))
    context = F.coalesce(*[F.when(kind(at(record, f)) == "ARRAY", at(record, f).try_cast("array<variant>")) for f in CONTEXT_FIELDS])
    said = F.array_join(F.filter(F.transform(context, lambda v: v.try_cast("string")), lambda v: F.coalesce(v != "", F.lit(False))), "\n")
    text = F.when(F.length(said) > 0, F.concat(F.lit("Context:\n"), said, F.lit("\n\nQuestion:\n"), text)).otherwise(text)
    options = options_text(record)
    text = F.when(F.length(options) > 0, F.concat(text, F.lit("\n\nOptions:\n"), options)).otherwise(text)
    built = F.when(F.length(F.trim(text)) > 0, F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))).otherwise(F.array().cast(MESSAGES))
    out = built
    for m in reversed(own):
        out = F.when(F.size(m) > 0, m).otherwise(out)
    return out


def _first_of(record: Column, fields: tuple[str, ...], *within: str) -> Column:
    return F.coalesce(*[F.nullif(at(record, *within, f).try_cast("string"), F.lit("")) for f in fields], F.lit(""))


def source_identifier(record: Column) -> Column:
    """The name that a benchmark gives a record, or an empty string."""
    return _first_of(record, SOURCE_ID_FIELDS)


def record_identifier(record: Column) -> Column:
    """The first identifying field that the record has (lists and objects as JSON), else one of its metadata, else an empty string."""
    out = F.when(kind(at(record, "metadata")) == "OBJECT", _first_of(record, METADATA_ID_FIELDS, "metadata")).otherwise(F.lit(""))
    for f in reversed(RECORD_ID_FIELDS):
        v = at(record, f)
        out = F.when(
            v.isNotNull(), F.when(kind(v).isin("ARRAY", "OBJECT"), F.to_json(v)).otherwise(F.coalesce(v.try_cast("string"), F.lit("None")))
        ).otherwise(out)
    return out


def reply_object(reply: Column) -> Column:
    """The JSON object of a model's reply: all of it, a fenced block, or from the first brace to the last; null if there is none."""
    fenced = F.nullif(F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    braces = F.nullif(F.regexp_extract(reply, r"(?s)(\{.*\})", 1), F.lit(""))
    whole = F.try_parse_json(reply)
    found = F.coalesce(whole, F.try_parse_json(fenced), F.try_parse_json(braces))
    return F.when(kind(found) == "OBJECT", found)


# The fields of a strict verdict on a pattern's hit.
VERDICT_FIELDS = ("confidence", "decision", "evidence", "is_private_person_pii", "is_public_or_business_info", "reason")


def strict_verdict(reply: Column) -> Column:
    """struct<status, decision, confidence, reason>: a verdict that has exactly the known fields, and flags that agree with its decision; else status ``error``."""
    v = reply_object(reply)
    names = F.map_keys(v.try_cast("map<string,variant>"))
    flag = lambda f: F.when(kind(at(v, f)) == "BOOLEAN", at(v, f).try_cast("boolean"))
    private, public = flag("is_private_person_pii"), flag("is_public_or_business_info")
    decision, confidence, reason = (_string(at(v, f)) for f in ("decision", "confidence", "reason"))
    derived = F.when(private & ~public, F.lit("keep")).otherwise(F.lit("filter"))
    same = F.array_sort(names) == F.array(*[F.lit(f) for f in VERDICT_FIELDS])
    ok = same & private.isNotNull() & public.isNotNull() & (decision == derived) & confidence.isin(
        "low", "medium", "high"
    ) & reason.isNotNull() & _string(at(v, "evidence")).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    return F.struct(
        F.when(ok, F.lit("ok")).otherwise(F.lit("error")).alias("status"), F.when(ok, decision).alias("decision"),
        F.when(ok, confidence).alias("confidence"), F.when(ok, F.trim(reason)).alias("reason")
    )


def lenient_verdict(reply: Column) -> Column:
    """struct<status, decision, confidence>: keep only what the model calls private, exact, not public and to be kept; else filter.  Status is ``error`` without an object."""
    v = reply_object(reply)
    flag = lambda f: F.coalesce(at(v, f).try_cast("boolean"), F.lit(False))
    keep = (
        F.coalesce(_string(at(v, "decision")), F.lit("")) == "keep"
    ) & flag("is_private_person_pii") & flag("exact_match_found") & ~flag("is_public_or_business_info")
    return F.struct(
        F.when(v.isNotNull(), F.lit("ok")).otherwise(F.lit("error")).alias("status"), F.when(v.isNotNull(), F.when(keep, F.lit("keep")).otherwise(F.lit("filter"))).alias("decision"),
        F.when(v.isNotNull(), F.coalesce(F.nullif(at(v, "confidence").try_cast("string"), F.lit("")), F.lit("low"))).alias("confidence"),
    )


def yes_no_action(reply: Column) -> Column:
    """The last ``<score>`` of a reply: yes is NOT_GENERAL, no is KEEP_GENERAL, anything else REVIEW."""
    last = F.lower(F.try_element_at(F.regexp_extract_all(reply, F.lit(r"(?is)<score>\s*(yes|no)\s*</score>"), F.lit(1)), F.lit(-1)))
    return F.when(last == "yes", F.lit("NOT_GENERAL")).when(last == "no", F.lit("KEEP_GENERAL")).otherwise(F.lit("REVIEW"))


# The actions that a policy judge may give.
ACTIONS = ("KEEP_GENERAL", "SAFETY_ONLY", "REMOVE", "REVIEW")


def json_action(reply: Column) -> Column:
    """The action of a JSON reply, REVIEW if it names none that is known."""
    action = F.upper(at(reply_object(reply), "action").try_cast("string"))
    return F.when(action.isin(*ACTIONS), action).otherwise(F.lit("REVIEW"))
