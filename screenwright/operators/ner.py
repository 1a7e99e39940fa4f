"""Span models: constrained decoding of BIOES scores, windows, thresholds, tallies."""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the default candidate policy.
TIERS = {"contextual": None, "person_linked": 0.9, "direct_identifier": 0.7}
LABELS = {
    "user_name": 0.95, "first_name": 0.9, "last_name": 0.9, "street_address": 0.8, "ssn": 0.8, "date_of_birth": 0.7, "email": 0.5, "phone_number": 0.5, "fax_number": 0.5,
    "postcode": 0.5, "medical_record_number": 0.5, "health_plan_beneficiary_number": 0.5, "national_id": 0.5, "tax_id": 0.5, "credit_debit_card": 0.5, "private_person": 0.99,
    "private_address": 0.5, "private_date": None, "private_email": 0.5, "private_phone": 0.5, "private_url": 0.5, "account_number": 0.5, "secret": 0.5,
}
MARKUP = ("think", "analysis", "reasoning", "tool", "tool_call", "tool_response", "assistant", "user", "system", "developer")
IGNORED = ("correct", "incorrect")


@dataclass(frozen=True)
class Policy:
    tiers: dict = field(default_factory=lambda: dict(TIERS))
    labels: dict = field(default_factory=lambda: dict(LABELS))
    markup: tuple = MARKUP
    ignored: tuple = IGNORED
    version: int = 4


def decide(policy: Policy, label: Column, tier: Column, confidence: Column, span: Column, text: Column, start: Column, end: Column) -> Column:
    """struct<eligible, threshold, reason>: contextual_tier, control_markup, known_non_pii_token, below_confidence_threshold, or eligible."""

    def table(values: dict) -> Column:
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("double"))])

    own, by_tier = table(policy.labels), table(policy.tiers)
    threshold = F.when(F.map_contains_key(own, label), own[label]).when(F.map_contains_key(by_tier, tier), by_tier[tier]).otherwise(
        F.raise_error(F.concat(F.lit("no threshold for tier "), F.coalesce(tier, F.lit("null")))).cast("double")
    )
    names = "|".join(policy.markup)
    tag = rf"(?i)</?\s*(?:{names})\b[^<>]*>"
    exact = F.regexp_replace(span, r"(?U)\s+", "").rlike(rf"(?i)^</?(?:{names})/?>\z")
    # tags and the gaps between them alternate, which gives their places
    tags = F.regexp_extract_all(text, F.lit(tag), F.lit(0))
    gaps = F.split(text, tag, -1)
    lengths = lambda parts, upto: F.aggregate(F.slice(parts, F.lit(1), upto), F.lit(0), lambda a, p: a + F.length(p))
    places = F.transform(tags, lambda t, i: F.struct((lengths(gaps, i + 1) + lengths(tags, i)).alias("s"), F.length(t).alias("n")))
    beside = F.exists(places, lambda p: (p["s"] < end) & (start < p["s"] + p["n"]))
    reason = (
        F.when(threshold.isNull(), F.lit("contextual_tier")).when(exact | beside, F.lit("control_markup"))
        .when(F.lower(F.trim(span)).isin(*policy.ignored), F.lit("known_non_pii_token")).when(confidence < threshold, F.lit("below_confidence_threshold"))
    )
    return F.struct(reason.isNull().alias("eligible"), threshold.alias("threshold"), reason.alias("reason"))


def tally(spans: DataFrame, location: list[str]) -> DataFrame:
    """(label, tier, spans, eligible, rows)."""
    return spans.groupBy("label", "tier").agg(
        F.count("*").alias("spans"), F.sum(F.col("eligible").cast("long")).alias("eligible"), F.countDistinct(*location).alias("rows")
    )


def compare(left: DataFrame, right: DataFrame, key: list[str], by: str) -> DataFrame:
    """(by, n_left, n_right, n_both): how two sets of spans overlap."""
    a, b = left.select(*key).distinct().withColumn("_l", F.lit(1)), right.select(*key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.groupBy(by).agg(
        F.count("_l").alias("n_left"), F.count("_r").alias("n_right"),
        F.sum((F.col("_l").isNotNull() & F.col("_r").isNotNull()).cast("long")).alias("n_both")
    )


def f1(both: Column, left: Column, right: Column) -> Column:
    """F1 with 0 for empty denominators, 1 if both sides are empty."""
    p, r = F.when(left > 0, both / left).otherwise(F.lit(0.0)), F.when(right > 0, both / right).otherwise(F.lit(0.0))
    return F.when((left == 0) & (right == 0), F.lit(1.0)).when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def tag_parts(tag: str) -> tuple[str, str]:
    """("B", "email") of ``B-email``; ("O", "") of ``O``."""
    if tag == "O":
        return "O", ""
    m = re.fullmatch(r"([BIES])-(.+)", tag)
    if not m:
        raise ValueError(f"not a BIOES tag: {tag!r}")
    return m.group(1), m.group(2)


def allowed(tags: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, step) masks: which tags may open and close a path, and which may follow which."""
    parts = [tag_parts(t) for t in tags]
    closed = np.array([k in "OES" for k, _ in parts])
    opens = np.array([k in "OBS" for k, _ in parts])
    inner = np.array([k in "IE" for k, _ in parts])
    same = np.array([[a[1] == b[1] for b in parts] for a in parts])
    step = (closed[:, None] & opens[None, :]) | (~closed[:, None] & inner[None, :] & same)
    return opens, closed, step


def viterbi(scores: np.ndarray, tags: list[str]) -> list[int]:
    """The best path through log scores [token, tag] that BIOES allows."""
    if not len(scores):
        return []
    opens, closed, step = allowed(tags)
    gate = np.where(step, 0.0, -np.inf)
    best = np.where(opens, scores[0], -np.inf)
    back = np.zeros(scores.shape, dtype=np.int64)
    for t in range(1, len(scores)):
        via = best[:, None] + gate
        back[t] = via.argmax(axis=0)
        best = via.max(axis=0) + scores[t]
    path = [int(np.where(closed, best, -np.inf).argmax())]
    for t in range(len(scores) - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


def spans_of(path: list[int], tags: list[str], offsets: list[tuple[int, int]], probabilities: np.ndarray, text: str) -> list[tuple[str, int, int, float]]:
    """(label, start, end, confidence): the spans of a path; white space at the ends is left out, the confidence is the mean probability."""
    out, first = [], None
    for t, k in enumerate(path):
        kind, label = tag_parts(tags[k])
        if kind in "BS":
            first = t
        if kind in "ES" and first is not None:
            start, end = offsets[first][0], offsets[t][1]
            piece = text[start:end]
            start, end = start + len(piece) - len(piece.lstrip()), end - (len(piece) - len(piece.rstrip()))
            if start < end:
                out.append((label, start, end, float(np.mean([probabilities[i, path[i]] for i in range(first, t + 1)]))))
            first = None
        if kind == "O":
            first = None
    return out


def merge_windows(spans: list[tuple[str, int, int, float]], least: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Of spans of one label that overlap by ``least`` of the shorter one, the most confident stays."""
    starts: dict[str, list[tuple[int, int]]] = {}
    longest: dict[str, int] = {}
    kept: list[tuple[str, int, int, float]] = []
    for label, start, end, confidence in sorted(spans, key=lambda s: (-s[3], s[1], s[2], s[0])):
        own = starts.setdefault(label, [])
        # of those that were kept, only neighbours can reach into this one
        near = own[bisect.bisect_left(own, (start - longest.get(label, 0), 0)) : bisect.bisect_left(own, (end, 0))]
        if not any(min(end, e) - max(start, s) >= least * min(end - start, e - s) for s, e in near if e > start):
            bisect.insort(own, (start, end))
            longest[label] = max(longest.get(label, 0), end - start)
            kept.append((label, start, end, confidence))
    return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


def windows(n: int, size: int = 4096, overlap: int = 256) -> list[tuple[int, int]]:
    """[start, end) token windows that cover ``n`` tokens, neighbours sharing ``overlap``."""
    if overlap >= size:
        raise ValueError("the overlap must be smaller than a window")
    out, at = [], 0
    while n and (not out or out[-1][1] < n):
        out.append((at, min(n, at + size)))
        at += size - overlap
    return out


def scan(unit_rows: DataFrame, backend, tags: list[str], id: str = "unit_id", text: str = "text") -> DataFrame:
    """(id, label, start, end, text, confidence) from an injected backend: ``backend(text)`` gives (offsets, probabilities [token, tag])."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for u, t in zip(frame["id"], frame["text"], strict=True):
                offsets, p = backend(t or "")
                found = []
                for a, b in windows(len(offsets)):
                    part = np.asarray(p[a:b], dtype=np.float64)
                    found += spans_of(viterbi(np.log(np.maximum(part, 1e-12)), tags), tags, offsets[a:b], part, t)
                out += [(u, label, s, e, t[s:e], c) for label, s, e, c in merge_windows(found)]
            yield pd.DataFrame(out, columns=["id", "label", "start", "end", "text", "confidence"])

    rows = unit_rows.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "id string, label string, start int, end int, text string, confidence double")


def matched_by_overlap(left: list[tuple[str, int, int]], right: list[tuple[str, int, int]], least: float) -> int:
    """One-to-one matches of spans of one label whose intersection over union is at least ``least``, largest first."""
    pairs = []
    for i, (a, s, e) in enumerate(left):
        for j, (b, t, f) in enumerate(right):
            inter = min(e, f) - max(s, t)
            if a == b and inter > 0:
                iou = inter / (max(e, f) - min(s, t))
                if iou >= least:
                    pairs.append((-iou, i, j))
    used_l, used_r = set(), set()
    for _, i, j in sorted(pairs):
        if i not in used_l and j not in used_r:
            used_l.add(i)
            used_r.add(j)
    return len(used_l)


# Shared names for the labels of several models and of the pattern scan.
CATEGORY_OF = {
    "private_address": "address", "street_address": "address", "postcode": "address", "coordinate": "address", "private_date": "date", "date_of_birth": "date",
    "private_email": "email", "email": "email", "private_person": "person", "first_name": "person", "last_name": "person", "private_phone": "phone", "phone_number": "phone",
    "fax_number": "phone", "private_url": "url", "url": "url", "user_name": "account", "account_number": "account", "password": "secret", "pin": "secret", "cvv": "secret", "secret": "secret",
}
LABEL_OF_PATTERN = {
    "btc_addresses": "account_number", "credit_cards": "credit_debit_card", "emails": "email", "ips": "ipv4", "ipv6s": "ipv6", "phones": "phone_number", "phones_with_exts": "phone_number",
    "po_boxes": "street_address", "postcodes": "postcode", "street_addresses": "street_address", "zip_codes": "postcode",
}
LABEL_OF_MODEL = {
    "private_email": "email", "private_phone": "phone_number", "private_address": "street_address", "private_person": "person_name",
    "private_url": "url", "private_date": "date_of_birth"
}


def mapped_label(label: Column, names: dict[str, str]) -> Column:
    """A label under its shared name; others stay as they are."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), label), label)


def highlight(text: Column, start: Column, end: Column, shown: int | None = None) -> Column:
    """struct<matched, why>: the text of a span, or why it can't be placed: no such message, outside of its text, beyond what is shown."""
    inside = F.coalesce((start >= 0) & (start < end) & (end <= F.length(text)), F.lit(False))
    beyond = (end > shown) if shown is not None else F.lit(False)
    why = F.when(text.isNull(), F.lit("no such message")).when(~inside, F.lit("outside of the text")).when(beyond, F.lit("beyond the part that is shown"))
    return F.struct(F.when(why.isNull(), F.substring(text, start + 1, end - start)).alias("matched"), why.alias("why"))


def overlapping(left: DataFrame, right: DataFrame, key: list[str], least: float) -> DataFrame:
    """(key..., label, a_start, a_end, b_start, b_end, overlap): pairs of spans (key..., label, start, end) of a text with the same label that overlap by ``least`` or more of their union."""
    a = left.select(*key, "label", F.col("start").alias("a_start"), F.col("end").alias("a_end"))
    b = right.select(*key, "label", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    both = F.greatest(F.lit(0), F.least("a_end", "b_end") - F.greatest("a_start", "b_start"))
    union = F.greatest("a_end", "b_end") - F.least("a_start", "b_start")
    overlap = F.when(union > 0, both / union).otherwise(F.lit(1.0))
    return a.join(b, [*key, "label"]).withColumn("overlap", overlap).where(F.col("overlap") >= least)


def matched_spans(left: DataFrame, right: DataFrame, key: list[str], least: float) -> DataFrame:
    """(key..., n_left, n_right, n_matched): spans matched one to one, pairs of the largest overlap first (then the later positions).

    The greedy choice runs over the pairs of one text, which a task holds.
    """
    pairs = overlapping(left, right, key, least)
    gathered = pairs.groupBy(*key).agg(F.collect_list(F.struct("overlap", "label", "a_start", "a_end", "b_start", "b_end")).alias("pairs"))

    def greedy(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in batch.column("pairs").to_pylist():
                used: set[tuple] = set()
                n = 0
                for p in sorted(row, key=lambda p: (-p["overlap"], p["label"], p["a_start"], p["a_end"], p["b_start"], p["b_end"])):
                    a, b = ("a", p["label"], p["a_start"], p["a_end"]), ("b", p["label"], p["b_start"], p["b_end"])
                    if a not in used and b not in used:
                        used |= {a, b}
                        n += 1
                out.append(n)
            kept = [n for n in batch.schema.names if n != "pairs"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(out, type=pa.int64())], names=[*kept, "n_matched"])

    kinds = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in key)
    n = gathered.mapInArrow(greedy, f"{kinds}, n_matched long")
    a = left.groupBy(*key).agg(F.count("*").alias("n_left"))
    b = right.groupBy(*key).agg(F.count("*").alias("n_right"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return a.join(b, key, "full_outer").join(n, key, "left").select(*key, zero("n_left"), zero("n_right"), zero("n_matched"))
