"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one integer whose bit *i* says that rule *i* failed; a policy is a mask of
rules, so any version of it, and every ablation, is a bitwise test on that
integer and never reads a text again.

Defined results: a null or empty text has no words (all measurements 0, the
word rules fail); repeated rows each get a row; an empty table gives no rows;
columns other than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwright.llm.words import Block, map_texts, mix, windows

SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_digits long, n_upper long, longest_word long"


def _among(marks: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(marks)] = True
    return out


_IS_SYMBOL, _IS_DIGIT, _IS_UPPER = _among(SYMBOLS), _among(b"0123456789"), _among(bytes(range(65, 91)))


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate over the measurements."""

    name: str
    fails: str


#: The position in this tuple is the bit; append only, so that old ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 50 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("digits", "100 * n_digits > 30 * word_chars"),
    Rule("shouting", "100 * n_upper > 60 * word_chars"),
    Rule("endless_word", "longest_word > 200"),
)
BASE = ("few_words", "repeated_words")
#: Versioned policies: the rules that each of them enforces.
POLICIES = {"base": BASE, "v1": (*BASE, "symbols", "duplicate_lines", "long_words"), "v2": tuple(r.name for r in RULES)}


def mask(names) -> int:
    at = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(at[n] for n in set(names))


def measure(texts: list[bytes]) -> list[np.ndarray]:
    """The measurements of each text, in the order of MEASURES."""
    b = Block(texts)
    n, doc = len(texts), b.doc_of_words()

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[b.offset[1:]] - total[b.offset[:-1]]

    solid = ~b.space
    begins = solid & ((b.buf & 0xC0) != 0x80)  # the first bytes of the code points of words
    chars = per_text(begins)
    symbols, digits, upper = (per_text(flags[b.buf]) for flags in (_IS_SYMBOL, _IS_DIGIT, _IS_UPPER))
    points = np.concatenate(([0], np.cumsum(begins)))
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, doc, points[b.end] - points[b.start])

    end = np.flatnonzero(b.buf == 10)
    begin = np.concatenate(([0], end[:-1] + 1))
    solids = np.concatenate(([0], np.cumsum(solid)))
    full = solids[end] > solids[begin]
    begin, end = begin[full], end[full]
    of = np.searchsorted(b.offset, begin, side="right") - 1
    key = np.sort(mix(b.hash_spans(begin, end) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    lines = np.bincount(of, minlength=n)
    dup_lines = np.zeros(n, dtype=np.int64)
    if (key[1:] == key[:-1]).any():
        h = b.hash_spans(begin, end)
        order = np.lexsort((h, of))
        same = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
        dup_lines = np.bincount(of[order][1:][same], minlength=n)

    h = b.hash_spans(b.start, b.end)
    wh, wlo, whi = windows(h, b.lo, b.hi, 3)
    wdoc = np.repeat(np.arange(n), whi - wlo)
    with np.errstate(over="ignore"):
        key = mix(wh + wdoc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    repeat = np.zeros(n, dtype=np.int64)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        hit = np.flatnonzero(twice[at] == key)
        word = hit - wlo[wdoc[hit]] + b.lo[wdoc[hit]]
        covered = np.zeros(len(h), dtype=bool)
        for k in range(3):
            covered[word + k] = True
        repeat = np.bincount(doc[covered], minlength=n)
    return [b.hi - b.lo, chars, symbols, lines, dup_lines, repeat, digits, upper, longest]


def fail_bits() -> Column:
    out = F.lit(0)
    for i, r in enumerate(RULES):
        out = out.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)))
    return out


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the measurements and ``fail_bits`` (int) of every row."""
    return map_texts(docs, [key], text, measure, MEASURES).withColumn("fail_bits", fail_bits())


def passes(policy: str) -> Column:
    """Whether a row of a ledger passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """(rule, failed, failed_alone, kept_without): what each rule of a policy does.

    Rows are first counted by their bits (2**rules groups at most, combined on
    the map side), so that the rest works on a table of bounded size.
    """
    m = mask(POLICIES[policy])
    by = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    rules = [(r.name, 1 << i) for i, r in enumerate(RULES) if m >> i & 1]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in rules]))
    return (
        by.select("bits", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
        )
    )


def op3(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_digits", "n_upper", "longest_word", "fail_bits",
        (~passes("base")).alias("base_failed"), passes("v1").alias("kept"),
    )


def op3_ablations(spark, sf_dir: str) -> DataFrame:
    """What each rule of the widest policy does on the documents, from the ledger's bits alone."""
    from screenwright.llm.tables import table
    from screenwright.storage import materialize

    rows = materialize(ledger(table(spark, sf_dir, "documents")).select("fail_bits"), "ledger")
    return ablations(rows, "v2")


_LEDGER = r"""d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
often AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
lines AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(text, '[^0-9]', '', 'g'))::BIGINT AS n_digits,
  length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper, coalesce(list_max(list_transform(w, lambda x: length(x))), 0)::BIGINT AS longest_word,
  coalesce(dup.n_lines, 0) AS n_lines, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 50 * n_words)::INT
  + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars > 20 * n_words)::INT + 32 * (word_chars < 2 * n_words)::INT
  + 64 * (100 * n_digits > 30 * word_chars)::INT + 128 * (100 * n_upper > 60 * word_chars)::INT + 256 * (longest_word > 200)::INT)::INT AS fail_bits FROM m)"""
SQL = f"""WITH {_LEDGER} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_digits, n_upper, longest_word, fail_bits,
  (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 31) = 0 AS kept FROM b"""
ABLATIONS_SQL = f"""WITH {_LEDGER}, r AS (SELECT unnest(['few_words', 'repeated_words', 'symbols', 'duplicate_lines', 'long_words', 'short_words', 'digits', 'shouting', 'endless_word']) AS rule, unnest([1, 2, 4, 8, 16, 32, 64, 128, 256]) AS bit)
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS failed, count(*) FILTER (fail_bits = bit) AS failed_alone, count(*) FILTER (fail_bits & (511 - bit) = 0) AS kept_without FROM b, r GROUP BY rule"""
