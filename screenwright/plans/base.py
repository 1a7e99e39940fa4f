"""Row contract over the driver tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwright.functions.text import PUNCTUATION
from screenwright.storage import spread


_Q: dict = {}
_SQL: dict = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) as a query, with its SQL if there is one."""
    def add(f):
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    held = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(held) if name == "documents" else held


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as contract rows: the source is the file, the id the line."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("source_file"), F.col("doc_id").alias("source_line"), F.sha2(F.col("text").cast("binary"), 256).alias("source_sha256"),
        "text"
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, text, messages): conversations as contract rows; a conversation fits a row as a training sample does."""
    c = table(spark, sf_dir, "conversations")
    held = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    return held.select(
        "conv_id", F.lit(None).cast("string").alias("text"),
        F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )


def scores(text: Column) -> Column:
    """Stand-in for an injected classifier: a map of two scores made of the text's length."""
    n = F.length(text).cast("double")
    return F.create_map(F.lit("insult"), (n % 97) / F.lit(97.0), F.lit("toxicity"), (n % 101) / F.lit(101.0))




def norm(expression: str) -> str:
    """SQL of the normalised text."""
    return f"trim(regexp_replace(translate(lower({expression}), '{_MARKS}', ''), '\\s+', ' ', 'g'))"


_MARKS = PUNCTUATION.replace("'", "''")
NORMED = f"""n AS (SELECT source, doc_id, text, norm, CASE WHEN length(norm) > 0 THEN sha256(norm) END AS digest
  FROM (SELECT *, {norm("text")} AS norm FROM documents))"""
#: Decisions among all documents: the earliest of a group by (source, doc_id) is kept.
DECIDED = f"""{NORMED}, first AS (SELECT digest, min(struct_pack(s := source, l := doc_id)) AS o FROM n WHERE digest IS NOT NULL GROUP BY digest HAVING count(*) > 1),
dec AS (SELECT n.source AS source_file, n.doc_id AS source_line, o.s AS original_source_file, o.l AS original_source_line FROM n JOIN first USING (digest) WHERE NOT (n.source = o.s AND n.doc_id = o.l))"""
EMAIL, IP, CARD, PHONE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    r"[0-9](?:[ -]?[0-9]){12,18}", r"(?:\+?1[-. ]?)?\(?[2-9][0-9]{2}\)?[-. ][0-9]{3}[-. ][0-9]{4}",
)
HITS = "h AS (" + " UNION ALL ".join(
    f"SELECT source AS source_file, doc_id AS source_line, '{c}' AS category, unnest(list_distinct(regexp_extract_all(text, '{p}', 0))) AS value FROM documents"
    for c, p in (("emails", EMAIL), ("ips", IP), ("credit_cards", CARD), ("phones", PHONE))
) + ")"
_D = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""(list_sum(list_transform(range(1, length({_D}) + 1), lambda i: CASE WHEN (length({_D}) - i) % 2 = 1
  THEN [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr({_D}, i, 1)::INT + 1] ELSE substr({_D}, i, 1)::INT END)) % 10 = 0)"""
_N = f"CASE WHEN length({_D}) = 11 THEN substr({_D}, 2) ELSE {_D} END"
VALID = f"""valid AS (SELECT * FROM (SELECT *, trim(value, ' ()[]') AS v, trim(value) AS e FROM h) WHERE CASE category
  WHEN 'emails' THEN split_part(e, '@', 2) NOT IN ('example.com', 'example.net', 'example.org', 'localhost') AND NOT regexp_matches(lower(e), '\\.(example|invalid|test|localhost)$')
    AND NOT regexp_matches(split_part(e, '@', 1), '^\\.|\\.$|\\.\\.') AND regexp_full_match(lower(split_part(e, '@', 2)), '([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?\\.)*[a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?')
    AND length(split_part(e, '@', 1)) <= 64
  WHEN 'ips' THEN list_bool_and(list_transform(string_split(v, '.'), lambda x: x::INT <= 255 AND (x = '0' OR x[1] <> '0'))) AND v <> '0.0.0.0'
    AND NOT regexp_matches(v, '^(127\\.|169\\.254\\.|192\\.0\\.2\\.|198\\.51\\.100\\.|203\\.0\\.113\\.)') AND split_part(v, '.', 1)::INT < 224
  WHEN 'credit_cards' THEN length({_D}) BETWEEN 13 AND 19 AND len(list_distinct(string_split({_D}, ''))) > 2 AND {_D} NOT IN ('378282246310005', '4012888888881881', '4111111111111111', '4222222222222', '5555555555554444', '6011111111111117') AND {_LUHN}
  ELSE NOT regexp_matches({_N}, '^[01]|^...[01]|^(800|833|844|855|866|877|888|300|333|555)|^...555|(1234|5678)$|^(0123456789|1234567890|9876543210)$') AND NOT regexp_matches(v, '[*/=]')
    AND NOT regexp_matches(v, '^1\\.[0-9]{{3}}[-.][0-9]{{3}}[-.][0-9]{{4}}$') AND regexp_matches(v, '[()+\\-\\s]') AND (length({_D}) <> 11 OR v LIKE '+%' OR regexp_matches(v, '^1[-. (]'))
  END)"""
#: Conversations with their turns in order, and the four texts that scanners read.
TURNS = "t AS (SELECT conv_id, turn, role, coalesce(text, '') AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM conversations)"
USED = f"{TURNS}, u AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS k FROM t WHERE length(content) > 0 AND role <> 'system')"
PROMPT = f"{USED}, p AS (SELECT * FROM u WHERE NOT (c > 1 AND k = c AND role = 'assistant'))"
#: Scores, verdicts and outcomes of the stand-in classifier over messages.
UNITS = f"{TURNS}, m AS (SELECT conv_id, i AS message_index, role, role || ': ' || content AS text FROM t WHERE length(content) > 0), s AS (SELECT *, (length(text)::DOUBLE % 97) / 97.0::DOUBLE AS a, (length(text)::DOUBLE % 101) / 101.0::DOUBLE AS b FROM m)"
