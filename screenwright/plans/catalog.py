"""Registry of the queries of the screening engine, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwright.functions import text as T
from screenwright.functions.validators import validated
from screenwright.operators import dedup, filtering, ner, pii, quality, reports, toxicity
from screenwright.operators.numbering import numbered
from screenwright.plans import base as B
from screenwright.plans.base import chats, query, rows, table
from screenwright.storage import materialize

FLAGSHIP = "filter_decisions"
LOC = ["source_file", "source_line"]
def queries() -> dict:
    return dict(B._Q)


def oracle_sql() -> dict:
    return dict(B._SQL)


# --- rows, fingerprints, normalisation -------------------------------------------------


@query(f"WITH {B.NORMED} SELECT doc_id, length(norm)::BIGINT AS norm_chars, md5(norm) AS norm_md5 FROM n")
def normalize_documents(spark, d) -> DataFrame:
    n = T.normalize(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.length(n).cast("long").alias("norm_chars"), F.md5(n.cast("binary")).alias("norm_md5"))


@query("SELECT source AS source_file, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS source_line FROM documents")
def row_locations(spark, d) -> DataFrame:
    held = table(spark, d, "documents").select(F.col("source").alias("source_file"), "doc_id")
    return numbered(held, ["doc_id"], ["source_file"], "source_line")


@query("SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS source_order FROM documents")
def source_order(spark, d) -> DataFrame:
    return numbered(table(spark, d, "documents").select("source", "doc_id"), ["source", "doc_id"], name="source_order").select("doc_id", "source_order")


@query("SELECT doc_id, sha256(regexp_replace(text, '[\\r\\n]+$', '')) AS fingerprint FROM documents")
def line_fingerprints(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.line_fingerprint(F.col("text")).alias("fingerprint"))


@query("SELECT source AS source_file, count(*) AS n_rows, sum(strlen(text))::BIGINT AS n_bytes FROM documents GROUP BY source")
def file_manifest(spark, d) -> DataFrame:
    return rows(spark, d).groupBy("source_file").agg(F.count("*").alias("n_rows"), F.sum(F.octet_length("text")).cast("long").alias("n_bytes"))


# --- exact duplicates ------------------------------------------------------------------


def _decided(spark, d) -> DataFrame:
    return dedup.decisions(dedup.digests(rows(spark, d), LOC, F.col("text")), "digest", LOC, LOC)


@query(f"WITH {B.DECIDED} SELECT * FROM dec")
def duplicate_decisions_exact(spark, d) -> DataFrame:
    return _decided(spark, d)


@query(f"WITH {B.NORMED} SELECT digest, count(*) AS n_rows, min(doc_id) AS first_doc FROM n WHERE digest IS NOT NULL GROUP BY digest HAVING count(*) > 1")
def exact_duplicates(spark, d) -> DataFrame:
    g = dedup.exact_groups(rows(spark, d), F.col("text")).where("digest is not null")
    return g.groupBy("digest").agg(F.count("*").alias("n_rows"), F.min("source_line").alias("first_doc")).where("n_rows > 1")


@query(f"WITH {B.DECIDED} SELECT documents.source AS source_file, count(*) AS n_rows, count(dec.source_line) AS n_removed, count(*) - count(dec.source_line) AS n_kept FROM documents LEFT JOIN dec ON doc_id = dec.source_line GROUP BY 1")
def dedup_kept_removed(spark, d) -> DataFrame:
    gone = _decided(spark, d).select(*LOC, F.lit(1).alias("gone"))
    out = rows(spark, d).select(*LOC).join(gone, LOC, "left").groupBy("source_file").agg(F.count("*").alias("n_rows"), F.count("gone").alias("n_removed"))
    return out.withColumn("n_kept", F.col("n_rows") - F.col("n_removed"))


@query(f"WITH {B.NORMED} SELECT source AS source_file, count(*) AS rows_read, count(digest) AS rows_with_text, count(*) - count(digest) AS rows_without_text FROM n GROUP BY source")
def dup_per_file_summary(spark, d) -> DataFrame:
    g = dedup.exact_groups(rows(spark, d), F.col("text"))
    return g.groupBy("source_file").agg(
        F.count("*").alias("rows_read"), F.count("digest").alias("rows_with_text"),
        F.sum(F.col("digest").isNull().cast("long")).alias("rows_without_text")
    )


@query(f"WITH {B.DECIDED} SELECT source_file, original_source_file AS kept_in, count(*) AS n_rows FROM dec GROUP BY ALL")
def duplicates_across_sources(spark, d) -> DataFrame:
    return _decided(spark, d).groupBy("source_file", F.col("original_source_file").alias("kept_in")).agg(F.count("*").alias("n_rows"))


_RANKED = "CASE source WHEN 'src7' THEN 0 WHEN 'src3' THEN 1 ELSE 2 END"


@query(f"""WITH {B.NORMED}, first AS (SELECT digest, min(struct_pack(r := {_RANKED}, s := source, l := doc_id)) AS o FROM n WHERE digest IS NOT NULL GROUP BY digest HAVING count(*) > 1)
SELECT doc_id, o.s AS kept_in, o.l AS original FROM n JOIN first USING (digest) WHERE doc_id <> o.l""")
def dup_priority_order(spark, d) -> DataFrame:
    ranked = dedup.digests(rows(spark, d), LOC, F.col("text")).withColumn("rank", dedup.priority_order(F.col("source_file"), ["src3"], ["src7"]))
    out = dedup.decisions(ranked, "digest", ["rank", *LOC], LOC)
    return out.select(F.col("source_line").alias("doc_id"), F.col("original_source_file").alias("kept_in"), F.col("original_source_line").alias("original"))


@query(f"WITH {B.DECIDED} SELECT source_file, count(*) AS n_removed FROM dec WHERE source_file NOT IN ('src7', 'src3') GROUP BY 1")
def dup_protected(spark, d) -> DataFrame:
    return _decided(spark, d).where(~F.col("source_file").isin("src7", "src3")).groupBy("source_file").agg(F.count("*").alias("n_removed"))


@query(f"WITH {B.DECIDED} SELECT * FROM dec WHERE source_file LIKE 'src1%' AND original_source_file LIKE 'src%' AND length(original_source_file) = 4")
def dup_glob_rules(spark, d) -> DataFrame:
    return _decided(spark, d).where(dedup.glob_rule(F.col("source_file"), F.col("original_source_file"), ["src1*::src?"]))


@query(f"WITH {B.DECIDED} SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT source_line FROM dec)")
def exact_kept_rows(spark, d) -> DataFrame:
    gone = _decided(spark, d).select(F.col("source_line").alias("doc_id"))
    return table(spark, d, "documents").select("doc_id", "source").join(gone, "doc_id", "left_anti")


# --- near duplicates and contamination -------------------------------------------------


@query(f"""WITH b AS (SELECT doc_id, {B.norm("text")} AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) = 0 THEN 0 ELSE len(list_distinct(list_transform(range(1, greatest(length(t) - 59, 1) + 1), lambda i: substr(t, i, 60)))) END::BIGINT AS n_shingles FROM b""")
def char_ngrams_count(spark, d) -> DataFrame:
    return dedup.distinct_windows(table(spark, d, "documents"), "doc_id", F.col("text"), 60)


_MD5 = f"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
x AS (SELECT doc_id * 2147483648 + i AS doc_id, {B.norm("text")} AS t FROM l), y AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(length(t) - 59, 1) + 1), lambda i: substr(t, i, 60))) AS g FROM x WHERE length(t) > 0),
z AS (SELECT doc_id, unnest([0, 1]) AS band, unnest([list_min(list_transform(g, lambda v: md5('0:' || v))) || '|' || list_min(list_transform(g, lambda v: md5('1:' || v))),
  list_min(list_transform(g, lambda v: md5('2:' || v))) || '|' || list_min(list_transform(g, lambda v: md5('3:' || v)))]) AS hash FROM y),
e AS (SELECT DISTINCT doc_id AS a, b FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY band, hash) AS b FROM z) WHERE doc_id <> b)"""


def _md5_edges(spark, d) -> DataFrame:
    # a text has fewer than 2**31 lines
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text"))
    lines = lines.select((F.col("doc_id") * 2147483648 + F.col("i")).alias("id"), "text")
    return dedup.star_edges(materialize(dedup.md5_bands(lines, "id", F.col("text"), 2, 2), "md5-bands"))


@query(f"WITH {_MD5} SELECT a, b FROM e")
def minhash_links_md5(spark, d) -> DataFrame:
    return _md5_edges(spark, d)


@query(f"""WITH RECURSIVE {_MD5}, s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS root FROM s UNION SELECT s.b, r.root FROM r JOIN s ON s.a = r.node)
SELECT node, min(root) AS component FROM r GROUP BY node""")
def minhash_components_md5(spark, d) -> DataFrame:
    from screenwright.operators.components import connected_components

    return connected_components(_md5_edges(spark, d))


@query()
def near_duplicates_lsh(spark, d) -> DataFrame:
    return dedup.near_duplicates(table(spark, d, "documents"), "doc_id", F.col("text"))


@query()
def candidate_pairs_lsh(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    made = dedup.signed(docs, ["id"], F.col("text"), dedup.BANDS, dedup.ROWS, dedup.WIDTH)
    bands = materialize(dedup.copies_of(made), "copies").select(F.posexplode("bands").alias("band", "hash"))
    return bands.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1").groupBy("band").agg(
        F.count("*").alias("n_buckets"), F.max("n").alias("largest")
    )


@query()
def contamination_lsh(spark, d) -> DataFrame:
    return dedup.cross_pairs(table(spark, d, "documents"), table(spark, d, "benchmark"), "doc_id", "item_id", F.col("text"), F.col("text"), 64, 4)


_CONTAINED = f"""i AS (SELECT item_id, string_split(t, ' ') AS w FROM (SELECT item_id, {B.norm("text")} AS t FROM benchmark) WHERE length(t) > 0),
iw AS (SELECT DISTINCT item_id, least(len(w), 8) AS n, array_to_string(list_slice(w, k, k + least(len(w), 8) - 1), ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS k FROM i)),
dw AS (SELECT doc_id, source, string_split(t, ' ') AS w FROM (SELECT doc_id, source, {B.norm("text")} AS t FROM documents) WHERE length(t) > 0),
dg AS (SELECT doc_id, source, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM dw, (SELECT DISTINCT n FROM iw))),
pairs AS (SELECT DISTINCT doc_id, source, item_id FROM dg JOIN iw USING (n, g))"""


def _contained(spark, d) -> DataFrame:
    """(doc_id, source, item_id): documents that hold 8 successive normalised words of a benchmark item from anywhere in it, or all of a shorter item."""
    return dedup.containing(table(spark, d, "documents"), table(spark, d, "benchmark"), ["doc_id", "source"], "item_id", F.col("text"), F.col("text"))


@query(f"WITH {_CONTAINED} SELECT * FROM pairs")
def contamination_exact(spark, d) -> DataFrame:
    return _contained(spark, d)


@query(f"""WITH {_CONTAINED}, g AS (SELECT item_id, item_id % 4 AS bench FROM benchmark)
SELECT bench, count(DISTINCT g.item_id) AS hashed, count(DISTINCT pairs.item_id) AS contaminated, count(DISTINCT doc_id) AS matched_rows,
  round(100.0::DOUBLE * count(DISTINCT pairs.item_id) / count(DISTINCT g.item_id), 4) AS percent FROM g LEFT JOIN pairs USING (item_id) GROUP BY bench""")
def contamination_by_benchmark(spark, d) -> DataFrame:
    items = table(spark, d, "benchmark").select("item_id", (F.col("item_id") % 4).alias("bench"))
    pairs = _contained(spark, d).join(items, "item_id")
    return dedup.contamination(pairs, items, "bench", "item_id", "doc_id")


@query(f"WITH {_CONTAINED} SELECT source, count(*) AS n_pairs, count(DISTINCT doc_id) AS n_rows, count(DISTINCT item_id) AS n_items FROM pairs GROUP BY source")
def contamination_by_source(spark, d) -> DataFrame:
    return _contained(spark, d).groupBy("source").agg(
        F.count("*").alias("n_pairs"), F.countDistinct("doc_id").alias("n_rows"), F.countDistinct("item_id").alias("n_items")
    )


@query(f"WITH {_CONTAINED} SELECT doc_id, min(item_id) AS item_id FROM pairs GROUP BY doc_id")
def cross_decisions_earliest(spark, d) -> DataFrame:
    return dedup.earliest(_contained(spark, d), ["doc_id"], ["item_id"])


@query(f"WITH {_CONTAINED} SELECT doc_id, source, length(text)::BIGINT AS n_text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM pairs)")
def decontaminated_documents(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.length("text").cast("long").alias("n_text"))
    return docs.join(_contained(spark, d).select("doc_id").distinct(), "doc_id", "left_anti")


# --- chats -----------------------------------------------------------------------------


@query(f"""WITH {B.TURNS} SELECT conv_id, md5(coalesce(string_agg(upper(role) || ':' || chr(10) || content, chr(10) || chr(10) ORDER BY i) FILTER (length(content) > 0), '')) AS text_md5 FROM t GROUP BY conv_id""")
def conversation_text_pattern(spark, d) -> DataFrame:
    return chats(spark, d).select("conv_id", F.md5(T.record_text(F.col("text"), F.col("messages")).cast("binary")).alias("text_md5"))


@query(f"WITH {B.TURNS} SELECT conv_id, i::INT AS message_index, role, content AS text FROM t WHERE length(content) > 0")
def conversation_units_span(spark, d) -> DataFrame:
    return toxicity.units(chats(spark, d), ["conv_id"], T.span_units(F.col("text"), F.col("messages")))


@query(f"WITH {B.TURNS} SELECT conv_id, i::INT AS message_index, role, role || ': ' || content AS text FROM t WHERE length(content) > 0")
def conversation_units_toxicity(spark, d) -> DataFrame:
    return toxicity.units(chats(spark, d), ["conv_id"], T.toxicity_units(F.col("text"), F.col("messages")))


@query(f"WITH {B.TURNS}, c AS (SELECT DISTINCT conv_id FROM conversations) SELECT conv_id, coalesce((SELECT string_agg(content, chr(10) ORDER BY i) FROM t WHERE t.conv_id = c.conv_id AND length(content) > 0), '') AS text FROM c")
def conversation_text_dedup(spark, d) -> DataFrame:
    return chats(spark, d).select("conv_id", T.dedup_text(F.col("text"), F.col("messages")).alias("text"))


@query(f"WITH {B.PROMPT}, c AS (SELECT DISTINCT conv_id FROM conversations) SELECT conv_id, count(p.i) AS n_messages, coalesce(string_agg(p.content, chr(10) ORDER BY p.i), '') AS text FROM c LEFT JOIN p USING (conv_id) GROUP BY conv_id")
def compared_messages_prompt(spark, d) -> DataFrame:
    m, c = F.col("messages"), chats(spark, d)
    return c.select(
        "conv_id", F.size(T.compared_messages(m, "prompt", True)).cast("long").alias("n_messages"),
        T.dedup_text(F.col("text"), m, "prompt", True).alias("text")
    )


@query(f"""WITH {B.PROMPT}, x AS (SELECT conv_id, {B.norm("string_agg(content, chr(10) ORDER BY i)")} AS norm FROM p GROUP BY conv_id),
f AS (SELECT norm, min(conv_id) AS o FROM x WHERE length(norm) > 0 GROUP BY norm) SELECT conv_id, o AS original_conv_id FROM x JOIN f USING (norm) WHERE conv_id <> o""")
def conversation_dedup_prompt(spark, d) -> DataFrame:
    c = chats(spark, d).select("conv_id", T.dedup_text(F.col("text"), F.col("messages"), "prompt", True).alias("text"))
    return dedup.decisions(dedup.digests(c, ["conv_id"], F.col("text")), "digest", ["conv_id"], ["conv_id"])


@query(f"WITH {B.TURNS} SELECT conv_id, substr(trim(regexp_replace(string_agg(content, chr(10) ORDER BY i), '\\s+', ' ', 'g')), 1, 160) AS preview FROM t GROUP BY conv_id")
def conversation_preview(spark, d) -> DataFrame:
    return chats(spark, d).select(
        "conv_id", T.preview(F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), "\n")).alias("preview")
    )


# --- pattern PII -----------------------------------------------------------------------

_CATEGORIES = ["emails", "ips", "credit_cards", "phones"]


def _hits(spark, d) -> DataFrame:
    return pii.hits(rows(spark, d), LOC, "text", _CATEGORIES)


@query(f"WITH {B.HITS} SELECT * FROM h")
def pii_hits(spark, d) -> DataFrame:
    return _hits(spark, d)


@query(f"WITH {B.HITS}, {B.VALID} SELECT source_file, source_line, category, value FROM valid")
def pii_validated(spark, d) -> DataFrame:
    return pii.validate(_hits(spark, d), _CATEGORIES)


@query(f"""WITH {B.HITS}, {B.VALID}, r AS (SELECT category, count(*) AS raw FROM h GROUP BY 1), k AS (SELECT category, count(*) AS validated FROM valid GROUP BY 1)
SELECT category, raw, coalesce(validated, 0) AS validated, round(coalesce(validated, 0)::DOUBLE / raw, 6) AS keep_rate FROM r LEFT JOIN k USING (category)""")
def pii_hits_by_category(spark, d) -> DataFrame:
    raw = materialize(_hits(spark, d), "hits")
    return pii.by_category(raw, pii.validate(raw, _CATEGORIES))


@query(f"WITH {B.HITS} SELECT category, count(DISTINCT source_file || ':' || source_line) AS n_rows FROM h GROUP BY category UNION ALL SELECT 'TOTAL', count(DISTINCT source_file || ':' || source_line) FROM h")
def pii_unique_rows(spark, d) -> DataFrame:
    return pii.unique_rows(_hits(spark, d), LOC)


@query(f"WITH {B.HITS} SELECT source_file, source_line, category, value, md5(text) AS line_md5 FROM h JOIN documents ON source = source_file AND doc_id = source_line")
def pii_extract(spark, d) -> DataFrame:
    r = rows(spark, d)
    return pii.extract(_hits(spark, d), r, LOC, "text").select(*LOC, "category", "value", F.md5(F.col("whole_line").cast("binary")).alias("line_md5"))


@query(f"""WITH {B.HITS}, g AS (SELECT category, trim(value) AS value, min(struct_pack(f := source_file, l := source_line)) AS a, count(*) AS occurrences FROM h GROUP BY 1, 2)
SELECT category, value, a.f AS source_file, a.l AS source_line, occurrences FROM g""")
def probe_first_occurrence(spark, d) -> DataFrame:
    return pii.first_occurrence(_hits(spark, d), LOC)


@query(f"WITH {B.HITS}, g AS (SELECT category, trim(value) AS value, count(*) AS occurrences FROM h GROUP BY 1, 2) SELECT category, count(*) AS n_values FROM g WHERE occurrences <= 1 GROUP BY 1")
def probe_repeat_filter(spark, d) -> DataFrame:
    return pii.first_occurrence(_hits(spark, d), LOC, 1).groupBy("category").agg(F.count("*").alias("n_values"))


_ASKED = "h JOIN documents ON source = source_file AND doc_id = source_line"
_LOOSE = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
_COMPACT = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}]', '', 'g')"


@query(f"""WITH {B.HITS}, p AS (SELECT h.*, CASE source_line % 4 WHEN 0 THEN upper(text) WHEN 1 THEN text WHEN 2 THEN regexp_replace(text, '[-. ()]', ' / ', 'g') ELSE 'nothing' END AS reply, regexp_replace(value, '[^0-9]', '', 'g') AS dg FROM {_ASKED})
SELECT source_file, source_line, category, value, array_to_string(list_filter([CASE WHEN contains(reply, value) THEN 'exact' END, CASE WHEN contains(lower(reply), lower(value)) THEN 'casefold' END,
  CASE WHEN contains({_LOOSE.format("reply")}, {_LOOSE.format("value")}) THEN 'whitespace_casefold' END, CASE WHEN length(dg) >= 7 AND contains(regexp_replace(reply, '[^0-9]', '', 'g'), dg) THEN 'digits' END,
  CASE WHEN regexp_matches(category, 'email|phone') AND length({_COMPACT.format("value")}) >= 6 AND contains({_COMPACT.format("reply")}, {_COMPACT.format("value")}) THEN 'compact' END], lambda x: x IS NOT NULL), ',') AS kinds FROM p""")
def response_match_kinds(spark, d) -> DataFrame:
    both, k = pii.extract(_hits(spark, d), rows(spark, d), LOC, "text"), F.col("source_line") % 4
    reply = F.when(k == 0, F.upper("whole_line")).when(k == 1, F.col("whole_line")).when(
        k == 2, F.regexp_replace("whole_line", "[-. ()]", " / ")
    ).otherwise(F.lit("nothing"))
    return both.select(*LOC, "category", "value", F.array_join(pii.match_kinds(reply, F.col("value"), F.col("category")), ",").alias("kinds"))


_MARK = "'[REDACTED]'"


@query(f"""WITH {B.HITS}, p AS (SELECT h.*, text, CASE source_line % 4 WHEN 0 THEN value WHEN 1 THEN upper(value) WHEN 2 THEN regexp_replace(value, '[^0-9A-Za-z]', '/', 'g') ELSE '' END AS asked FROM {_ASKED}),
a AS (SELECT *, regexp_replace(asked, '[^0-9]', '', 'g') AS dg, CASE WHEN asked = '' THEN text ELSE replace(text, asked, {_MARK}) END AS t1 FROM p),
b AS (SELECT *, CASE WHEN length(asked) >= 3 THEN regexp_replace(t1, '(?i)' || regexp_escape(asked), {_MARK}, 'g') ELSE t1 END AS t2 FROM a),
c AS (SELECT *, CASE WHEN length(dg) >= 7 THEN regexp_replace(t2, '(^|[^0-9])' || array_to_string(string_split(dg, ''), '[^0-9]*') || '($|[^0-9])', '\\1[REDACTED]\\2', 'g') ELSE t2 END AS t3 FROM b)
SELECT source_file, source_line, category, value, t3 <> text AS found, md5(CASE WHEN asked = '' OR t3 <> text THEN t3 ELSE '[context left out: the value was not found in it]' END) AS context_md5 FROM c""")
def redacted_contexts(spark, d) -> DataFrame:
    both, k = pii.extract(_hits(spark, d), rows(spark, d), LOC, "text"), F.col("source_line") % 4
    asked = F.when(k == 0, F.col("value")).when(k == 1, F.upper("value")).when(k == 2, F.regexp_replace("value", "[^0-9A-Za-z]", "/")).otherwise(F.lit(""))
    found = pii.redact(F.col("whole_line"), asked, re2=True).isNotNull()
    return both.select(
        *LOC, "category", "value", found.alias("found"), F.md5(pii.redacted_context(F.col("whole_line"), asked, re2=True).cast("binary")).alias("context_md5")
    )


@query()
def pii_wide_categories(spark, d) -> DataFrame:
    found = pii.hits(rows(spark, d), LOC, "text", ["btc_addresses", "ipv6s", "po_boxes", "street_addresses"])
    return found.withColumn("valid", validated(F.col("category"), F.col("value")))


# --- toxicity --------------------------------------------------------------------------


def _messages(spark, d) -> DataFrame:
    """Scored messages of all conversations, with the stand-in classifier's outcome."""
    u = toxicity.units(chats(spark, d), ["conv_id"], T.toxicity_units(F.col("text"), F.col("messages")))
    s = u.withColumn("f", toxicity.flagged(B.scores(F.col("text"))))
    s = s.select("conv_id", "message_index", "role", "text", "f.toxicity", "f.trigger_category", "f.flagged")
    verdict = F.when(F.col("toxicity") > 0.9, F.lit("Unsafe")).when(
        F.col("toxicity") > 0.7, F.lit("Controversial")
    ).when(F.col("toxicity") > 0.02, F.lit("Safe"))
    return s.withColumn("verdict", verdict).withColumn("outcome", toxicity.guard_outcome(F.col("verdict")))


_SCORED = B.UNITS + """, f AS (SELECT conv_id, message_index, role, greatest(a, b) AS toxicity, CASE WHEN a >= b THEN 'insult' ELSE 'toxicity' END AS trigger_category FROM s),
o AS (SELECT *, CASE WHEN toxicity > 0.9 THEN 'Unsafe' WHEN toxicity > 0.7 THEN 'Controversial' WHEN toxicity > 0.02 THEN 'Safe' END AS verdict FROM f),
g AS (SELECT *, coalesce(lower(verdict), 'guard_error') AS outcome FROM o)"""


@query(f"WITH {_SCORED} SELECT conv_id, message_index::INT AS message_index, role, toxicity, trigger_category FROM g WHERE toxicity > 0.5")
def tox_flagged(spark, d) -> DataFrame:
    return _messages(spark, d).where("flagged").select("conv_id", "message_index", "role", "toxicity", "trigger_category")


@query(f"WITH {_SCORED} SELECT least(floor(toxicity / 0.05::DOUBLE), 19)::INT AS bin, count(*) AS n FROM g GROUP BY 1")
def tox_histogram(spark, d) -> DataFrame:
    return _messages(spark, d).groupBy(toxicity.score_bin(F.col("toxicity")).alias("bin")).agg(F.count("*").alias("n"))


_BY_ROLE = """count(*) FILTER (outcome = 'unsafe') AS unsafe, count(*) FILTER (outcome = 'controversial') AS controversial, count(*) FILTER (outcome = 'safe') AS safe,
  count(*) FILTER (outcome = 'error') AS error, count(*) FILTER (outcome NOT IN ('unsafe', 'controversial', 'safe', 'error')) AS unknown"""


@query(f"WITH {_SCORED}, x AS (SELECT *, (conv_id % 3)::VARCHAR AS folder FROM g) SELECT CASE WHEN grouping(folder) = 1 THEN '*' ELSE folder END AS folder, CASE WHEN grouping(role) = 1 THEN 'total' ELSE role END AS role, {_BY_ROLE} FROM x GROUP BY CUBE (folder, role)")
def tox_verdict_by_role(spark, d) -> DataFrame:
    return toxicity.verdicts_by_role(_messages(spark, d).withColumn("folder", (F.col("conv_id") % 3).cast("string")), "folder", "role", "outcome")


@query(f"""WITH {_SCORED}, a AS (SELECT conv_id, CASE WHEN verdict IS NULL THEN 'error' ELSE verdict || '|' || trigger_category END AS atom FROM g),
r AS (SELECT conv_id, string_agg(DISTINCT atom, ',' ORDER BY atom) AS atoms FROM a GROUP BY 1) SELECT atoms, count(*) AS n_rows FROM r GROUP BY 1""")
def tox_tally_rows(spark, d) -> DataFrame:
    m = _messages(spark, d).withColumn("categories", F.array("trigger_category"))
    return toxicity.tally(toxicity.row_atoms(m, ["conv_id"], "verdict", "categories"))


@query(f"""WITH {_SCORED} SELECT count(*) AS n_messages, count(DISTINCT conv_id) AS n_rows FROM g WHERE verdict IS NULL OR (verdict = 'Unsafe' AND trigger_category = 'insult')""")
def tox_flagged_choice(spark, d) -> DataFrame:
    a = _messages(spark, d).select("conv_id", F.explode(toxicity.atoms(F.col("verdict"), F.array("trigger_category"))).alias("atom"))
    hit = toxicity.counted(F.col("atom"), ["Unsafe"], ["insult"], ["insult", "toxicity"])
    return a.where(hit).agg(F.count("*").alias("n_messages"), F.countDistinct("conv_id").alias("n_rows"))


@query(f"""WITH {_SCORED}, p AS (SELECT conv_id, bool_or(outcome = 'unsafe') AS has_unsafe, bool_or(outcome = 'controversial') AS has_controversial, bool_or(outcome = 'guard_error') AS has_guard_error, count(*) AS n FROM g GROUP BY 1)
SELECT has_unsafe, has_controversial, has_guard_error, count(*) AS n_records, sum(n)::BIGINT AS n_messages FROM p GROUP BY ALL""")
def record_impact(spark, d) -> DataFrame:
    return toxicity.record_impact(_messages(spark, d), ["conv_id"], "outcome", ("unsafe", "controversial", "guard_error"))


@query(f"WITH {_SCORED}, p AS (SELECT conv_id, count(*) FILTER (outcome = 'unsafe') AS k FROM g GROUP BY 1) SELECT k AS n_unsafe, count(*) AS n_records FROM p GROUP BY 1")
def messages_per_record(spark, d) -> DataFrame:
    per = _messages(spark, d).groupBy("conv_id").agg(F.sum((F.col("outcome") == "unsafe").cast("long")).alias("n_unsafe"))
    return per.groupBy("n_unsafe").agg(F.count("*").alias("n_records"))


_REPLY = """CASE doc_id % 6 WHEN 0 THEN 'Safety: Unsafe' || chr(10) || 'Categories: Violent, PII, Violent' || chr(10) || 'Refusal: No' WHEN 1 THEN 'Safety: Safe' || chr(10) || 'Categories: None' || chr(10) || 'Refusal: Yes'
  WHEN 2 THEN 'safety: unsafe' WHEN 3 THEN 'Safety:Controversial (Unethical Acts, Jailbreak)' WHEN 4 THEN '' END"""


@query(f"""WITH r AS (SELECT doc_id, {_REPLY} AS r, regexp_extract_all({_REPLY}, '(Violent|Unethical Acts|PII|Jailbreak|None)') AS c FROM labels)
SELECT doc_id, nullif(regexp_extract(r, 'Safety:\\s*(Safe|Unsafe|Controversial)', 1), '') AS safety, coalesce(array_to_string(list_filter(c, lambda x, i: list_position(c, x) = i), ','), '') AS categories,
  CASE WHEN doc_id % 5 < 3 THEN nullif(regexp_extract(r, 'Refusal:\\s*(Yes|No)', 1), '') END AS refusal FROM r""")
def guard_replies(spark, d) -> DataFrame:
    k = F.col("doc_id") % 6
    reply = (
        F.when(k == 0, F.lit("Safety: Unsafe\nCategories: Violent, PII, Violent\nRefusal: No")).when(k == 1, F.lit("Safety: Safe\nCategories: None\nRefusal: Yes"))
        .when(k == 2, F.lit("safety: unsafe")).when(k == 3, F.lit("Safety:Controversial (Unethical Acts, Jailbreak)")).when(k == 4, F.lit(""))
    )
    role = F.when(F.col("doc_id") % 5 < 3, F.lit("assistant")).otherwise(F.lit("user"))
    return table(spark, d, "labels").withColumn("g", toxicity.parse_guard(reply, role)).select(
        "doc_id", "g.safety", F.array_join("g.categories", ",").alias("categories"), "g.refusal"
    )


# --- filter ----------------------------------------------------------------------------

RULES = filtering.Rules(protected=("src3",))


def _findings(spark, d, at: DataFrame) -> DataFrame:
    """The findings of all scanners on the rows ``at`` (LOC and fingerprint, a narrow table)."""
    found = pii.validate(_hits(spark, d), _CATEGORIES).join(at, LOC)
    guard = table(spark, d, "labels").join(at.withColumnRenamed("source_line", "doc_id"), "doc_id")
    guard = guard.select(
        "source_file", F.col("doc_id").alias("source_line"), "source_sha256",
        F.when(F.col("toxic") == 1, F.lit("Unsafe")).otherwise(F.lit("Safe")).alias("verdict")
    )
    copies = _decided(spark, d).join(at, LOC).withColumn("duplicate_of", F.concat_ws(":", "original_source_file", F.col("original_source_line").cast("string")))
    leaks = _contained(spark, d).select(
        F.col("source").alias("source_file"), F.col("doc_id").alias("source_line"), F.col("item_id").cast("string").alias("duplicate_of")
    ).join(at, LOC)
    return filtering.findings(
        filtering.pii_hits(found, RULES), filtering.toxicity_hits(guard, RULES), filtering.duplicate_hits(copies, RULES),
        filtering.duplicate_hits(leaks, RULES, "cross"), protected=RULES.protected
    )


def _places(spark, d) -> DataFrame:
    return materialize(rows(spark, d).select(*LOC, "source_sha256"), "places")


def _filtered(spark, d, texts: bool = True) -> DataFrame:
    at = _places(spark, d)
    return filtering.decide(rows(spark, d) if texts else at, _findings(spark, d, at))


_FOUND = f"""{B.DECIDED}, {B.HITS}, {B.VALID}, {_CONTAINED},
fi AS (SELECT source_line, 'regex_pii' AS reason FROM valid UNION ALL SELECT doc_id, 'toxicity_unsafe' FROM labels WHERE toxic = 1
  UNION ALL SELECT source_line, 'duplicate_global' FROM dec UNION ALL SELECT doc_id, 'duplicate_cross' FROM pairs),
re AS (SELECT source_line, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons, count(*) AS n_findings FROM fi GROUP BY 1),
de AS (SELECT source AS source_file, doc_id AS source_line, text, CASE WHEN source = 'src3' THEN '' ELSE coalesce(reasons, '') END AS reasons,
  CASE WHEN source = 'src3' THEN 0 ELSE coalesce(n_findings, 0) END AS n_findings FROM documents LEFT JOIN re ON source_line = doc_id)"""


@query(f"WITH {_FOUND} SELECT source_file, source_line, sha256(text) AS source_sha256, reasons, n_findings::BIGINT AS n_findings FROM de")
def filter_decisions(spark, d) -> DataFrame:
    return _filtered(spark, d, texts=False).select(*LOC, "source_sha256", F.array_join("reasons", ",").alias("reasons"), "n_findings")


@query(f"WITH {_FOUND} SELECT source_file, source_line, sha256(text) AS source_sha256 FROM de WHERE reasons = ''")
def filter_line_map(spark, d) -> DataFrame:
    return filtering.kept(_filtered(spark, d, texts=False)).select(*LOC, "source_sha256")


@query(f"WITH {_FOUND} SELECT reason, count(*) AS n_rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM de WHERE reasons <> '') GROUP BY 1")
def filter_removed_by_reason(spark, d) -> DataFrame:
    return filtering.by_reason(_filtered(spark, d, texts=False))


@query(f"""WITH {_FOUND} SELECT source_file, count(*) AS rows, count(*) FILTER (reasons = '') AS kept, count(*) FILTER (reasons <> '') AS removed, sum(strlen(text))::BIGINT AS bytes,
  coalesce(sum(strlen(text)) FILTER (reasons = ''), 0)::BIGINT AS kept_bytes, coalesce(sum(strlen(text)) FILTER (reasons <> ''), 0)::BIGINT AS removed_bytes FROM de GROUP BY 1""")
def filter_per_file(spark, d) -> DataFrame:
    return filtering.per_file(_filtered(spark, d), F.octet_length("text").cast("long"))


@query(f"WITH {_FOUND} SELECT source_file AS file, source_line AS line, sha256(text) AS sha256, 'manual' AS scanner, 'scan-1' AS scan_id, reasons, false AS automatic FROM de WHERE contains(reasons, 'duplicate_cross') OR contains(reasons, 'toxicity_unsafe')")
def drop_list(spark, d) -> DataFrame:
    out = filtering.drop_list(filtering.removed(_filtered(spark, d, texts=False)), ["duplicate_cross", "toxicity_unsafe"], "manual", "scan-1")
    return out.withColumn("reasons", F.array_join("reasons", ","))


@query(f"""WITH {_FOUND} SELECT source_file, source_line, substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 160) AS preview, reasons, count(*) OVER () AS total, count(*) OVER () > 50 AS has_next FROM de WHERE reasons <> '' ORDER BY source_file, source_line LIMIT 25 OFFSET 25""")
def flagged_page(spark, d) -> DataFrame:
    i = reports.index(_filtered(spark, d), F.col("text")).withColumn("reasons", F.array_join("reasons", ",")).select(*LOC, "preview", "reasons")
    return reports.page(i, LOC, 1, 25)


@query(f"WITH {_FOUND} SELECT source_file, count(*) AS n_rows FROM de WHERE reasons <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def topk_flagged_sources(spark, d) -> DataFrame:
    return reports.top(filtering.removed(_filtered(spark, d, texts=False)), "source_file", 5)


@query(f"WITH {_FOUND} SELECT count(*) AS n_problems FROM (SELECT source_file FROM de GROUP BY 1 HAVING count(*) <> count(*) FILTER (reasons = '') + count(*) FILTER (reasons <> ''))")
def filter_conservation(spark, d) -> DataFrame:
    return filtering.conserved(filtering.per_file(_filtered(spark, d), F.octet_length("text").cast("long"))).agg(F.count("*").alias("n_problems"))


_FLAGS = f"""{_FOUND}, fl AS (SELECT doc_id, coalesce(contains(re.reasons, 'duplicate_cross'), false) AS leak, coalesce(contains(re.reasons, 'toxicity_unsafe'), false) AS toxic, coalesce(contains(re.reasons, 'regex_pii'), false) AS pii
  FROM documents LEFT JOIN re ON re.source_line = doc_id)"""


def _flags(spark, d) -> DataFrame:
    r = rows(spark, d).select(F.col("source_line").alias("doc_id"))
    leak = _contained(spark, d).select("doc_id").distinct().withColumn("l", F.lit(True))
    tox = table(spark, d, "labels").where("toxic = 1").select("doc_id").distinct().withColumn("t", F.lit(True))
    hit = pii.validate(_hits(spark, d), _CATEGORIES).select(F.col("source_line").alias("doc_id")).distinct().withColumn("p", F.lit(True))
    out = r.join(leak, "doc_id", "left").join(tox, "doc_id", "left").join(hit, "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(False)).alias(n) for c, n in (("l", "leak"), ("t", "toxic"), ("p", "pii"))])


@query(f"""WITH {_FLAGS} SELECT 0 AS position, 'decontamination' AS stage, count(*) FILTER (leak) AS n_removed, count(*) FILTER (leak) AS n_first, count(*) FILTER (NOT leak) AS n_left FROM fl
UNION ALL SELECT 1, 'toxicity', count(*) FILTER (toxic), count(*) FILTER (toxic AND NOT leak), count(*) FILTER (NOT toxic AND NOT leak) FROM fl
UNION ALL SELECT 2, 'pii', count(*) FILTER (pii), count(*) FILTER (pii AND NOT toxic AND NOT leak), count(*) FILTER (NOT pii AND NOT toxic AND NOT leak) FROM fl""")
def stage_counts_sequential(spark, d) -> DataFrame:
    return quality.sequential(_flags(spark, d), [("decontamination", F.col("leak")), ("toxicity", F.col("toxic")), ("pii", F.col("pii"))])


@query(f"WITH {_FLAGS} SELECT leak, toxic, pii, count(*) AS n_rows FROM fl GROUP BY ALL")
def rejection_overlap(spark, d) -> DataFrame:
    return quality.overlap(_flags(spark, d), ["leak", "toxic", "pii"])


@query("""SELECT d.doc_id, CASE WHEN toxic IS NULL THEN 'error' WHEN toxic = 1 AND quality = 0 THEN 'both' WHEN quality = 0 THEN 'pii' WHEN toxic = 1 THEN 'toxicity' ELSE 'kept' END AS class,
  toxic IS NULL OR toxic = 1 AS toxicity_rejects, coalesce(quality = 0, false) AS pii_rejects FROM documents d LEFT JOIN labels l USING (doc_id)""")
def quality_error_policy(spark, d) -> DataFrame:
    """A row without a verdict is a guard error and goes; a failed PII request alone keeps the row."""
    both = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    verdict = F.when(F.col("toxic") == 1, F.lit("UNSAFE")).when(F.col("toxic") == 0, F.lit("safe"))
    outcome = toxicity.guard_outcome_final(verdict)
    outcome = F.coalesce(outcome, F.lit("error"))
    rejects = quality.pii_rejects(
        F.when(F.col("quality").isNull(), F.lit("error")).otherwise(F.lit("ok")),
        F.when(F.col("quality") == 0, F.lit("keep")).otherwise(F.lit("filter"))
    )
    return both.select(
        "doc_id", quality.row_class(outcome, rejects).alias("class"), quality.toxicity_rejects(outcome).alias("toxicity_rejects"),
        rejects.alias("pii_rejects")
    )


# --- reports ---------------------------------------------------------------------------


@query("SELECT source, count(*) AS rows, count(*) FILTER (length(text) > 0) AS rows_with_text, round(count(*) FILTER (length(text) > 0)::DOUBLE / count(*), 6) AS ratio, sum(length(text))::BIGINT AS characters, round(sum(length(text))::DOUBLE / count(*) FILTER (length(text) > 0), 4) AS mean_characters FROM documents GROUP BY source")
def text_coverage(spark, d) -> DataFrame:
    return reports.text_coverage(table(spark, d, "documents"), "source", F.col("text"))


@query("""WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents), x AS (SELECT source, trim(line) = '' AS blank, CASE WHEN length(line) < 20 THEN 'empty_column:text' END AS reason FROM l)
SELECT source, count(*) AS n_lines, count(*) FILTER (blank) AS n_blank, count(*) FILTER (NOT blank) AS n_read, count(*) FILTER (NOT blank AND reason IS NOT NULL) AS n_skipped, count(*) FILTER (NOT blank AND reason IS NULL) AS n_written FROM x GROUP BY 1""")
def conversion_accounting(spark, d) -> DataFrame:
    lines = table(spark, d, "documents").select("source", F.explode(F.split("text", "\n", -1)).alias("line"))
    return reports.accounting(lines, "source", F.trim("line") == "", F.when(F.length("line") < 20, F.lit("empty_column:text")))


@query("""WITH e AS (SELECT source AS path, count(*) AS rows, sum(doc_id)::BIGINT AS c FROM documents WHERE source <> 'src1' GROUP BY 1), r AS (SELECT source AS path, count(*) FILTER (source <> 'src4' OR doc_id % 2 = 0) AS rows, sum(doc_id)::BIGINT AS c FROM documents WHERE source <> 'src2' GROUP BY 1)
SELECT coalesce(e.path, r.path) AS path, CASE WHEN r.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'extra' WHEN e.rows = r.rows AND e.c = r.c THEN 'same' ELSE 'different' END AS status FROM e FULL JOIN r ON e.path = r.path""")
def coverage_rows_check(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("source").alias("path"), "doc_id")
    agg = lambda x, n: x.groupBy("path").agg(n.alias("rows"), F.sum("doc_id").cast("long").alias("c"))
    expected = agg(docs.where("path <> 'src1'"), F.count("*"))
    read = agg(docs.where("path <> 'src2'"), F.sum(((F.col("path") != "src4") | (F.col("doc_id") % 2 == 0)).cast("long")))
    return reports.coverage(expected, read, "path", ("rows", "c"))


@query("WITH x AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n, count(*) OVER () AS t FROM documents) SELECT doc_id FROM x WHERE n IN (SELECT (i * t) // 50 FROM (SELECT unnest(range(0, 50)) AS i), (SELECT count(*) AS t FROM documents))")
def evenly_spaced_sample(spark, d) -> DataFrame:
    return reports.evenly_spaced(table(spark, d, "documents").select("doc_id"), ["doc_id"], 50)


@query("SELECT doc_id FROM documents ORDER BY sha256(doc_id::VARCHAR) LIMIT 40")
def hash_sample(spark, d) -> DataFrame:
    return reports.hash_sample(table(spark, d, "documents").select("doc_id"), F.col("doc_id").cast("string"), 40)


@query("""WITH x AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY abs(length(text) - 1500), doc_id) AS k FROM documents) SELECT source, doc_id FROM x ORDER BY k, source LIMIT 30""")
def stratified_pilot(spark, d) -> DataFrame:
    narrow = table(spark, d, "documents").select("source", "doc_id", F.length("text").alias("n"))
    return reports.stratified(narrow, "source", F.col("n"), 1500, 30, "doc_id").select("source", "doc_id")


@query("SELECT source, CASE WHEN source LIKE 'src1%' THEN 'first' WHEN source LIKE 'src%' THEN 'rest' END AS \"group\", count(*) AS n_rows FROM documents GROUP BY 1, 2")
def rows_by_first_prefix(spark, d) -> DataFrame:
    groups = spark.createDataFrame([(1, "first", "src1"), (2, "rest", "src")], "rank int, group string, prefix string")
    files = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_rows"))
    return reports.first_prefix(files, "source", groups).select("source", "group", "n_rows")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'not_found' WHEN doc_id % 5 = 0 THEN 'changed' ELSE 'unchanged' END AS status FROM documents")
def traced_rows(spark, d) -> DataFrame:
    own = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("fingerprint"))
    now = own.where("doc_id % 7 <> 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit("x")).otherwise(F.col("fingerprint")).alias("fingerprint"))
    return reports.traced(own, now, ["doc_id"])


@query("WITH x AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents) SELECT n // 64 % 4 AS chunk, n // 64 AS batch, count(*) AS n_rows, min(doc_id) AS first_doc FROM x GROUP BY ALL")
def chunk_layout(spark, d) -> DataFrame:
    """Batch i of 64 rows goes to chunk i mod 4: the layout of the chunked sink."""
    held = numbered(table(spark, d, "documents").select("doc_id"), ["doc_id"], name="n").withColumn("batch", F.expr("(n - 1) div 64"))
    return held.groupBy((F.col("batch") % 4).alias("chunk"), "batch").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_doc"))


@query("""WITH j AS (SELECT CASE WHEN conv_id % 2 = 0 THEN 'number' ELSE 'null' END AS k, count(*) AS n FROM conversations GROUP BY 1), c AS (SELECT count(*) AS n FROM conversations)
SELECT '' AS path, 'object' AS type, n FROM c UNION ALL SELECT 'id', k, n FROM j UNION ALL SELECT 'm', 'array', n FROM c UNION ALL SELECT 'm[]', 'object', n FROM c UNION ALL SELECT 'm[].content', 'string', n FROM c UNION ALL SELECT 'm[].role', 'string', n FROM c""")
def schema_tree(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    row = F.struct(F.when(F.col("conv_id") % 2 == 0, F.col("conv_id")).alias("id"), F.array(F.struct("role", F.col("text").alias("content"))).alias("m"))
    return reports.schema_tree(c.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("raw")), "raw")


@query("""WITH a AS (SELECT CASE WHEN toxic = 1 THEN 'FILTER' WHEN doc_id % 9 = 0 THEN 'REVIEW' ELSE 'KEEP' END AS l, CASE WHEN quality = 0 THEN 'FILTER' ELSE 'KEEP' END AS r FROM labels)
SELECT count(*) AS n_rows, round(avg((l = r)::INT::DOUBLE) FILTER (l <> 'REVIEW'), 6) AS agreement, round(2.0 * count(*) FILTER (l = 'FILTER' AND r = 'FILTER') / (count(*) FILTER (l = 'FILTER') + count(*) FILTER (r = 'FILTER')), 6)::DOUBLE AS f1 FROM a""")
def model_agreement(spark, d) -> DataFrame:
    left = F.when(F.col("toxic") == 1, "FILTER").when(F.col("doc_id") % 9 == 0, "REVIEW").otherwise("KEEP")
    right = F.when(F.col("quality") == 0, "FILTER").otherwise("KEEP")
    x = table(spark, d, "labels").select(left.alias("l"), right.alias("r"))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    f1 = ner.f1(n((F.col("l") == "FILTER") & (F.col("r") == "FILTER")), n(F.col("l") == "FILTER"), n(F.col("r") == "FILTER"))
    return x.agg(F.count("*").alias("n_rows"), F.round(toxicity.agreement(F.col("l"), F.col("r")), 6).alias("agreement"), F.round(f1, 6).alias("f1"))


@query("SELECT source AS source_file, count(*) AS n_rows, count(*) FILTER (doc_id > 500) AS n_bad FROM documents GROUP BY 1 HAVING count(*) FILTER (doc_id > 500) > 0")
def invalid_locations(spark, d) -> DataFrame:
    r = rows(spark, d)
    files = r.groupBy("source_file").agg(F.lit(500).alias("rows"))
    bad = filtering.invalid_locations(r.where("source_line > 0"), files).groupBy("source_file").agg(F.count("*").alias("n_bad"))
    return r.groupBy("source_file").agg(F.count("*").alias("n_rows")).join(bad, "source_file")


@query(f"""WITH {B.TURNS}, f AS (SELECT conv_id, min_by(role, i) AS r0, min_by(content, i) AS c0 FROM t GROUP BY 1),
q AS (SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN r0 WHEN 1 THEN 'assistant' WHEN 2 THEN 'tool' ELSE '' END AS role, CASE conv_id % 4 WHEN 0 THEN c0 ELSE 'a text that no message has' END AS content FROM f),
m AS (SELECT q.conv_id, max(i) FILTER (t.role = q.role AND t.content = q.content AND q.role IN ('user', 'assistant', 'system', 'tool')) AS e, max(i) FILTER (t.role = CASE WHEN q.role IN ('user', 'assistant') THEN q.role ELSE 'user' END) AS s FROM q JOIN t USING (conv_id) GROUP BY 1)
SELECT conv_id, coalesce(e, s, -1)::INT AS message_index, CASE WHEN e IS NOT NULL THEN 'exact' WHEN s IS NOT NULL THEN 'fallback' ELSE 'missing' END AS kind FROM m""")
def flagged_message_located(spark, d) -> DataFrame:
    c, k, first = chats(spark, d), F.col("conv_id") % 4, F.get("messages", F.lit(0))
    told = F.concat(first["role"], F.lit(": "), F.coalesce(first["content"], F.lit("")))
    text = F.when(k == 0, told).when(
        k == 1, F.lit("assistant: a text that no message has")
    ).when(k == 2, F.lit("tool: a text that no message has")).otherwise(F.lit("a text that no message has"))
    messages = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))
    return c.select("conv_id", toxicity.locate(messages, text).alias("at")).select(
        "conv_id", F.coalesce("at.index", F.lit(-1)).alias("message_index"), "at.kind"
    )


# --- span models -----------------------------------------------------------------------

_LABELLED = """sp AS (SELECT source AS source_file, doc_id AS source_line, CASE doc_id % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'first_name' WHEN 2 THEN 'city' WHEN 3 THEN 'user_name' ELSE 'device_identifier' END AS label,
  CASE doc_id % 5 WHEN 2 THEN 'contextual' WHEN 4 THEN 'direct_identifier' ELSE 'person_linked' END AS tier, (doc_id % 101) / 100.0::DOUBLE AS confidence, CASE WHEN doc_id % 11 = 0 THEN 'Correct' ELSE substr(text, 1, 6) END AS span FROM documents),
po AS (SELECT *, CASE label WHEN 'email' THEN 0.5 WHEN 'first_name' THEN 0.9 WHEN 'user_name' THEN 0.95 WHEN 'device_identifier' THEN 0.7 END::DOUBLE AS threshold FROM sp),
pd AS (SELECT *, CASE WHEN threshold IS NULL THEN 'contextual_tier' WHEN lower(trim(span)) IN ('correct', 'incorrect') THEN 'known_non_pii_token' WHEN confidence < threshold THEN 'below_confidence_threshold' END AS reason FROM po)"""


def _spans(spark, d) -> DataFrame:
    r, m = rows(spark, d), F.col("source_line") % 5
    label = F.when(m == 0, "email").when(m == 1, "first_name").when(m == 2, "city").when(m == 3, "user_name").otherwise("device_identifier")
    tier = F.when(m == 2, "contextual").when(m == 4, "direct_identifier").otherwise("person_linked")
    s = r.select(
        *LOC, "text", label.alias("label"), tier.alias("tier"), ((F.col("source_line") % 101) / F.lit(100.0)).alias("confidence"),
        F.when(F.col("source_line") % 11 == 0, F.lit("Correct")).otherwise(F.substring("text", 1, 6)).alias("span")
    )
    p = ner.decide(ner.Policy(), F.col("label"), F.col("tier"), F.col("confidence"), F.col("span"), F.col("text"), F.lit(0), F.lit(6))
    return s.withColumn("p", p).select(*LOC, "label", "tier", "confidence", "span", "p.eligible", "p.threshold", "p.reason")


@query(f"WITH {_LABELLED} SELECT source_line, label, tier, confidence, reason IS NULL AS eligible, threshold, reason FROM pd")
def ner_policy(spark, d) -> DataFrame:
    return _spans(spark, d).select("source_line", "label", "tier", "confidence", "eligible", "threshold", "reason")


@query(f"WITH {_LABELLED} SELECT label, tier, count(*) AS spans, count(*) FILTER (reason IS NULL) AS eligible, count(DISTINCT source_line) AS rows FROM pd GROUP BY 1, 2")
def ner_tally(spark, d) -> DataFrame:
    return ner.tally(_spans(spark, d), LOC)


@query(f"""WITH {_LABELLED} SELECT label, count(*) FILTER (source_line % 2 = 0) AS n_left, count(*) FILTER (source_line % 3 = 0) AS n_right, count(*) FILTER (source_line % 6 = 0) AS n_both FROM pd WHERE source_line % 2 = 0 OR source_line % 3 = 0 GROUP BY 1""")
def span_compare(spark, d) -> DataFrame:
    s = _spans(spark, d)
    return ner.compare(s.where("source_line % 2 = 0"), s.where("source_line % 3 = 0"), [*LOC, "label"], "label")


_TAGS = ["O", "B-word", "I-word", "E-word", "S-word"]


def _backend(text: str):
    """Stand-in span model: capitalised words are spans, with probabilities that follow their length."""
    import re

    import numpy as np

    offsets = [m.span() for m in re.finditer(r"\w+|[^\w\s]", text)]
    p = np.full((len(offsets), len(_TAGS)), 0.02)
    for i, (a, b) in enumerate(offsets):
        p[i, 4 if text[a].isupper() else 0] = 0.9 + 0.02 * ((b - a) % 3)
    return offsets, p


@query()
def viterbi_spans(spark, d) -> DataFrame:
    found = ner.scan(table(spark, d, "documents"), _backend, _TAGS, "doc_id")
    return found.groupBy("id", "label").agg(F.count("*").alias("n_spans"), F.round(F.avg("confidence"), 6).alias("confidence"))


@query()
def word_diff(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    pairs = dedup.near_duplicates(docs, "doc_id", F.col("text")).toDF("a", "b")
    both = pairs.join(docs.toDF("a", "left"), "a").join(docs.toDF("b", "right"), "b")
    return reports.word_diff(both, "left", "right").select("a", "b", F.round("ratio", 6).alias("ratio"), "same_words")


from screenwright.plans import more  # noqa: E402, F401  (its queries register themselves)
