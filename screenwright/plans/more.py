"""Queries of runs, layouts, reconciliations, prompts, replies and lookups, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwright.functions import prompts as P
from screenwright.functions import text as T
from screenwright.operators import filtering, layout, ner, pii, quality, reconcile, reports, runs, toxicity
from screenwright.plans import base as B
from screenwright.plans.base import chats, query, rows, table
from screenwright.sources import readers, sinks
from screenwright.storage import materialize, new_path

LOC = ["source_file", "source_line"]

# --- runs and coverage: each source is a file of the run of its number modulo 5 ------------

_FILES = """f AS (SELECT source, 'r' || (substr(source, 4)::INT % 5) AS run, source || '.jsonl' AS name, count(*) AS rows, sum(strlen(text))::BIGINT AS bytes, sha256(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS sha FROM documents GROUP BY source),
ru AS (SELECT 'r' || k AS run, CASE WHEN k = 3 THEN 'running' ELSE 'finished' END AS status, k <> 4 AS lists FROM (SELECT unnest(range(0, 5)) AS k)),
li AS (SELECT run, name AS path, rows, bytes, sha FROM f WHERE source <> 'src5'),
se AS (SELECT run || '/' || path AS path, run, rows, bytes, sha FROM li WHERE run NOT IN ('r3', 'r4')),
pr AS (SELECT run || '/' || name AS path, CASE WHEN source = 'src6' THEN bytes + 1 ELSE bytes END AS bytes FROM f WHERE source <> 'src7' UNION ALL SELECT 'loose/' || name, bytes FROM f WHERE source = 'src1')"""


def _folder(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs, listed, present) made of the sources: one run goes on, one lists nothing, a file is not listed, one is missing, one has another size, one lies outside."""
    docs = table(spark, d, "documents")
    f = docs.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text")).cast("long").alias("bytes"), F.array_sort(F.collect_list("doc_id")).alias("ids")
    )
    run = F.concat(F.lit("r"), (F.expr("cast(substring(source, 4) as int)") % 5).cast("string"))
    sha = F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").cast("binary"), 256)
    f = materialize(f.select("source", run.alias("run"), F.concat("source", F.lit(".jsonl")).alias("name"), "rows", "bytes", sha.alias("sha256")), "files")
    r = spark.createDataFrame([(f"r{k}", "running" if k == 3 else "finished", k != 4) for k in range(5)], "run string, status string, lists boolean")
    listed = f.where("source <> 'src5'").select("run", F.col("name").alias("path"), "rows", "bytes", "sha256")
    there = f.where("source <> 'src7'").select(
        F.concat_ws("/", "run", "name").alias("path"), F.expr("case when source = 'src6' then bytes + 1 else bytes end").alias("bytes")
    )
    return r, listed, there.union(f.where("source = 'src1'").select(F.concat_ws("/", F.lit("loose"), "name"), "bytes"))


@query(f"WITH {_FILES} SELECT path, run, rows, bytes, sha AS sha256 FROM se")
def runs_selection(spark, d) -> DataFrame:
    r, listed, _ = _folder(spark, d)
    return runs.selection(r, listed)


@query(f"""WITH {_FILES} SELECT 'run' AS kind, run AS path, CASE WHEN status <> 'finished' THEN 'not finished' ELSE 'lists no files' END AS reason FROM ru WHERE status <> 'finished' OR NOT lists
UNION ALL SELECT 'file', path, CASE WHEN path LIKE 'loose/%' THEN 'outside of runs' ELSE 'not listed by its run' END FROM pr WHERE path NOT IN (SELECT path FROM se) AND substr(path, 1, 2) NOT IN ('r3', 'r4')""")
def runs_skipped(spark, d) -> DataFrame:
    return runs.skipped(*_folder(spark, d))


@query(f"WITH {_FILES} SELECT se.path, CASE WHEN pr.path IS NULL THEN 'missing' ELSE 'another size' END AS problem FROM se LEFT JOIN pr USING (path) WHERE pr.path IS NULL OR pr.bytes <> se.bytes")
def runs_damaged(spark, d) -> DataFrame:
    return runs.damaged(*_folder(spark, d))


_READ = f"""{_FILES}, rd AS (SELECT path, CASE WHEN path LIKE '%src2.jsonl' THEN 'changed' ELSE sha END AS sha, CASE WHEN path LIKE '%src11.jsonl' THEN NULL WHEN path LIKE '%src10.jsonl' THEN rows - 1 ELSE rows END AS rows_read,
  CASE WHEN path LIKE '%src12.jsonl' THEN rows - 1 ELSE rows END AS wt, 0 AS wo, rows % 7 AS fi FROM se WHERE path NOT LIKE '%src0.jsonl' UNION ALL SELECT 'r1/more.jsonl', 'x', 1, 1, 0, 0 UNION ALL SELECT 'else/x.jsonl', 'x', 1, 1, 0, 0),
b AS (SELECT coalesce(se.run, CASE WHEN rd.path LIKE 'r1/%' THEN 'r1' END) AS run, coalesce(se.path, rd.path) AS path, se.path AS sp, rd.path AS rp, se.sha AS s1, rd.sha AS s2, rows, rows_read, wt, wo FROM se FULL JOIN rd ON se.path = rd.path),
pb AS (SELECT run, path, unnest(list_filter([CASE WHEN rp IS NULL THEN 'not read' END, CASE WHEN sp IS NULL THEN 'no finished run lists it' END, CASE WHEN s1 <> s2 THEN 'another sha256' END,
  CASE WHEN sp IS NOT NULL AND rp IS NOT NULL AND rows_read IS NULL THEN 'no row counts' END, CASE WHEN rows_read <> rows THEN 'another number of rows' END, CASE WHEN sp IS NOT NULL AND wt + wo <> rows_read THEN 'rows with and without text don''t add up' END], lambda x: x IS NOT NULL)) AS problem FROM b)"""


def _read_record(spark, d) -> tuple[DataFrame, DataFrame]:
    """The selected files and a scan's record of them, with a fault of each sort."""
    r, listed, _ = _folder(spark, d)
    files = materialize(runs.selection(r, listed), "selection")
    named = lambda n: F.col("path").endswith(f"src{n}.jsonl")
    read = files.where(~named(0)).select(
        "path", F.when(named(2), F.lit("changed")).otherwise(F.col("sha256")).alias("sha256"), F.when(named(11), None).when(named(10), F.col("rows") - 1).otherwise(F.col("rows")).alias("rows_read"),
        F.when(named(12), F.col("rows") - 1).otherwise(F.col("rows")).alias("rows_with_text"), F.lit(0).cast("long").alias("rows_without_text"), (F.col("rows") % 7).alias("findings"),
    )
    more = spark.createDataFrame([("r1/more.jsonl", "x", 1, 1, 0, 0), ("else/x.jsonl", "x", 1, 1, 0, 0)], read.schema)
    return files, materialize(read.union(more), "read")


@query(f"WITH {_READ} SELECT * FROM pb")
def coverage_problems(spark, d) -> DataFrame:
    return runs.problems(*_read_record(spark, d))


@query(f"""WITH {_READ} SELECT se.run, 'fail' AS status, count(*) AS files, count(rd.path) AS files_read, coalesce(sum(rows_read), 0)::BIGINT AS rows_read, coalesce(sum(wt), 0)::BIGINT AS rows_with_text, coalesce(sum(wo), 0)::BIGINT AS rows_without_text, coalesce(sum(fi), 0)::BIGINT AS findings
FROM se LEFT JOIN rd USING (path) GROUP BY 1""")
def coverage_per_run(spark, d) -> DataFrame:
    files, read = _read_record(spark, d)
    return runs.per_run(files, read, runs.problems(files, read))


@query(f"""WITH {_READ}, ok AS (SELECT * FROM rd WHERE path NOT IN ('else/x.jsonl', 'r1/more.jsonl')) SELECT se.run, CASE WHEN se.run IN (SELECT run FROM pb) AND se.run <> 'r1' THEN 'fail' ELSE 'pass' END AS status, count(*) AS files, count(ok.path) AS files_read FROM se LEFT JOIN ok USING (path) GROUP BY 1""")
def coverage_gate_without_extras(spark, d) -> DataFrame:
    """With only selected files read, a run passes unless one of its own files is at fault."""
    files, read = _read_record(spark, d)
    read = read.join(files.select("path"), "path", "left_semi")
    fine = files.where("run = 'r1'").select("path", F.col("sha256").alias("s"), F.col("rows").alias("n"))
    read = read.join(fine, "path", "left").select(
        "path", F.coalesce("s", "sha256").alias("sha256"), F.coalesce("n", "rows_read").alias("rows_read"),
        F.coalesce("n", "rows_with_text").alias("rows_with_text"),
        F.when(F.col("n").isNotNull(), 0).otherwise(F.col("rows_without_text")).cast("long").alias("rows_without_text"), "findings"
    )
    return runs.per_run(files, read, runs.problems(files, read)).select("run", "status", "files", "files_read")


# --- layouts and samples -------------------------------------------------------------------


@query("""WITH RECURSIVE f AS (SELECT source AS path, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, path) AS n FROM f),
g AS (SELECT 0::BIGINT AS n, [0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT] AS t, 0::BIGINT AS k UNION ALL SELECT o.n, list_transform(t, lambda x, i: CASE WHEN i = list_position(t, list_min(t)) THEN x + o.bytes ELSE x END), list_position(t, list_min(t)) FROM g JOIN o ON o.n = g.n + 1)
SELECT path, bytes, (k - 1)::INT AS shard FROM o JOIN g USING (n)""")
def byte_balance(spark, d) -> DataFrame:
    files = table(spark, d, "documents").groupBy(F.col("source").alias("path")).agg(F.sum(F.octet_length("text")).cast("long").alias("bytes"))
    return layout.balanced(files, 4)


@query("SELECT path, ((row_number() OVER (ORDER BY path) - 1) % 3)::INT AS chunk FROM (SELECT DISTINCT source AS path FROM documents)")
def files_to_chunks(spark, d) -> DataFrame:
    return layout.dealt(table(spark, d, "documents").select(F.col("source").alias("path")).distinct(), 3, ["path"])


_NUMBERED = "x AS (SELECT source AS source_file, doc_id, strlen(text)::BIGINT AS bytes, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS source_line FROM documents)"


def _numbered(spark, d) -> DataFrame:
    from screenwright.operators.numbering import numbered

    held = table(spark, d, "documents").select(F.col("source").alias("source_file"), "doc_id", F.octet_length("text").cast("long").alias("bytes"))
    return numbered(held, ["doc_id"], ["source_file"], "source_line")


@query(f"WITH {_NUMBERED} SELECT source_file, (source_line - 1) // 25 AS part, ((source_line - 1) // 25 % 4)::INT AS chunk, count(*) AS n_rows, min(doc_id) AS first_doc FROM x GROUP BY ALL")
def split_parts(spark, d) -> DataFrame:
    return layout.parts(_numbered(spark, d), 25, 4).groupBy("source_file", "part", "chunk").agg(
        F.count("*").alias("n_rows"), F.min("doc_id").alias("first_doc")
    )


@query(f"""WITH {_NUMBERED}, o AS (SELECT *, sum(bytes) OVER (PARTITION BY source_file ORDER BY source_line ROWS UNBOUNDED PRECEDING) - bytes AS at FROM x)
SELECT source_file, (at // 20000)::BIGINT AS unit, min(source_line) AS start_line, max(source_line) AS end_line, sum(bytes)::BIGINT AS bytes FROM o GROUP BY 1, 2""".replace(" AS at", " AS pos").replace("(at //", "(pos //"))
def work_units(spark, d) -> DataFrame:
    return layout.units(_numbered(spark, d).drop("doc_id"), 20_000)


@query("SELECT doc_id, (SELECT count(*) FROM documents) - 70 AS left_out FROM documents ORDER BY source, doc_id LIMIT 70")
def max_rows(spark, d) -> DataFrame:
    out, left = layout.first_rows(table(spark, d, "documents").select("source", "doc_id"), ["source", "doc_id"], 70)
    return out.select("doc_id", F.lit(left).cast("long").alias("left_out"))


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 30 OFFSET 90")
def sample_window(spark, d) -> DataFrame:
    return layout.window_of(table(spark, d, "documents").select("doc_id"), ["doc_id"], 90, 30)


@query("SELECT doc_id, row_number() OVER (ORDER BY sha256('7:' || doc_id), doc_id) AS position FROM documents")
def seeded_shuffle(spark, d) -> DataFrame:
    return layout.shuffled(table(spark, d, "documents").select("doc_id"), "doc_id", 7)


@query(f"WITH {B.HITS}, {B.VALID}, r AS (SELECT source_file, source_line, category, value, row_number() OVER (PARTITION BY source_file, source_line ORDER BY category, value) AS k FROM valid) SELECT source_file, source_line, category, value FROM r WHERE k <= 2")
def first_findings(spark, d) -> DataFrame:
    return layout.first_of_each(pii.validate(_hits(spark, d), _CATEGORIES).select(*LOC, "category", "value"), LOC, ["category", "value"], 2)


# --- chats and mappings --------------------------------------------------------------------


@query(f"WITH {B.TURNS} SELECT conv_id, count(*) AS n_messages, md5(string_agg(role || '=' || content, '|' ORDER BY i)) AS said FROM t GROUP BY 1")
def parallel_arrays(spark, d) -> DataFrame:
    """Conversations held as two parallel arrays, read back as messages."""
    c = chats(spark, d).select(
        "conv_id",
        F.struct(
            F.transform("messages", lambda m: m["role"]).alias("from"),
            F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))).alias("value")
        ).alias("conversations")
    )
    m = c.withColumn("messages", readers.from_parallel("conversations"))
    return m.select(
        "conv_id", F.size("messages").cast("long").alias("n_messages"),
        F.md5(F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|").cast("binary")).alias("said")
    )


@query(f"WITH {B.TURNS} SELECT conv_id, count(*) AS n_messages, md5(string_agg(CASE WHEN role = 'system' THEN 'user' ELSE role END || '=' || content, '|' ORDER BY i)) AS said FROM t GROUP BY 1")
def nested_messages(spark, d) -> DataFrame:
    """Messages at a path of a JSON record; a missing role is ``user``."""
    turn = lambda m: F.struct(F.when(m["role"] != "system", m["role"]).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"))
    record = F.struct(F.struct(F.transform("messages", turn).alias("input")).alias("params"))
    m = chats(spark, d).select("conv_id", F.parse_json(F.to_json(record)).alias("r")).select(
        "conv_id", readers.from_nested(F.col("r"), "params", "input").alias("messages")
    )
    return m.select(
        "conv_id", F.size("messages").cast("long").alias("n_messages"),
        F.md5(F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|").cast("binary")).alias("said")
    )


@query("SELECT item_id, which, md5('user:' || text || '|assistant:' || CASE which WHEN 'chosen' THEN text || '!' ELSE reverse(text) END) AS said FROM benchmark, (SELECT unnest(['chosen', 'rejected']) AS which)")
def preference_pairs(spark, d) -> DataFrame:
    b = table(spark, d, "benchmark").select(
        "item_id", F.explode(readers.from_preference(F.col("text"), F.concat("text", F.lit("!")), F.reverse("text"))).alias("p")
    )
    said = F.array_join(F.transform("p.messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return b.select("item_id", "p.which", F.md5(said.cast("binary")).alias("said"))


_MAPPED = "CASE WHEN length(trim(text)) < 400 THEN 'empty_column:text' WHEN lang = 'de' THEN 'empty_column:lang' END"


def _mapped(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    docs = docs.select(
        "source", "doc_id", F.when(F.length(F.trim("text")) >= 400, F.col("text")).otherwise(F.lit(" ")).alias("body"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("lang")
    )
    return readers.mapped(docs, {"text": "body", "lang": "lang", "doc_id": "doc_id", "source": "source"}, ["text", "lang"])


@query(f"SELECT source AS file, split_part(r, ':', 1) AS skip_reason, split_part(r, ':', 2) AS \"column\", count(*) AS n_rows FROM (SELECT source, {_MAPPED} AS r FROM documents) WHERE r IS NOT NULL GROUP BY ALL")
def skipped_rows(spark, d) -> DataFrame:
    return readers.skip_counts(_mapped(spark, d), "source")


@query("SELECT doc_id, CASE WHEN length(text) < 400 THEN 'empty_column:text' END AS skip_reason, length(text)::INT AS characters FROM (SELECT doc_id, CASE WHEN length(trim(text)) >= 400 THEN text ELSE ' ' END AS text FROM documents ORDER BY doc_id LIMIT 40)")
def mapping_preview(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.when(F.length(F.trim("text")) >= 400, F.col("text")).otherwise(F.lit(" ")).alias("body"))
    return readers.preview(docs, {"text": "body", "doc_id": "doc_id"}, ["text"], 40, ["doc_id"]).select("doc_id", "skip_reason", "characters")


# --- benchmark records ---------------------------------------------------------------------

_SHAPES = """'{"id": ' || item_id || ', "question": "q' || item_id || '"}', '{"Question": " q' || item_id || ' ", "options": ["one", "two"], "metadata": {"uuid": "u' || item_id || '"}}',
  '{"question_id": "", "QUESTION": "q", "opa": "a", "opb": "b", "opc": "", "opd": ' || item_id || '}', '{"prompt": [{"role": "", "content": "p' || item_id || '"}, {"content": 3}], "sample_id": "s' || item_id || '"}',
  '{"conversation": {"messages": [{"role": "system", "content": ["x", {"text": "y"}]}]}, "id": [1, 2]}', '{"CONTEXTS": ["c1", "", "c2"], "query": "q' || item_id || '", "answer_options": "free text"}', '{"other": ' || item_id || '}'"""


def _records(spark, d) -> DataFrame:
    shapes = F.expr(f"element_at(array({_SHAPES}), cast(item_id % 7 as int) + 1)")
    return table(spark, d, "benchmark").select("item_id", F.parse_json(shapes).alias("r"))


@query("""WITH q AS (SELECT item_id, item_id % 7 AS k FROM benchmark) SELECT item_id, CASE k WHEN 0 THEN 'user:q' || item_id WHEN 1 THEN 'user:q' || item_id || chr(10) || chr(10) || 'Options:' || chr(10) || 'A. one' || chr(10) || 'B. two'
  WHEN 2 THEN 'user:q' || chr(10) || chr(10) || 'Options:' || chr(10) || 'A. a' || chr(10) || 'B. b' || chr(10) || 'D. ' || item_id WHEN 3 THEN 'user:p' || item_id WHEN 4 THEN 'system:x' || chr(10) || 'y'
  WHEN 5 THEN 'user:Context:' || chr(10) || 'c1' || chr(10) || 'c2' || chr(10) || chr(10) || 'Question:' || chr(10) || 'q' || item_id || chr(10) || chr(10) || 'Options:' || chr(10) || 'free text' ELSE '' END AS prompt FROM q""")
def benchmark_prompts(spark, d) -> DataFrame:
    said = F.array_join(F.transform(P.prompt_messages(F.col("r")), lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return _records(spark, d).select("item_id", said.alias("prompt"))


@query("""SELECT item_id, CASE item_id % 7 WHEN 0 THEN item_id::VARCHAR WHEN 1 THEN 'u' || item_id WHEN 3 THEN 's' || item_id WHEN 4 THEN '[1,2]' ELSE '' END AS record_id,
  CASE item_id % 7 WHEN 0 THEN item_id::VARCHAR WHEN 3 THEN 's' || item_id WHEN 4 THEN '[1,2]' ELSE '' END AS source_id FROM benchmark""")
def record_identifiers(spark, d) -> DataFrame:
    return _records(spark, d).select(
        "item_id", P.record_identifier(F.col("r")).alias("record_id"),
        F.when(F.col("item_id") % 7 == 4, F.lit("[1,2]")).otherwise(P.source_identifier(F.col("r"))).alias("source_id")
    )


# --- findings of all readers ---------------------------------------------------------------

_CATEGORIES = ["emails", "ips", "credit_cards", "phones"]


def _hits(spark, d) -> DataFrame:
    return pii.hits(rows(spark, d), LOC, "text", _CATEGORIES)


@query("""WITH s AS (SELECT source AS source_file, doc_id AS source_line, sha256(text) AS source_sha256, CASE doc_id % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'city' ELSE 'first_name' END AS label, doc_id % 4 <> 0 AS eligible, substr(text, 1, 5) AS text FROM documents)
SELECT source_file, source_line, source_sha256, 'ner_pii' AS reason, 'ner_pii' AS scanner, label || ':' || text AS finding FROM s WHERE eligible AND label <> 'city'""")
def ner_findings(spark, d) -> DataFrame:
    k = F.col("source_line") % 3
    label = F.when(k == 0, F.lit("email")).when(k == 1, F.lit("city")).otherwise(F.lit("first_name"))
    spans = rows(spark, d).select(
        *LOC, "source_sha256", label.alias("label"), (F.col("source_line") % 4 != 0).alias("eligible"), F.substring("text", 1, 5).alias("text")
    )
    return filtering.ner_hits(spans, filtering.Rules(ignored_labels=("city",)))


_JUDGED = """g AS (SELECT d.source AS source_file, doc_id AS source_line, CASE WHEN toxic = 1 THEN 'Unsafe' WHEN quality = 0 THEN 'Controversial' WHEN quality = 1 THEN 'Safe' ELSE 'what?' END AS verdict, CASE WHEN doc_id % 10 = 0 THEN 'timeout' END AS error,
  CASE WHEN doc_id % 4 = 0 THEN 'KEEP_GENERAL' WHEN doc_id % 4 = 1 THEN 'REMOVE' END AS policy, sha256(text) AS source_sha256 FROM documents d JOIN labels USING (doc_id)),
go AS (SELECT *, CASE WHEN error IS NOT NULL OR verdict NOT IN ('Safe', 'Unsafe', 'Controversial') THEN 'guard_error' ELSE lower(verdict) END AS outcome FROM g)"""


def _judged(spark, d) -> DataFrame:
    r = rows(spark, d).select("source_file", F.col("source_line").alias("doc_id"), "source_sha256")
    j = table(spark, d, "labels").join(r, "doc_id")
    verdict = F.when(F.col("toxic") == 1, F.lit("Unsafe")).when(
        F.col("quality") == 0, F.lit("Controversial")
    ).when(F.col("quality") == 1, F.lit("Safe")).otherwise(F.lit("what?"))
    k = F.col("doc_id") % 4
    policy = F.when(k == 0, F.lit("KEEP_GENERAL")).when(k == 1, F.lit("REMOVE"))
    return j.select(
        "source_file", F.col("doc_id").alias("source_line"), "source_sha256", verdict.alias("verdict"),
        F.when(F.col("doc_id") % 10 == 0, F.lit("timeout")).alias("error"), policy.alias("policy")
    )


@query(f"WITH {_JUDGED} SELECT source_file, source_line, 'toxicity_' || outcome AS reason, outcome AS finding FROM go WHERE coalesce(policy, '') <> 'KEEP_GENERAL' AND outcome IN ('unsafe', 'controversial', 'guard_error')")
def toxicity_findings(spark, d) -> DataFrame:
    """Guard verdicts after the policy judge; errors remove a row, and so do two of the verdicts."""
    rules = filtering.Rules(verdicts=("unsafe", "controversial"), guard_errors_remove=True)
    return filtering.toxicity_hits(_judged(spark, d), rules).select(*LOC, "reason", "finding")


@query(f"WITH {_JUDGED} SELECT outcome, coalesce(policy, '') = 'KEEP_GENERAL' AS kept, outcome IN ('unsafe', 'controversial') AND policy IS NULL AS to_judge, count(*) AS n FROM go GROUP BY ALL")
def policy_routing(spark, d) -> DataFrame:
    j = _judged(spark, d).withColumn("outcome", toxicity.guard_outcome(F.col("verdict"), F.col("error")))
    return j.groupBy(
        "outcome", toxicity.policy_keeps(F.col("policy")).alias("kept"), toxicity.needs_policy(F.col("outcome"), F.col("policy")).alias("to_judge")
    ).agg(F.count("*").alias("n"))


@query(f"""WITH {_JUDGED}, t AS (SELECT count(*) AS flagged, count(*) FILTER (outcome IN ('safe', 'unsafe', 'controversial')) AS judged, count(*) FILTER (error IS NOT NULL) AS errors FROM go)
SELECT k AS shard, CASE k WHEN 0 THEN '' WHEN 1 THEN 'flagged lines' WHEN 2 THEN 'records read' ELSE 'verdicts, errors and unknown' END AS problems FROM t, (SELECT unnest(range(0, 4)) AS k)""")
def guard_counts_check(spark, d) -> DataFrame:
    """The true counts, and three in which one of them is off."""
    j = _judged(spark, d).withColumn("outcome", toxicity.guard_outcome(F.col("verdict"), F.col("error")))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    bad, known = F.col("error").isNotNull(), F.col("outcome").isin("safe", "unsafe", "controversial")
    t = j.agg(
        F.count("*").alias("flagged"), n(known).alias("judged"), n(bad).alias("errors"), n(~bad & ~known).alias("unknown")
    ).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("shard"))
    off = lambda k: (F.col("shard") == k).cast("int")
    found = reconcile.guard_counts(
        F.col("flagged"), F.col("flagged") + off(1), F.col("flagged") + off(2), F.col("judged") + off(3), F.col("errors"), F.col("unknown")
    )
    return t.select("shard", F.array_join(found, ",").alias("problems"))


@query(f"""WITH {_JUDGED}, p AS (SELECT source_file, source_line, bool_or(outcome = 'unsafe') AS u, bool_or(outcome = 'controversial') AS c, bool_or(outcome = 'guard_error') AS e FROM go GROUP BY 1, 2)
SELECT 'unsafe' AS removed, count(*) FILTER (u) AS n_removed, count(*) FILTER (NOT u) AS n_left FROM p UNION ALL SELECT 'unsafe+controversial', count(*) FILTER (u OR c), count(*) FILTER (NOT (u OR c)) FROM p
UNION ALL SELECT 'unsafe+controversial+guard_error', count(*) FILTER (u OR c OR e), count(*) FILTER (NOT (u OR c OR e)) FROM p""")
def impact_what_if(spark, d) -> DataFrame:
    j = _judged(spark, d).withColumn("outcome", toxicity.guard_outcome(F.col("verdict"), F.col("error")))
    return toxicity.what_if(j, LOC, "outcome", (("unsafe",), ("unsafe", "controversial"), ("unsafe", "controversial", "guard_error")))


@query(f"WITH {B.HITS}, {B.VALID}, n AS (SELECT DISTINCT source_file, source_line, category AS name FROM valid) SELECT name, count(*) AS n_rows FROM n GROUP BY 1")
def index_by_name(spark, d) -> DataFrame:
    """Flagged rows by the distinct names among their findings."""
    names = pii.validate(_hits(spark, d), _CATEGORIES).groupBy(*LOC).agg(F.collect_set("category").alias("names"))
    return names.select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("n_rows"))


@query(f"WITH {B.HITS}, {B.VALID} SELECT DISTINCT source_file, source_line FROM valid WHERE category IN ('emails', 'ips')")
def flagged_by_name(spark, d) -> DataFrame:
    names = pii.validate(_hits(spark, d), _CATEGORIES).groupBy(*LOC).agg(F.collect_set("category").alias("names"))
    return names.where(F.arrays_overlap("names", F.array(F.lit("emails"), F.lit("ips")))).select(*LOC)


@query(f"WITH {B.HITS}, s AS (SELECT h.*, text, strpos(text, value) - 1 AS st FROM h JOIN documents ON source = source_file AND doc_id = source_line) SELECT source_file, source_line, category, value, st::INT AS first_start, least((length(text) - length(replace(text, value, ''))) // length(value), 50)::BIGINT AS n_places FROM s")
def value_highlights(spark, d) -> DataFrame:
    both = pii.extract(_hits(spark, d), rows(spark, d), LOC, "text").withColumn("p", pii.value_places(F.col("whole_line"), F.col("value")))
    return both.select(*LOC, "category", "value", F.get("p", F.lit(0))["start"].alias("first_start"), F.size("p").cast("long").alias("n_places"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'no such message' WHEN doc_id % 60 >= doc_id % 50 + 10 OR doc_id % 50 + 10 > length(text) THEN 'outside of the text' WHEN doc_id % 50 + 10 > 40 THEN 'beyond the part that is shown' END AS why,
  CASE WHEN doc_id % 5 <> 0 AND doc_id % 60 < doc_id % 50 + 10 AND doc_id % 50 + 10 <= length(text) AND doc_id % 50 + 10 <= 40 THEN substr(text, (doc_id % 60 + 1)::INT, (doc_id % 50 + 10 - doc_id % 60)::INT) END AS matched FROM documents""")
def span_highlights(spark, d) -> DataFrame:
    start, end = (F.col("doc_id") % 60).cast("int"), (F.col("doc_id") % 50 + 10).cast("int")
    h = ner.highlight(F.when(F.col("doc_id") % 5 != 0, F.col("text")), start, end, 40)
    return table(spark, d, "documents").select("doc_id", h.alias("h")).select("doc_id", "h.why", "h.matched")


# --- reconciliation ------------------------------------------------------------------------

_KEYS = ["source_file", "source_line", "source_sha256", "category", "value"]


@query(f"""WITH {B.HITS} SELECT source_file, source_line, category, value, CASE WHEN source_line % 5 = 0 THEN 'missing' ELSE 'unexpected' END AS status FROM h WHERE source_line % 5 = 0 AND source_line % 7 <> 0 OR source_line % 7 = 0 AND source_line % 5 <> 0""")
def stage_differences(spark, d) -> DataFrame:
    """Candidates of two stages by their five-column key: one stage lacks some rows, the other has some more."""
    h = materialize(_hits(spark, d).join(rows(spark, d).select(*LOC, "source_sha256"), LOC), "candidates")
    return reconcile.differences(h.where("source_line % 7 <> 0"), h.where("source_line % 5 <> 0"), _KEYS).drop("source_sha256")


@query(f"WITH {_NUMBERED} SELECT source_file, doc_id FROM x WHERE source_line BETWEEN 3 AND 9 OR (source_file = 'src1' AND source_line BETWEEN 8 AND 5000)")
def scoped_rows(spark, d) -> DataFrame:
    """Rows that the units of a manifest cover: lines 3 to 9 of every file, and more of one."""
    x = _numbered(spark, d)
    units = x.select(F.col("source_file").alias("file")).distinct().select(
        "file", F.lit(3).cast("long").alias("start_line"), F.lit(9).cast("long").alias("end_line")
    )
    units = units.union(spark.createDataFrame([("src1", 8, 5000)], units.schema))
    return reconcile.in_scope(x, units).select("source_file", "doc_id")


@query(f"WITH {B.TURNS}, s AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN NULL ELSE 0 END AS message_index FROM (SELECT DISTINCT conv_id FROM conversations)) SELECT s.conv_id, coalesce(message_index, -1)::INT AS message_index, CASE WHEN message_index IS NULL THEN 'whole' ELSE role END AS role, CASE WHEN message_index IS NULL THEN -1 ELSE length(content) END::INT AS n FROM s JOIN t ON t.conv_id = s.conv_id AND t.i = 0")
def hydrated_samples(spark, d) -> DataFrame:
    """Samples by (conversation, message), some of which name the whole record (a null message)."""
    c = chats(spark, d)
    results = c.select("conv_id", F.posexplode("messages").alias("message_index", "m")).select(
        "conv_id", "message_index", "m.role", F.length(F.coalesce("m.content", F.lit(""))).alias("n")
    )
    whole = c.select("conv_id", F.lit(None).cast("int").alias("message_index"), F.lit("whole").alias("role"), F.lit(-1).alias("n"))
    samples = c.select("conv_id", F.when(F.col("conv_id") % 3 != 0, F.lit(0)).alias("message_index"))
    return reconcile.hydrated(
        samples, results.union(whole), ["conv_id", "message_index"], ["role", "n"]
    ).withColumn("message_index", F.coalesce("message_index", F.lit(-1)))


@query("""WITH a AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'NOT_GENERAL' WHEN quality = 0 THEN 'REVIEW' ELSE 'KEEP_GENERAL' END AS one, CASE doc_id % 3 WHEN 0 THEN 'NOT_GENERAL' WHEN 1 THEN 'KEEP_GENERAL' ELSE 'REVIEW' END AS two,
  CASE doc_id % 4 WHEN 0 THEN 'SAFETY_ONLY' WHEN 1 THEN 'KEEP_GENERAL' WHEN 2 THEN 'REMOVE' ELSE 'REVIEW' END AS three FROM labels) SELECT one, two, three, count(*) AS n FROM a GROUP BY ALL""")
def three_way_results(spark, d) -> DataFrame:
    """Three judges' replies, parsed and laid side by side by record."""
    x = table(spark, d, "labels")
    one = x.select(
        "doc_id",
        reconcile.general_action(
            F.when(F.col("toxic") == 1, F.lit("Unsafe")).when(F.col("quality") == 0, F.lit("?")).otherwise(F.lit("Safe"))
        ).alias("one")
    )
    k, m = F.col("doc_id") % 3, F.col("doc_id") % 4
    tag = F.when(
        k == 0, F.lit("<score>no</score> then <SCORE> YES </SCORE>")
    ).when(k == 1, F.lit("<think>yes</think><score>no</score>")).otherwise(F.lit("<score>maybe</score>"))
    two = x.select("doc_id", P.yes_no_action(tag).alias("two"))
    said = F.when(m == 0, F.lit('```json\n{"action": "safety_only"}\n```')).when(
        m == 1, F.lit('I think {"action": "KEEP_GENERAL", "reason": "x"} fits')
    ).when(m == 2, F.lit('{"action": "REMOVE"}')).otherwise(F.lit('{"action": "DELETE"}'))
    three = x.select("doc_id", P.json_action(said).alias("three"))
    return reconcile.three_way(one, two, three, "doc_id").groupBy("one", "two", "three").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN doc_id % 6 < 3 THEN 'ok' ELSE 'error' END AS status, CASE doc_id % 6 WHEN 0 THEN 'keep' WHEN 1 THEN 'filter' WHEN 2 THEN 'filter' END AS decision, CASE doc_id % 6 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' END AS confidence FROM labels""")
def strict_verdicts(spark, d) -> DataFrame:
    """Replies about pattern hits: three good ones, a decision against its flags, a field too many, no object."""
    row = lambda p, q, dec, conf, more="": '{"is_private_person_pii": %s, "is_public_or_business_info": %s, "decision": "%s", "confidence": "%s", "reason": " r ", "evidence": "e"%s}' % (p, q, dec, conf, more)  # noqa: E731, UP031
    texts = [
        row("true", "false", "keep", "high"), "```json\n" + row("false", "false", "filter", "low") + "\n```",
        "so: " + row("true", "true", "filter", "medium") + " done", row("true", "true", "keep", "low"),
        row("true", "false", "keep", "low", ', "x": 1'), "no idea"
    ]
    reply = F.element_at(F.array(*map(F.lit, texts)), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, d, "labels").select("doc_id", P.strict_verdict(reply).alias("v")).select("doc_id", "v.status", "v.decision", "v.confidence")


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'error' ELSE 'ok' END AS status, CASE doc_id % 5 WHEN 0 THEN 'keep' WHEN 4 THEN NULL ELSE 'filter' END AS decision, CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 4 THEN NULL ELSE 'low' END AS confidence FROM labels""")
def lenient_verdicts(spark, d) -> DataFrame:
    """Replies about model spans: what isn't kept on every count is filtered."""
    texts = [
        '{"is_private_person_pii": true, "exact_match_found": true, "decision": "keep", "confidence": "high"}',
        '{"is_private_person_pii": true, "decision": "keep"}',
        'x {"decision": "keep", "is_private_person_pii": true, "exact_match_found": true, "is_public_or_business_info": true} y', "{}", "[1]"
    ]
    reply = F.element_at(F.array(*map(F.lit, texts)), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "labels").select("doc_id", P.lenient_verdict(reply).alias("v")).select("doc_id", "v.status", "v.decision", "v.confidence")


@query(f"""WITH {_NUMBERED}, u AS (SELECT source_file, (source_line - 1) // 10 AS unit, count(*) AS n, sum(bytes)::BIGINT AS bytes, min(source_line) AS s, max(source_line) AS e FROM x GROUP BY 1, 2)
SELECT source_file, count(*) AS n_units, sum(n)::BIGINT AS n_rows, sum(bytes)::BIGINT AS bytes, max(e) AS rows_expected, sum(e - s + 1)::BIGINT AS rows_covered, max(e) = sum(e - s + 1) AS whole FROM u WHERE NOT (source_file = 'src2' AND unit = 0) GROUP BY 1""")
def units_merged(spark, d) -> DataFrame:
    """Totals of units of ten lines; the first unit of one file is missing."""
    u = _numbered(spark, d).groupBy("source_file", F.expr("(source_line - 1) div 10").alias("unit")).agg(
        F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"), F.min("source_line").alias("start_line"), F.max("source_line").alias("end_line")
    )
    u = materialize(u.where("not (source_file = 'src2' and unit = 0)"), "units")
    return reconcile.merged(u, ["source_file"], ["n_rows", "bytes"]).join(reconcile.unit_rows(u), "source_file")


@query(f"""WITH {B.HITS} SELECT sha256(source_file || chr(0) || source_line || chr(0) || category || chr(0) || value) AS candidate, source_file, source_line, category, value, CASE WHEN source_line % 2 = 0 THEN 1 ELSE 2 END AS unit FROM h""")
def candidates_once(spark, d) -> DataFrame:
    """Candidates of two overlapping units, each once, from the earlier unit."""
    h = materialize(_hits(spark, d), "hits")
    both = h.where("source_line % 2 = 0").withColumn("unit", F.lit(1)).union(h.withColumn("unit", F.lit(2)))
    return reconcile.candidates(both, ["source_file", "source_line", "category", "value"])


@query("""WITH p AS (SELECT source AS category, CASE WHEN doc_id % 3 = 0 THEN 'regurgitated' ELSE 'not_regurgitated' END AS d, CASE doc_id % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'partial_error' ELSE 'ok' END AS s, doc_id % 4 AS tc, doc_id % 2 AS ec FROM documents)
SELECT CASE WHEN grouping(category) = 1 THEN 'TOTAL' ELSE category END AS category, count(*) AS rows, sum(tc)::BIGINT AS trials, sum(ec)::BIGINT AS trial_errors, count(*) FILTER (s = 'error') AS error_rows, count(*) FILTER (s = 'partial_error') AS partial_error_rows,
  count(*) FILTER (d = 'regurgitated') AS regurgitated, count(*) FILTER (d <> 'regurgitated') AS not_regurgitated FROM p GROUP BY CUBE (category)""")
def probe_summary(spark, d) -> DataFrame:
    k = F.col("doc_id")
    status = F.when(k % 5 == 0, F.lit("error")).when(k % 5 == 1, F.lit("partial_error")).otherwise(F.lit("ok"))
    r = table(spark, d, "documents").select(
        F.col("source").alias("category"), F.when(k % 3 == 0, F.lit("regurgitated")).otherwise(F.lit("not_regurgitated")).alias("decision"),
        status.alias("status"), (k % 4).alias("trial_count"), (k % 2).alias("error_count")
    )
    return reconcile.probe_summary(r)


@query("""WITH c AS (SELECT source, doc_id, strlen(text)::BIGINT AS b, CASE WHEN toxic IS NULL THEN 'error' WHEN toxic = 1 AND quality = 0 THEN 'both' WHEN quality = 0 THEN 'pii' WHEN toxic = 1 THEN 'toxicity' ELSE 'kept' END AS class FROM documents LEFT JOIN labels USING (doc_id))
SELECT source AS shard, class, count(*) AS n_rows, sum(b)::BIGINT AS bytes FROM c GROUP BY 1, 2 UNION ALL SELECT '*', class, count(*), sum(b)::BIGINT FROM c GROUP BY 2""")
def quality_shards(spark, d) -> DataFrame:
    """Rows and bytes by class, of each shard and of all; the sums over a shard's classes are the shard's."""
    both = table(spark, d, "documents").select(
        "doc_id", "source", F.octet_length("text").cast("long").alias("bytes")
    ).join(table(spark, d, "labels"), "doc_id", "left")
    outcome = toxicity.guard_outcome_final(F.when(F.col("toxic") == 1, F.lit("UNSAFE")).when(F.col("toxic") == 0, F.lit("safe")))
    rejects = quality.pii_rejects(
        F.when(F.col("quality").isNull(), F.lit("error")).otherwise(F.lit("ok")),
        F.when(F.col("quality") == 0, F.lit("keep")).otherwise(F.lit("filter"))
    )
    c = both.select("source", quality.row_class(F.coalesce(outcome, F.lit("error")), rejects).alias("class"), "bytes")
    cube = c.rollup("class", "source").agg(
        F.grouping("source").alias("_s"), F.grouping("class").alias("_c"), F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes")
    )
    return cube.where("_c = 0").select(F.when(F.col("_s") == 1, F.lit("*")).otherwise(F.col("source")).alias("shard"), "class", "n_rows", "bytes")


_GROUPED = "CASE WHEN {0} = 'src3' THEN 'protected' WHEN {0} LIKE 'src1%' THEN 'ones' WHEN {0} LIKE 'src2%' THEN 'twos' END"


@query(f"""WITH {B.DECIDED}, g AS (SELECT {_GROUPED.format("source_file")} AS mine, coalesce({_GROUPED.format("original_source_file")}, 'unassigned') AS kept FROM dec)
SELECT coalesce(mine, 'unassigned') AS "group", CASE WHEN mine IS NULL THEN '' ELSE kept END AS kept_in, count(*) AS n_rows FROM g WHERE coalesce(mine, '') <> 'protected' GROUP BY 1, 2""")
def duplicates_by_group(spark, d) -> DataFrame:
    """Duplicates by the group of their file and of the file that keeps the row; those of a protected group are left out, those of no group counted."""
    from screenwright.operators import dedup

    dec = dedup.decisions(dedup.digests(rows(spark, d), LOC, F.col("text")), "digest", LOC, LOC)
    groups = spark.createDataFrame([(0, "protected", "src3"), (1, "ones", "src1"), (2, "twos", "src2")], "rank int, group string, prefix string")
    files = table(spark, d, "documents").select("source").distinct()
    of = materialize(reports.first_prefix(files, "source", groups), "groups").where("`group` <> 'protected' or source = 'src3' or `group` is null")
    mine, kept = of.select(F.col("source").alias("source_file"), F.col("group").alias("mine")), of.select(
        F.col("source").alias("original_source_file"), F.col("group").alias("kept")
    )
    both = dec.join(mine, "source_file", "left").join(kept, "original_source_file", "left").where("mine is null or mine <> 'protected'")
    kept_in = F.when(F.col("mine").isNull(), F.lit("")).otherwise(F.coalesce("kept", F.lit("unassigned")))
    return both.groupBy(F.coalesce("mine", F.lit("unassigned")).alias("group"), kept_in.alias("kept_in")).agg(F.count("*").alias("n_rows"))


@query("""WITH s AS (SELECT unnest(['emails', 'zip_codes', 'first_name', 'private_person', 'cvv', 'other']) AS label)
SELECT label, CASE label WHEN 'emails' THEN 'email' WHEN 'zip_codes' THEN 'postcode' ELSE label END AS by_pattern, CASE label WHEN 'first_name' THEN 'person' WHEN 'private_person' THEN 'person' WHEN 'cvv' THEN 'secret' ELSE label END AS category, CASE label WHEN 'private_person' THEN 'person_name' ELSE label END AS by_model FROM s""")
def shared_labels(spark, d) -> DataFrame:
    s = spark.createDataFrame([(x,) for x in ("emails", "zip_codes", "first_name", "private_person", "cvv", "other")], "label string")
    c = F.col("label")
    return s.select(
        "label", ner.mapped_label(c, ner.LABEL_OF_PATTERN).alias("by_pattern"), ner.mapped_label(c, ner.CATEGORY_OF).alias("category"),
        ner.mapped_label(c, ner.LABEL_OF_MODEL).alias("by_model")
    )


_SPANS = "a AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'y' END AS label, k * 20 AS s, k * 20 + 10 AS e FROM documents, (SELECT unnest(range(0, 3)) AS k)), b AS (SELECT doc_id, label, s + doc_id % 13 AS s, e + doc_id % 13 AS e FROM a)"


def _two_models(spark, d) -> tuple[DataFrame, DataFrame]:
    a = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit("x")).otherwise(F.lit("y")).alias("label"),
        F.explode(F.array(F.lit(0), F.lit(20), F.lit(40))).alias("start")
    ).withColumn("end", F.col("start") + 10)
    off = (F.col("doc_id") % 13).cast("int")
    return a, a.select("doc_id", "label", (F.col("start") + off).alias("start"), (F.col("end") + off).alias("end"))


@query(f"WITH {_SPANS} SELECT a.doc_id, a.s::INT AS a_start, b.s::INT AS b_start, round((least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / (greatest(a.e, b.e) - least(a.s, b.s)), 6) AS overlap FROM a JOIN b ON a.doc_id = b.doc_id AND a.label = b.label WHERE least(a.e, b.e) > greatest(a.s, b.s) AND (least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / (greatest(a.e, b.e) - least(a.s, b.s)) >= 0.3")
def span_overlaps(spark, d) -> DataFrame:
    return ner.overlapping(*_two_models(spark, d), ["doc_id"], 0.3).select("doc_id", "a_start", "b_start", F.round("overlap", 6).alias("overlap"))


@query(f"""WITH {_SPANS}, n AS (SELECT a.doc_id, count(*) AS n FROM a JOIN b ON a.doc_id = b.doc_id AND a.s = b.s - a.doc_id % 13 WHERE (least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / (greatest(a.e, b.e) - least(a.s, b.s)) >= 0.5 GROUP BY 1)
SELECT documents.doc_id, 3::BIGINT AS n_left, 3::BIGINT AS n_right, coalesce(n, 0) AS n_matched FROM documents LEFT JOIN n USING (doc_id)""")
def spans_matched(spark, d) -> DataFrame:
    """From one half of the union on, a span of one model meets one span of the other at most."""
    return ner.matched_spans(*_two_models(spark, d), ["doc_id"], 0.5)


# --- decisions of all stages ---------------------------------------------------------------

_FINAL = f"""{B.HITS}, {_JUDGED}, pr AS (SELECT source_file, source_line, 'pii' AS l FROM h WHERE source_line % 7 <> 0 AND source_line % 2 = 0
  UNION SELECT source_file, source_line, 'toxicity_' || CASE WHEN error <> '' OR lower(verdict) NOT IN ('safe', 'unsafe', 'controversial') THEN 'error' ELSE lower(verdict) END FROM g WHERE error <> '' OR lower(verdict) <> 'safe'),
pa AS (SELECT source_file, source_line, list_sort(list(l)) AS r FROM pr GROUP BY 1, 2),
fin AS (SELECT source AS source_file, doc_id AS source_line, strlen(text)::BIGINT AS bytes, coalesce(r, []) AS r FROM documents LEFT JOIN pa ON source = source_file AND doc_id = source_line),
fc AS (SELECT *, CASE WHEN list_contains(r, 'toxicity_error') THEN 'error' WHEN list_contains(r, 'pii') AND len(r) > 1 THEN 'both' WHEN list_contains(r, 'pii') THEN 'pii' WHEN len(r) > 0 THEN 'toxicity' ELSE 'kept' END AS class FROM fin)"""


def _final(spark, d) -> DataFrame:
    """Candidates judged by a model (every seventh request fails, even places are confirmed) and messages judged by a guard."""
    h = _hits(spark, d).select(
        *LOC, F.when(F.col("source_line") % 7 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(F.col("source_line") % 2 == 0, F.lit("keep")).otherwise(F.lit("filter")).alias("decision")
    )
    r = rows(spark, d).select(*LOC, F.octet_length("text").cast("long").alias("bytes"))
    return quality.finalize(r, h, _judged(spark, d), LOC, "bytes")


@query(f"WITH {_FINAL} SELECT source_file, source_line, array_to_string(r, ',') AS reasons, class FROM fc")
def quality_finalize(spark, d) -> DataFrame:
    return _final(spark, d).select(*LOC, F.array_join("reasons", ",").alias("reasons"), "class")


@query(f"WITH {_FINAL} SELECT source_file, count(*) AS input_rows, count(*) FILTER (class = 'kept') AS clean_rows, count(*) FILTER (class <> 'kept') AS rejected_rows, sum(bytes)::BIGINT AS input_bytes, coalesce(sum(bytes) FILTER (class = 'kept'), 0)::BIGINT AS clean_bytes, coalesce(sum(bytes) FILTER (class <> 'kept'), 0)::BIGINT AS rejected_bytes FROM fc GROUP BY 1")
def quality_reconciled(spark, d) -> DataFrame:
    n = lambda c, v: F.sum(F.when(c, v).otherwise(0)).cast("long")
    clean = F.col("class") == "kept"
    return _final(spark, d).groupBy("source_file").agg(
        F.count("*").alias("input_rows"), n(clean, 1).alias("clean_rows"), n(~clean, 1).alias("rejected_rows"), F.sum("bytes").cast("long").alias("input_bytes"), n(clean, F.col("bytes")).alias("clean_bytes"), n(~clean, F.col("bytes")).alias("rejected_bytes"),
    )


@query(f"WITH {_FINAL} SELECT CASE WHEN class = 'kept' THEN CASE WHEN source_line % 6 = 1 THEN 'contamination' ELSE 'none' END WHEN source_line % 6 = 1 THEN 'both' ELSE 'quality' END AS removed_by, count(*) AS n_rows FROM fc GROUP BY 1")
def final_cleaning(spark, d) -> DataFrame:
    """Rows removed by the quality decision, by decontamination, or by both."""
    f = materialize(_final(spark, d).select(*LOC, "class"), "final")
    return quality.final_cleaning(f, f.where("class <> 'kept'"), f.where("source_line % 6 = 1"), LOC).groupBy("removed_by").agg(F.count("*").alias("n_rows"))


@query(f"WITH {B.HITS}, {B.VALID}, a AS (SELECT DISTINCT source_line FROM valid), b AS (SELECT doc_id AS source_line FROM labels WHERE toxic = 1), u AS (SELECT a.source_line AS x, b.source_line AS y FROM a FULL JOIN b ON a.source_line = b.source_line) SELECT count(*) AS in_union, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS in_both, count(*) FILTER (y IS NULL) AS only_left, count(*) FILTER (x IS NULL) AS only_right FROM u")
def location_sets(spark, d) -> DataFrame:
    found = pii.validate(_hits(spark, d), _CATEGORIES).select("source_line")
    return quality.set_counts(found, table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("source_line")), ["source_line"])


@query(f"WITH {B.DECIDED} SELECT source_file, count(*) AS n_selected FROM dec WHERE source_file LIKE 'src1%' AND original_source_file <> 'src0' GROUP BY 1")
def selected_matches(spark, d) -> DataFrame:
    """Matches that a glob rule wants: those rows go, the others stay."""
    from screenwright.operators import dedup

    dec = dedup.decisions(dedup.digests(rows(spark, d), LOC, F.col("text")), "digest", LOC, LOC)
    m = dec.select(
        "source_file", (F.col("source_line") + 1).alias("source_line"), F.col("original_source_file").alias("reference_file"),
        (F.col("original_source_line") + 1).alias("reference_line")
    )
    return dedup.selected(m, ["src1*::src[1-9]*"]).groupBy("source_file").agg(F.count("*").alias("n_selected"))


@query(f"WITH {B.DECIDED} SELECT dec.source_file, dec.source_line, md5(a.text) AS text_md5, md5(b.text) AS original_md5 FROM dec JOIN documents a ON a.doc_id = dec.source_line JOIN documents b ON b.doc_id = dec.original_source_line")
def matched_records(spark, d) -> DataFrame:
    """Each removed row beside the row that it repeats."""
    from screenwright.operators import dedup

    r = rows(spark, d)
    dec = dedup.decisions(dedup.digests(r, LOC, F.col("text")), "digest", LOC, LOC)
    both = dedup.with_records(dec, r, LOC, "text")
    return both.select(*LOC, F.md5(F.col("text").cast("binary")).alias("text_md5"), F.md5(F.col("original_text").cast("binary")).alias("original_md5"))


@query(f"WITH {B.HITS}, {B.VALID}, f AS (SELECT DISTINCT source_file, source_line FROM valid) SELECT 'clean' AS scan, source_file AS file, source_line AS line, true AS automatic FROM f")
def automatic_drop_list(spark, d) -> DataFrame:
    """Two scans of the same findings: one covers its files, the other has a problem and drops nothing."""
    found = pii.validate(_hits(spark, d), _CATEGORIES).join(rows(spark, d).select(*LOC, "source_sha256"), LOC)
    index = found.groupBy(*LOC, "source_sha256").agg(F.array_sort(F.collect_set(F.lit("regex_pii"))).alias("reasons"))
    none = spark.createDataFrame([], "run string, path string, problem string")
    some = spark.createDataFrame([("r", "p", "not read")], none.schema)
    both = [filtering.automatic_drop(index, p, ["regex_pii"], "regex", scan) for scan, p in (("clean", none), ("broken", some))]
    return both[0].union(both[1]).select(F.col("scan_id").alias("scan"), "file", "line", "automatic")


@query(f"WITH {B.HITS} SELECT source_file, source_line, string_agg(DISTINCT category || '=' || value, '|' ORDER BY category || '=' || value) AS hits FROM h GROUP BY 1, 2")
def hits_index(spark, d) -> DataFrame:
    said = F.array_join(F.array_sort(F.transform("hits", lambda x: F.concat(x["category"], F.lit("="), x["value"]))), "|")
    return filtering.hits_by_row(_hits(spark, d)).select(*LOC, said.alias("hits"))


@query("""SELECT item_id, CASE item_id % 6 WHEN 0 THEN 'a/b' || item_id || '.jsonl' WHEN 1 THEN '/a' WHEN 2 THEN 'a/../b' WHEN 3 THEN '' WHEN 4 THEN 'a//b' ELSE 'x..y' END AS path, item_id % 6 IN (0, 5) AS fine FROM benchmark""")
def safe_paths(spark, d) -> DataFrame:
    k = F.col("item_id") % 6
    path = F.when(
        k == 0, F.concat(F.lit("a/b"), F.col("item_id").cast("string"), F.lit(".jsonl"))
    ).when(k == 1, F.lit("/a")).when(k == 2, F.lit("a/../b")).when(k == 3, F.lit("")).when(k == 4, F.lit("a//b")).otherwise(F.lit("x..y"))
    return table(spark, d, "benchmark").select("item_id", path.alias("path"), runs.proper_path(path).alias("fine"))


# --- sinks, read again ---------------------------------------------------------------------


@query(f"WITH {B.HITS}, {B.VALID}, g AS (SELECT DISTINCT source_line FROM valid) SELECT source AS source_file, count(*) FILTER (g.source_line IS NULL) AS kept, count(g.source_line) AS removed, 0::BIGINT AS problems FROM documents LEFT JOIN g ON doc_id = g.source_line GROUP BY 1")
def filter_run_checked(spark, d) -> DataFrame:
    """A filter's result written, read again and held against the decisions."""
    r = rows(spark, d)
    found = pii.validate(_hits(spark, d), _CATEGORIES).join(r.select(*LOC, "source_sha256"), LOC)
    decided = filtering.decide(r, filtering.pii_hits(found, filtering.Rules()))
    path = new_path(spark, "filter-run")
    sinks.write_filter_run(decided, path)
    return sinks.check_filter_run(spark, path, decided)


@query("""WITH l AS (SELECT source AS source_file, unnest(string_split(text, chr(10))) AS raw, doc_id FROM documents) SELECT source_file, CASE WHEN doc_id % 3 = 0 THEN 'filtered_out' ELSE 'filtered' END AS side, count(*) AS n_lines, sum(strlen(raw))::BIGINT AS bytes FROM l GROUP BY ALL""")
def partition_sides(spark, d) -> DataFrame:
    """Lines written to both sides of a decision, and read again."""
    from screenwright.operators.numbering import numbered

    docs = table(spark, d, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "raw"))
    lines = materialize(
        numbered(docs.select(F.col("source").alias("source_file"), "doc_id", "i", "raw"), ["doc_id", "i"], ["source_file"], "source_line"), "lines"
    )
    path = new_path(spark, "sides")
    sinks.write_partition(lines, lines.where("doc_id % 3 = 0"), path)
    both = [sinks.read_lines(spark, f"{path}/{side}").withColumn("side", F.lit(side)) for side in ("filtered", "filtered_out")]
    return both[0].union(both[1]).groupBy("source_file", "side").agg(F.count("*").alias("n_lines"), F.sum(F.octet_length("raw")).cast("long").alias("bytes"))


@query("SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 8 = 0 OR doc_id % 12 = 0")
def resumed_rows(spark, d) -> DataFrame:
    """What is left to do: rows without a good result for their present content."""
    docs = sinks.with_row_key(table(spark, d, "documents").select("doc_id", "text"), ["doc_id", "text"])
    changed = F.when(F.col("doc_id") % 8 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    done = sinks.with_row_key(
        table(spark, d, "documents").where("doc_id % 4 = 0").select(
            "doc_id", changed.alias("text"), F.when(F.col("doc_id") % 12 == 0, F.lit("timeout")).alias("error")
        ),
        ["doc_id", "text"]
    )
    return sinks.resume(docs, done, ["row_key"], "error is null").select("doc_id")


@query("SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE substr(text, 1, 300) || '...' END AS shown FROM documents")
def truncated_texts(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.truncated(F.col("text"), 300, mark="...").alias("shown"))
