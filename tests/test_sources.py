import json

import pytest
from pyspark.sql import functions as F

from screenwright.functions import text as T
from screenwright.operators import filtering
from screenwright.sources import jsonl, readers, sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "a.jsonl").write_bytes(b'{"text":"one"}\n\n{"text":"two\xc3\xa9"}\r\n{"text":"three"}')
    (tmp_path / "b" / "c.jsonl").write_bytes(b"".join(b'{"text":"%d"}\n' % i for i in range(500)))
    return tmp_path


@pytest.mark.parametrize("size", [1, 7, 16, 100, 1 << 20])
def test_lines_do_not_depend_on_ranges(spark, folder, size):
    got = sorted(
        (r.source_file, r.source_line, r.byte_offset, bytes(r.raw)) for r in jsonl.read_jsonl(spark, str(folder), size).collect()
    ) if size > 7 else None
    if got is None:
        got = sorted((r.source_file, r.source_line, r.byte_offset, bytes(r.raw)) for r in jsonl.read_jsonl(spark, str(folder / "a.jsonl"), size).collect())
    want = []
    for path, name in jsonl.files_of(str(folder) if size > 7 else str(folder / "a.jsonl")):
        at = 0
        for i, raw in enumerate(open(path, "rb").read().splitlines(keepends=True), 1):
            want.append((name, i, at, raw))
            at += len(raw)
    assert got == sorted(want)


def test_objects_and_extractors(spark, folder):
    lines = jsonl.read_jsonl(spark, str(folder), names=["a.jsonl"])
    got = jsonl.objects(lines).select("source_line", F.try_variant_get("value", "$.text", "string").alias("t")).collect()
    assert sorted((r.source_line, r.t) for r in got) == [(1, "one"), (3, "twoé"), (4, "three")]
    bad = spark.createDataFrame([("f", 1, 0, bytearray(b"[1]"), "")], jsonl.SCHEMA)
    with pytest.raises(Exception, match="no JSON object"):
        jsonl.objects(bad).collect()
    note = spark.createDataFrame([("f", 1, 0, bytearray(b'{ "_origin": 1}'), "")], jsonl.SCHEMA)
    with pytest.raises(Exception, match="own notes"):
        jsonl.refuse_written(note).collect()


def test_content_blocks(spark):
    df = spark.createDataFrame([('["a",{"text":"b"},{"x":1}]',), ('"s"',), ("3",)], "j string")
    assert [r[0] for r in df.select(T.content_text(F.parse_json("j"))).collect()] == ["a\nb", "s", ""]


def test_messages(spark):
    m = lambda *x: [{"role": r, "content": c} for r, c in x]
    rows = [
        ("", m(("user", "hi"))), (None, m(("system", "S"), ("user", "U"), ("assistant", "A"))), (None, m(("assistant", "A"))),
        (None, m((None, "x"), ("u", "")))
    ]
    df = spark.createDataFrame(rows, "text string, messages array<struct<role:string,content:string>>")
    t, ms = F.col("text"), F.col("messages")
    got = df.select(
        T.record_text(t, ms), T.dedup_text(t, ms), T.dedup_text(t, ms, "prompt", True), F.size(T.toxicity_units(t, ms)), F.size(T.span_units(t, ms))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("USER:\nhi", "", "", 1, 1), ("SYSTEM:\nS\n\nUSER:\nU\n\nASSISTANT:\nA", "S\nU\nA", "U", 3, 3), ("ASSISTANT:\nA", "A", "A", 1, 1),
        ("MESSAGE_1:\nx", "x", "x", 1, 1)
    ]


def test_manifest_and_mapping(spark):
    assert readers.manifest("a/b.jsonl\n# x\n c # y\n") == ["a/b.jsonl", "c"]
    for bad in ("../x", "/x", "a\na"):
        with pytest.raises(ValueError):
            readers.manifest(bad)
    df = spark.createDataFrame([("x", 1, " "), ("", 2, "q")], "body string, n int, q string")
    got = [r.asDict() for r in readers.mapped(df, {"text": "body"}, ["text", "q"]).collect()]
    assert [g["skip_reason"] for g in got] == ["missing_column:q", "empty_column:text"]
    assert json.loads(got[0]["metadata"]) == {"n": 1, "q": " "}
    assert readers.suggest(df) == {"text": "body"}


def test_readers_and_sinks(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "r.json").write_text('[{"a":1},{"a":2}]')
    assert readers.read_any(spark, str(tmp_path / "r.json")).count() == 2
    (tmp_path / "r.csv").write_text('a,b\n1,"x\ny"\n')
    assert readers.read_any(spark, str(tmp_path / "r.csv")).first().b == "x\ny"
    spark.range(9).write.parquet(str(tmp_path / "r.parquet"))
    assert readers.parquet_rows(str(tmp_path / "r.parquet")) == readers.read_any(spark, str(tmp_path / "r.parquet")).count() == 9
    with pa.OSFile(str(tmp_path / "d.arrow"), "wb") as f, pa.ipc.new_stream(f, pa.schema([("a", pa.int64())])) as w:
        w.write_table(pa.table({"a": [1, 2, 3]}))
    assert readers.read_arrow(spark, str(tmp_path)).count() == 3
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(25)], "id long, text string")
    sinks.write_chunks(rows, str(tmp_path / "chunks"), ["id"], 10, 2)
    back = spark.read.json(str(tmp_path / "chunks"))
    assert sorted((r.chunk, r.batch, r.n) for r in back.groupBy("chunk", "batch").agg(F.count("*").alias("n")).collect()) == [(0, 0, 10), (0, 2, 5), (1, 1, 10)]
    sinks.write_summary(spark, str(tmp_path / "summary.json"), {"rows": 25})
    assert json.loads((tmp_path / "summary.json").read_text()) == {"rows": 25}
    assert sinks.resume(rows, rows.limit(5), ["id"]).count() == 20


def test_lines_are_written_as_they_were(spark, folder, tmp_path):
    lines = jsonl.read_jsonl(spark, str(folder), names=["a.jsonl"])
    sinks.write_lines(lines, str(tmp_path / "out"))
    assert "\n".join(r.value for r in spark.read.option("lineSep", "\n").text(str(tmp_path / "out")).collect()).encode() == (folder / "a.jsonl").read_bytes()


def test_filter_refuses_stale_findings(spark):
    rows = spark.createDataFrame([("f", 1, "a"), ("f", 2, "b")], "source_file string, source_line long, source_sha256 string")
    found = spark.createDataFrame(
        [("f", 1, "a", "x", "s", "1"), ("f", 1, "a", "y", "s", "2")],
        "source_file string, source_line long, source_sha256 string, reason string, scanner string, finding string"
    )
    got = filtering.decide(rows, found)
    assert {r.source_line: r.reasons for r in got.collect()} == {1: ["x", "y"], 2: []}
    assert filtering.conserved(filtering.per_file(got, F.lit(1))).count() == 0
    assert filtering.check_written(rows.where("source_line = 2"), got).count() == 0
    with pytest.raises(Exception, match="another version"):
        filtering.decide(rows.withColumn("source_sha256", F.lit("z")), found).collect()


def test_stream(spark, tmp_path):
    from screenwright.streaming import rows as S

    df = spark.createDataFrame([(1, "mail me at a.b@uni.edu"), (2, "nothing")], "doc_id long, text string")
    df.write.parquet(str(tmp_path / "in"))
    found = S.pii_stream(S.stream_documents(spark, str(tmp_path / "in"), df.schema), ["doc_id"], "text", ["emails"])
    S.write_stream(found, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(60)
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["a.b@uni.edu"]


def test_summary_is_replaced_in_one_step(spark, tmp_path):
    at = str(tmp_path / "s.json")
    for n in (1, 2):
        sinks.write_summary(spark, at, {"n": n}, marker=True)
        assert json.loads((tmp_path / "s.json").read_text()) == {"n": n} and (tmp_path / "_SUCCESS").exists()
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["_SUCCESS", "s.json"]


def test_release_keeps_to_its_own(spark, tmp_path, monkeypatch):
    from screenwright import storage

    monkeypatch.setattr(storage, "shared_root", lambda spark: f"file://{tmp_path}")
    other = tmp_path / "screenwright" / "another-application"
    other.mkdir(parents=True)
    storage.materialize(spark.range(3), "x")
    assert len(list((tmp_path / "screenwright").iterdir())) == 2
    storage.release(spark)
    assert list((tmp_path / "screenwright").iterdir()) == [other]


def test_benchmark_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from screenwright.sources import benchmarks

    root = tmp_path / "bench"
    (root / "a").mkdir(parents=True)
    (root / "mmlu").mkdir()
    (root / "a" / "x.jsonl").write_text('{"question": "q1", "id": 7}\n\n{"nothing": 1}\n')
    (root / "a" / "y.csv").write_text('\ufeffquestion,opa,opb,opc,opd\n"two\nlines",1,2,3,4\n', encoding="utf-8")
    (root / "mmlu" / "z.csv").write_text("which?,one,two,three,four,B\n")
    pq.write_table(pa.table({"prompt": ["p1", "p2"]}), str(root / "a" / "w.parquet"))
    (root / "note.txt").write_text("no benchmark")
    got = benchmarks.prepared(benchmarks.read_benchmarks(spark, str(root), ("mmlu/",))).collect()
    said = {(r.benchmark_source_file, r.benchmark_source_line): r.messages[0].content if r.messages else None for r in got}
    assert said == {
        ("a/x.jsonl", 1): "q1", ("a/x.jsonl", 3): None, ("a/y.csv", 2): "two\nlines\n\nOptions:\nA. 1\nB. 2\nC. 3\nD. 4", ("mmlu/z.csv", 1): "which?\n\nOptions:\nA. one\nB. two\nC. three\nD. four",
        ("a/w.parquet", 1): "p1", ("a/w.parquet", 2): "p2",
    }
    assert {r.benchmark_id for r in got} == {"7", ""} and {r.benchmark_suite for r in got} == {"a", "mmlu"} and sum(r.skipped for r in got) == 1
    (root / "bad.jsonl").write_text("[1]\n")
    with pytest.raises(Exception, match="no JSON object"):
        benchmarks.read_benchmarks(spark, str(root), ("mmlu/",)).collect()


def test_folder_inspection_and_csv(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    for n, size in (("a.jsonl", 3), ("e/b.JSONL", 5), ("e/c.csv", 7), ("e/plain", 1)):
        (tmp_path / "d" / n).write_bytes(b"x" * size)
    got = {r.format: (r.files, r.bytes, r.largest) for r in readers.inspect(spark, str(tmp_path / "d")).collect()}
    assert got == {"jsonl": (2, 8, 5), "csv": (1, 7, 7), "": (1, 1, 1)}
    rows = spark.createDataFrame([(1, 'a "q"\nb,é'), (2, None)], "i int, t string")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv")).orderBy("i").collect()
    assert back[0].t == 'a "q"\nb,é'


def test_missing_results_stop_the_run(spark):
    from screenwright.operators import reconcile

    a = spark.createDataFrame([(1, None), (2, 5)], "k long, m int")
    b = spark.createDataFrame([(1, None, "x")], "k long, m int, v string")
    with pytest.raises(Exception, match="no result"):
        reconcile.hydrated(a, b, ["k", "m"], ["v"]).collect()
    assert reconcile.hydrated(a.limit(1), b, ["k", "m"], ["v"]).first().v == "x"
    with pytest.raises(ValueError, match="missing"):
        reconcile.three_way(a.select("k"), b.select("k"), a.select("k"), "k")
    twice = reconcile.differences(a, a.union(a), ["k", "m"]).collect()
    assert [r.status for r in twice] == ["repeated"] * 2 and reconcile.differences(a, a, ["k", "m"]).count() == 0


def test_a_problem_without_a_run_fails_every_run(spark):
    from screenwright.operators import runs

    files = spark.createDataFrame([("r/a.jsonl", "r", 1, 1, "s")], "path string, run string, rows long, bytes long, sha256 string")
    read = spark.createDataFrame(
        [("r/a.jsonl", "s", 1, 1, 0, 0)], "path string, sha256 string, rows_read long, rows_with_text long, rows_without_text long, findings long"
    )
    assert runs.problems(files, read).count() == 0 and runs.per_run(files, read, runs.problems(files, read)).first().status == "pass"
    more = read.union(spark.createDataFrame([("else.jsonl", "s", 1, 1, 0, 0)], read.schema))
    assert runs.per_run(files, more, runs.problems(files, more)).first().status == "fail"
    assert runs.problems(files, read.limit(0), open_files=files).count() == 0


def test_snapshots(spark, tmp_path):
    import os

    root = tmp_path / "s"
    root.mkdir()
    for n in ("same", "touched", "changed", "missing"):
        (root / n).write_bytes(n.encode())
    before = spark.createDataFrame(readers.snapshot(spark, str(root)).collect(), "path string, bytes long, modified timestamp, sha256 string")
    assert readers.snapshot_changes(before, readers.snapshot(spark, str(root))).count() == 0
    (root / "changed").write_bytes(b"CHANGED")
    os.utime(root / "touched", (1, 1))
    (root / "missing").unlink()
    (root / "new").write_bytes(b"n")
    got = {r.path.split("/")[-1]: r.status for r in readers.snapshot_changes(before, readers.snapshot(spark, str(root))).collect()}
    assert got == {"touched": "touched", "changed": "changed", "missing": "missing", "new": "new"}


def test_decisions_outside_of_the_rows_stop_the_run(spark):
    from screenwright.operators import dedup, quality

    rows = spark.createDataFrame([("f", 1, 10)], "source_file string, source_line long, bytes long")
    none = spark.createDataFrame([], "source_file string, source_line long, status string, decision string")
    guard = "source_file string, source_line long, verdict string, error string"
    at = ["source_file", "source_line"]
    fine = quality.finalize(rows, none, spark.createDataFrame([("f", 1, "UNSAFE", None)], guard), at, "bytes").first()
    assert fine.reasons == ["toxicity_unsafe"] and fine["class"] == "toxicity"
    with pytest.raises(Exception, match="outside of the rows"):
        quality.finalize(rows, none, spark.createDataFrame([("f", 2, "Unsafe", None)], guard), at, "bytes").collect()
    match = spark.createDataFrame([("a", 1, "../b", 1)], "source_file string, source_line long, reference_file string, reference_line long")
    with pytest.raises(Exception, match="no proper place"):
        dedup.selected(match, ["*::*"])
    with pytest.raises(ValueError, match="no match"):
        dedup.selected(match.limit(0), ["*::*"])
    with pytest.raises(Exception, match="no record"):
        dedup.with_records(
            spark.createDataFrame([("f", 1, "f", 9)], "source_file string, source_line long, original_source_file string, original_source_line long"),
            rows.withColumn("t", F.lit("x")), at, "t"
        ).select("text").collect()
