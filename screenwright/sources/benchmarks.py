"""Benchmark files of several formats as records, and their prompts as rows."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwright.functions.prompts import prompt_messages, source_identifier

SUFFIXES = (".jsonl", ".csv", ".parquet")


def _records(name: str, content: bytes, headerless: tuple[str, ...]):
    """(line, record) of a file; the line of a CSV record counts the header, if there is one, as 1."""
    if name.endswith(".jsonl"):
        for n, line in enumerate(content.decode("utf-8").split("\n"), 1):
            if line.strip():
                record = json.loads(line)
                if not isinstance(record, dict):
                    raise ValueError(f"{name}:{n} is no JSON object")
                yield n, record
    elif name.endswith(".csv"):
        lines = io.StringIO(content.decode("utf-8-sig"), newline="")
        if name.startswith(headerless):
            for n, row in enumerate(csv.reader(lines), 1):
                if len(row) < 3:
                    raise ValueError(f"{name}:{n} has no question, options and answer")
                yield n, {"question": row[0], "options": row[1:-1], "answer": row[-1]}
        else:
            for n, record in enumerate(csv.DictReader(lines), 2):
                yield n, record
    else:
        import pyarrow.parquet as pq

        n = 0
        for batch in pq.ParquetFile(io.BytesIO(content)).iter_batches(batch_size=4096):
            for record in batch.to_pylist():
                n += 1
                yield n, record


def read_benchmarks(spark: SparkSession, path: str, headerless: tuple[str, ...] = ()) -> DataFrame:
    """(source_file, source_line, format, record): every record of the benchmark files under a folder, ``record`` as VARIANT.

    ``headerless`` lists beginnings of the names of CSV files without a header:
    a question, options, an answer.  A file is one task: benchmark files are
    small next to corpora.  A malformed file stops the run.
    """
    root = path.rstrip("/").split("/")[-1]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    wanted = F.lit(False)
    for s in SUFFIXES:
        wanted = wanted | F.lower("path").endswith(s)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for full, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = full.split(f"/{root}/")[-1]
                rows = [(name, n, json.dumps(r, ensure_ascii=False, default=str)) for n, r in _records(name, content.as_py(), headerless or ("\x00",))]
                columns = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)],
                    names=["source_file", "source_line", "record"]
                )

    rows = found.where(wanted).mapInArrow(run, "source_file string, source_line long, record string")
    kind = F.lower(F.element_at(F.split("source_file", r"\."), -1))
    return rows.select("source_file", "source_line", kind.alias("format"), F.parse_json("record").alias("record"))


def prepared(records: DataFrame) -> DataFrame:
    """Contract rows of benchmark records: messages, and where they come from; records without a prompt have no messages (``skipped``)."""
    m = records.withColumn("messages", prompt_messages(F.col("record")))
    steps = F.split("source_file", "/")
    return m.select(
        "messages", F.col("source_file").alias("benchmark_source_file"), F.col("source_line").alias("benchmark_source_line"), F.col("format").alias("benchmark_source_format"),
        source_identifier(F.col("record")).alias("benchmark_id"), F.get(steps, F.lit(0)).alias("benchmark_suite"),
        F.array_join(F.slice(steps, F.lit(1), F.size(steps) - 1), "/").alias("benchmark_dataset"), (F.size("messages") == 0).alias("skipped"),
    )
