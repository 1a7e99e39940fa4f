"""JSONL with lineage: line numbers, byte offsets and fingerprints.

Files are cut into byte ranges.  A first pass counts the line ends of every
range, a task for each; prefix sums over the ranges of a file tell each range
the number of its first line; a second pass reads the lines.  The driver sees
neither contents nor counts, and the listing is Spark's.  Lines are bytes as they
stand; only CR and LF at the end are left out of the fingerprint.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenwright.sources.ranges import Bytes
from screenwright.storage import materialize

SCHEMA = "source_file string, source_line long, byte_offset long, raw binary, source_sha256 string"
RANGE_BYTES = 256 << 20
#: A worker reads so many bytes at a time, and hands on about as many.
READ_BYTES = 4 << 20


def files_of(path: str, suffix: str = ".jsonl") -> list[tuple[str, str]]:
    """(path, relative name) of the files under a local folder, sorted; a single file stands for itself."""
    if os.path.isfile(path):
        return [(path, os.path.basename(path))]
    found = [os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(suffix)]
    return [(f, os.path.relpath(f, path)) for f in sorted(found)]


def listed(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(path, name, length) of the files under a folder of any store; ``name`` is relative to it.  A single file stands for itself."""
    root = path.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    alone = root.endswith(glob.lstrip("*")) and glob != "*"
    files = (files if alone else files.option("pathGlobFilter", glob)).load(root).select("path", "length")
    plain = root.split("://", 1)[-1] if "://" in root else os.path.abspath(root)
    at = F.call_function("instr", F.col("path"), F.lit(plain if "://" not in root else root.split("://", 1)[1]))
    name = F.when(F.col("path").endswith(plain), F.element_at(F.split("path", "/"), -1)).otherwise(F.expr("path").substr(at + len(plain) + 1, F.length("path")))
    return files.select("path", name.alias("name"), "length")


def _counts(batches):
    """Adds the number of line ends of each range."""
    import pyarrow as pa

    for batch in batches:
        lines = []
        for path, length, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start", "end")), strict=True):
            data, n = Bytes(path, length), 0
            for at in range(start, end, READ_BYTES):
                n += data.read(at, min(READ_BYTES, end - at)).count(b"\n")
            lines.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, type=pa.int64())], names=[*batch.schema.names, "lines"])


def _lines(data: Bytes, start: int, end: int):
    """(byte offset, line) of the lines that begin in a range; the line that runs into it belongs to the range before."""
    at = start
    if start:
        at = start - 1
        while (block := data.read(at, READ_BYTES)) and b"\n" not in block:
            at += len(block)
        at += block.find(b"\n") + 1 if block else 0
    held, begin = b"", at
    while begin < end:
        block = data.read(at, READ_BYTES)
        at += len(block)
        pieces = (held + block).split(b"\n")
        held = pieces.pop()
        for piece in pieces:
            if begin >= end:
                return
            yield begin, piece + b"\n"
            begin += len(piece) + 1
        if not block:
            if held and begin < end:
                yield begin, held
            return


def _read(batches):
    import pyarrow as pa

    def batch(rows):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["source_file", "source_line", "byte_offset", "raw", "source_sha256"]
        )

    for part in batches:
        for path, name, length, start, end, before in zip(
            *(part.column(c).to_pylist() for c in ("path", "name", "length", "start", "end", "before")), strict=True
        ):
            data, rows, size, line = Bytes(path, length), [], 0, before + 1
            # a line that begins before the range ends in it, unless the byte before is a line end
            if start and data.read(start - 1, 1) != b"\n":
                line += 1
            for at, raw in _lines(data, start, end):
                rows.append((name, line, at, raw, hashlib.sha256(raw.rstrip(b"\r\n")).hexdigest()))
                line, size = line + 1, size + len(raw)
                if size > READ_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)


def read_jsonl(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, names: list[str] | None = None) -> DataFrame:
    """SCHEMA rows of every line, blank ones included; ``names`` keeps to files of a manifest."""
    files = listed(spark, path).where("length > 0")
    if names is not None:
        files = files.join(F.broadcast(spark.createDataFrame([(n,) for n in names], "name string")), "name", "left_semi")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = materialize(
        files.withColumn("start", start).withColumn(
            "end", F.least(F.col("start") + range_bytes, F.col("length"))
        ).select("path", "name", "length", "start", "end"),
        "ranges"
    )
    n = max(1, min(ranges.count(), 100_000))
    counted = materialize(
        ranges.repartition(n, "path", "start").mapInArrow(_counts, "path string, name string, length long, start long, end long, lines long"),
        "range-lines"
    )
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.withColumn("before", before).repartition(n, "path", "start").mapInArrow(_read, SCHEMA)


def objects(lines: DataFrame) -> DataFrame:
    """The lines that aren't blank as VARIANT ``value``; a line that is no JSON object stops the run."""
    text = F.col("raw").cast("string")
    held = lines.where(F.trim(F.regexp_replace(text, r"[\r\n]+\z", "")) != "")
    value = F.try_parse_json(text)
    good = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    bad = F.raise_error(F.concat(F.col("source_file"), F.lit(":"), F.col("source_line").cast("string"), F.lit(" is no JSON object")))
    return held.withColumn("value", F.parse_json(F.when(good, text).otherwise(bad.cast("string"))))


def refuse_written(lines: DataFrame) -> DataFrame:
    """Stops on lines that the engine itself has written as notes (``{"_origin"`` or ``{"_parent"``)."""
    own = F.ltrim(F.col("raw").cast("string")).rlike(r'^\{\s*"_(?:origin|parent)"')
    return lines.withColumn(
        "raw", F.when(own, F.raise_error(F.lit("a line of the engine's own notes was given as input")).cast("binary")).otherwise(F.col("raw"))
    )
