"""Files as tasks of bounded size, from any store that Spark reads.

Small files are read whole by Spark's binary source.  Larger ones are cut into
byte ranges, a task each, that workers read through ``pyarrow.fs`` (local files,
HDFS, S3, GCS); the listing itself is Spark's, without contents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files beyond this size are read in ranges of it.
RANGE_BYTES = 64 << 20


class Bytes:
    """Random access to a file: its bytes from ``at`` on."""

    def __init__(self, path: str, size: int, content: bytes | None = None):
        self.size, self.content = size, content
        if content is None:
            from pyarrow import fs

            plain = "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path
            system, name = fs.FileSystem.from_uri(plain)
            self.file = system.open_input_file(name)

    def read(self, at: int, n: int) -> bytes:
        return self.content[at : at + n] if self.content is not None else self.file.read_at(max(0, min(n, self.size - at)), at)


def scan(
    spark: SparkSession, path: str, kernel: Callable[[str, Bytes, int, int], Iterator], fields: str, range_bytes: int = RANGE_BYTES, glob: str = "*"
) -> DataFrame:
    """What ``kernel(name, bytes, start, end)`` makes (record batches of ``fields``) of each range of each file under ``path``.

    ``name`` is the path below ``path``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    root = path.rstrip("/").split("/")[-1]

    def run(batches):
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            contents = batch.column(4)
            for i, (name, size, start, end) in enumerate(zip(*columns, strict=True)):
                held = contents[i].as_py()
                yield from kernel(name.split(f"/{root}/")[-1], Bytes(name, size, held), start, end)

    small = files.where(F.col("length") <= range_bytes).select("path", "length", F.lit(0).cast("long").alias("start"), F.col("length").alias("end"), "content")
    large = files.where(F.col("length") > range_bytes).select("path", "length")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    large = large.withColumn("start", start).withColumn("end", F.least(F.col("start") + range_bytes, F.col("length")))
    out = small.mapInArrow(run, fields)
    if large.limit(1).count():
        n = max(1, large.count())
        held = large.repartition(n, "path", "start").withColumn("content", F.lit(None).cast("binary"))
        out = out.union(held.mapInArrow(run, fields))
    return out
