"""Readers of the other formats, file selection, and the row contract."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {".jsonl": "jsonl", ".json": "json", ".csv": "csv", ".parquet": "parquet", ".arrow": "arrow"}


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of objects, or one object: a row each."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, header: bool = True, columns: list[str] | None = None) -> DataFrame:
    out = spark.read.option("header", header).option("inferSchema", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    return out.toDF(*columns) if columns else out


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def read_arrow(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A saved Arrow dataset: the ``.arrow`` stream or file parts that ``state.json`` lists, else all of them; each is one task."""
    import json

    import pyarrow as pa

    root = os.path.join(path, split) if split else path
    state = os.path.join(root, "state.json")
    if os.path.exists(state):
        with open(state) as f:
            parts = [os.path.join(root, d["filename"]) for d in json.load(f)["_data_files"]]
    else:
        parts = sorted(os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".arrow"))
    if not parts:
        raise FileNotFoundError(f"no .arrow files under {root}")

    def opened(name):
        try:
            return pa.ipc.open_stream(name)
        except pa.ArrowInvalid:
            return pa.ipc.open_file(name)

    from pyspark.sql.pandas.types import from_arrow_schema

    schema = from_arrow_schema(opened(parts[0]).schema)

    def load(batches):
        for b in batches:
            for name in b.column("path").to_pylist():
                source = opened(name)
                many = source if isinstance(source, pa.RecordBatchStreamReader) else (source.get_batch(i) for i in range(source.num_record_batches))
                yield from many

    names = spark.createDataFrame([(p,) for p in parts], "path string").repartition(len(parts), "path")
    return names.mapInArrow(load, schema)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    from screenwright.sources.jsonl import objects, read_jsonl

    kind = FORMATS.get(os.path.splitext(path.rstrip("/"))[1])
    if kind is None:
        raise ValueError(f"unknown format: {path}")
    if kind == "jsonl":
        return objects(read_jsonl(spark, path))
    return {"json": read_json, "csv": read_csv, "parquet": read_parquet, "arrow": read_arrow}[kind](spark, path)


def parquet_rows(path: str) -> int:
    """Rows by the footers: a count that doesn't depend on the reader."""
    import pyarrow.parquet as pq

    files = [path] if os.path.isfile(path) else [os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")]
    return sum(pq.ParquetFile(f).metadata.num_rows for f in files)


def manifest(text: str) -> list[str]:
    """Relative paths of a manifest in order; # starts a comment; absolute, escaping or repeated paths are refused."""
    out: list[str] = []
    for line in text.splitlines():
        name = line.split("#", 1)[0].strip()
        if not name:
            continue
        if os.path.isabs(name) or ".." in name.split("/"):
            raise ValueError(f"not a path inside the folder: {name}")
        if name in out:
            raise ValueError(f"listed twice: {name}")
        out.append(name)
    return out


def mapped(rows: DataFrame, mapping: dict[str, str], required: list[str] = ()) -> DataFrame:
    """Contract rows: ``target -> source`` columns (a source that is missing falls back to the target's own name), everything else in ``metadata`` (JSON), and ``skip_reason``.

    The reason is the first required column that is missing (``missing_column``)
    or null, blank or empty (``empty_column``); null for rows that are kept.
    """
    have = set(rows.columns)
    source = {t: s if s in have else t for t, s in mapping.items() if s in have or t in have}
    rest = [c for c in rows.columns if c not in source.values() and c != "metadata"]
    reason = F.lit(None).cast("string")
    for t in reversed(required):
        bad = F.lit(f"missing_column:{t}") if t not in source else F.when(~present(rows, source[t]), F.lit(f"empty_column:{t}"))
        reason = F.coalesce(bad, reason)
    extra = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit("{}")
    if "metadata" in have and "metadata" not in source.values():
        kind = rows.schema["metadata"].dataType.typeName()
        own = F.col("metadata") if kind == "string" else F.to_json("metadata")
        entries = lambda j: F.from_json(j, "map<string,string>")
        extra = F.to_json(F.map_zip_with(F.coalesce(entries(own), F.create_map().cast("map<string,string>")), entries(extra), lambda k, a, b: F.coalesce(b, a)))
    return rows.select(*[F.col(f"`{s}`").alias(t) for t, s in source.items()], extra.alias("metadata"), reason.alias("skip_reason"))


def present(rows: DataFrame, name: str) -> Column:
    kind, c = rows.schema[name].dataType.typeName(), F.col(f"`{name}`")
    if kind == "string":
        return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
    if kind in ("array", "map"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def suggest(rows: DataFrame) -> dict[str, str]:
    """A mapping guessed from names and shapes: an exact name with the right shape first, then name hints."""
    chats = [
        f.name for f in rows.schema if f.dataType.typeName() == "array" and f.dataType.elementType.typeName() == "struct" and {"role", "content"} <= set(
            f.dataType.elementType.names
        )
    ]
    texts = [f.name for f in rows.schema if f.dataType.typeName() == "string"]
    for names, have in (("messages", chats), ("text", texts)):
        if names in have:
            return {names: names}
    if chats:
        return {"messages": chats[0]}
    hints = [c for h in ("content", "body", "document", "prompt", "question") for c in texts if h in c.lower()]
    return {"text": hints[0]} if hints else {}


def preview(rows: DataFrame, mapping: dict[str, str], required: list[str] = (), n: int = 20, order: list[str] = ()) -> DataFrame:
    """The first ``n`` rows (of ``order``, or as they come) as ``mapped`` makes them, with ``characters`` of their text: what a mapping would do, on a sample."""
    made = mapped(rows.orderBy(*order).limit(n) if order else rows.limit(n), mapping, list(required))
    text = F.col("text") if "text" in made.columns else F.lit(None).cast("string")
    said = F.aggregate(
        F.transform("messages", lambda m: F.length(F.coalesce(m["content"], F.lit("")))), F.lit(0), lambda a, x: a + x
    ) if "messages" in made.columns else F.lit(None).cast("int")
    return made.withColumn("characters", F.coalesce(F.length(text), said, F.lit(0)))


def skip_counts(made: DataFrame, file: str) -> DataFrame:
    """(file, skip_reason, column, n_rows) of rows that ``mapped`` skips."""
    gone = made.where("skip_reason is not null")
    return gone.groupBy(
        F.col(file).alias("file"), F.split_part("skip_reason", F.lit(":"), F.lit(1)).alias("skip_reason"),
        F.split_part("skip_reason", F.lit(":"), F.lit(2)).alias("column")
    ).agg(F.count("*").alias("n_rows"))


def from_nested(record: Column, *path: str) -> Column:
    """Messages that stand at a path of a VARIANT record."""
    from screenwright.functions.prompts import at, normal_messages

    return normal_messages(at(record, *path))


def from_preference(prompt: Column, chosen: Column, rejected: Column) -> Column:
    """array<struct<which, messages>>: a preference pair as two conversations."""
    def said(which: str, reply: Column) -> Column:
        turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
        return F.struct(F.lit(which).alias("which"), F.array(turn("user", prompt), turn("assistant", reply)).alias("messages"))

    return F.array(said("chosen", chosen), said("rejected", rejected))


def inspect(spark: SparkSession, path: str) -> DataFrame:
    """(format, files, bytes, largest): what lies under a folder, by the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(name.contains("."), F.lower(F.element_at(F.split(name, r"\."), -1))).otherwise(F.lit(""))
    return files.groupBy(kind.alias("format")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))


def from_parallel(conversations: str, role: str = "from", content: str = "value") -> Column:
    """Messages out of a struct of two parallel arrays."""
    pairs = F.arrays_zip(F.col(f"{conversations}.{role}").alias("role"), F.col(f"{conversations}.{content}").alias("content"))
    return F.transform(pairs, lambda p: F.struct(p["role"].alias("role"), p["content"].alias("content")))


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, modified, sha256) of each file under a folder, hashed where it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def snapshot_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, status): missing, new, changed (other bytes), touched (another time only)."""
    a = before.select("path", F.col("bytes").alias("_b"), F.col("modified").alias("_m"), F.col("sha256").alias("_s"))
    both = a.join(now, "path", "full_outer")
    status = F.when(F.col("sha256").isNull(), F.lit("missing")).when(F.col("_s").isNull(), F.lit("new")).when(F.col("_s") != F.col("sha256"), F.lit("changed")).when(
        F.col("_m") != F.col("modified"), F.lit("touched")
    )
    return both.select("path", status.alias("status")).where("status is not null")
