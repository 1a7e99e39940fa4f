"""Token counts by a separator scan over flat token files.

Documents are tokenised and written as flat files of little-endian 16-bit ids
in which an end-of-document id follows each document: no index, no lengths.
The scan cuts files into blocks, finds the separators of a block in one
vectorised comparison, and stitches documents that cross blocks with a prefix
scan: the running maximum of the last separator's position before a block.

Files are written by Spark's text sink (the line separator is the separator's
two bytes), so any store will do.  Documents are packed to files of about
``pack_bytes`` of text, or one longer document; the ids of a pack's documents go
to a file of the same name beside the tokens, in the same job.  Packs are named
after their partition and place, so a rerun over the same partitions writes the
same files.  A scan reads small files and gzipped ones whole, and others by byte
ranges, a task each (``ranges``); only counts per block meet in the prefix scan.

Defined results: null and empty texts are documents of 0 tokens; repeated rows
are counted each; tokens after the last separator are one more, unsealed
document; empty files and tables give no rows; other columns are ignored; ids
may have any type.
"""

from __future__ import annotations

import base64
import gzip
from functools import lru_cache, partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenwright.sources.ranges import RANGE_BYTES, Bytes, scan
from screenwright.storage import materialize, new_path

#: Where the vocabulary of the query lies; operators take the path as an argument.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokeniser pattern published with this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
SEPARATOR = 50256
BLOCK_TOKENS = 1 << 16
PACK_BYTES = 8 << 20


@lru_cache(maxsize=2)
def encoder(ranks: bytes):
    """The tokenizer of a vocabulary file's content."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def vocabulary(ranks: str) -> bytes:
    """The content of a vocabulary file of the driver's machine; workers get it with their tasks."""
    with open(ranks, "rb") as f:
        return f.read()


def _packs(ranks: bytes, separator: int, pack_bytes: int, batches):
    """(kind, pack, value): the tokens of each pack, without its last separator, and its ids as an Arrow stream."""
    import pyarrow as pa
    from pyspark import TaskContext

    e, mark = encoder(ranks), separator.to_bytes(2, "little")
    part, n, size = TaskContext.get().partitionId(), 0, 0
    ids, held = [], []

    def packed(kind):
        stream = pa.BufferOutputStream()
        table = pa.Table.from_arrays([pa.array(ids, type=kind)], names=["id"])
        with pa.ipc.new_stream(stream, table.schema) as out:
            out.write_table(table)
        rows = [("ids", stream.getvalue().to_pybytes()), ("tokens", mark.join(held))]
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows]), pa.array([f"p{part:06d}-{n:06d}"] * 2), pa.array([v for _, v in rows], type=pa.binary())],
            names=["kind", "pack", "value"]
        )

    kind = None
    for batch in batches:
        kind = batch.column("id").type
        for k, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            raw = text.as_py() or ""
            if held and size + len(raw) > pack_bytes:
                yield packed(kind)
                ids, held, n, size = [], [], n + 1, 0
            ids.append(k)
            held.append(np.array(e.encode_ordinary(raw), dtype="<u2").tobytes())
            size += len(raw) + 1
    if held:
        yield packed(kind)


def write_tokens(
    docs: DataFrame, path: str, ranks: str, separator: int = SEPARATOR, key: str = "doc_id", text: str = "text", pack_bytes: int = PACK_BYTES
) -> None:
    """Flat token files (gzipped) under ``path``/kind=tokens/pack=..., and the ids of each pack under ``path``/kind=ids/pack=....

    ``ranks`` is a vocabulary file of the driver's machine.
    """
    mark = separator.to_bytes(2, "little").decode("iso-8859-1")
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    made = rows.mapInArrow(partial(_packs, vocabulary(ranks), separator, pack_bytes), "kind string, pack string, value binary")
    # the sink writes the bytes of a string as they are
    out = made.select("kind", "pack", F.col("value").cast("string").alias("value")).write.partitionBy("kind", "pack")
    out.option("encoding", "ISO-8859-1").option("lineSep", mark).option("compression", "gzip").text(path)


def _unzipped(data: Bytes, start: int, end: int) -> bytes:
    raw = data.read(start, end - start)
    return gzip.decompress(raw) if start == 0 and end == data.size and raw[:2] == b"\x1f\x8b" else raw


def _blocks(separator: int, block_tokens: int, name: str, data: Bytes, start: int, end: int):
    """(file, block, n_tokens, at): the positions of the separators in each block of a range."""
    import pyarrow as pa

    ids = np.frombuffer(_unzipped(data, start, end), dtype="<u2")
    for k in range(0, len(ids), block_tokens):
        part = ids[k : k + block_tokens]
        at = np.flatnonzero(part == separator).astype(np.int32)
        held = pa.ListArray.from_arrays(pa.array([0, len(at)], type=pa.int32()), pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([(start // 2 + k) // block_tokens], type=pa.int64()), pa.array([len(part)], type=pa.int64()), held],
            names=["file", "block", "n_tokens", "at"]
        )


def scan_tokens(spark: SparkSession, path: str, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, doc, first, n_tokens, sealed): the documents of the flat files under ``path``.

    ``doc`` counts from 0 within a file and ``first`` is the position of the
    document's first token; ``sealed`` is false if no separator ends it.
    """
    whole = max(1, range_bytes // (2 * block_tokens)) * 2 * block_tokens  # ranges hold whole blocks
    rows = scan(spark, path, partial(_blocks, separator, block_tokens), "file string, block long, n_tokens long, at array<int>", whole)
    rows = materialize(rows, "token-blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("at") > 0, F.col("block") * block_tokens + F.element_at("at", -1))
    # the prefix scan sees a few numbers of each block
    sums = rows.select("file", "block", last.alias("last"), F.size("at").alias("n"))
    sums = sums.select(
        "file", "block", "last", (F.coalesce(F.max("last").over(earlier), F.lit(-1)) + 1).alias("open"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("seen"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("final")
    )
    rows = rows.join(sums, ["file", "block"])
    one = rows.select("file", "block", "open", "seen", "at", F.posexplode("at").alias("i", "p"))
    first = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("block") * block_tokens + F.get("at", F.col("i") - 1) + 1)
    sealed = one.select(
        "file", (F.col("seen") + F.col("i")).alias("doc"), first.alias("first"),
        (F.col("block") * block_tokens + F.col("p") - first).alias("n_tokens"), F.lit(True).alias("sealed")
    )
    end = F.col("block") * block_tokens + F.col("n_tokens")
    start = F.coalesce(F.col("last") + 1, F.col("open"))
    rest = rows.where(F.col("final") & (end > start)).select(
        "file", (F.col("seen") + F.size("at")).alias("doc"), start.alias("first"), (end - start).alias("n_tokens"), F.lit(False).alias("sealed")
    )
    return sealed.union(rest)


def _ids(name: str, data: Bytes, start: int, end: int):
    """(pack, doc, id): the ids of a pack's documents in their order."""
    import pyarrow as pa

    table = pa.ipc.open_stream(_unzipped(data, start, end)).read_all()
    ids = table.column("id").combine_chunks()
    pack = name.split("pack=")[-1].split("/")[0]
    yield pa.RecordBatch.from_arrays([pa.array([pack] * len(ids), type=pa.string()), pa.array(np.arange(len(ids))), ids], names=["pack", "doc", "id"])


def count_tokens(docs: DataFrame, path: str, ranks: str, separator: int = SEPARATOR, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, pack, doc, n_tokens) of every row of ``docs``, counted in the token files written under ``path``.

    Fails if a pack holds other documents than were written.
    """
    spark = docs.sparkSession
    write_tokens(docs, path, ranks, separator, key, text, **options)
    kind = docs.schema[key].dataType.simpleString()
    if docs.isEmpty():
        return spark.createDataFrame([], f"`{key}` {kind}, pack string, doc bigint, n_tokens bigint")
    found = scan_tokens(spark, f"{path}/kind=tokens", separator).withColumn("pack", F.regexp_extract("file", "pack=([^/]*)", 1))
    ids = scan(spark, f"{path}/kind=ids", _ids, f"pack string, doc long, id {kind}", 1 << 40)
    both = ids.withColumn("known", F.lit(True)).join(found.select("pack", "doc", "n_tokens", "sealed"), ["pack", "doc"], "full_outer")
    n = F.when(F.col("sealed") & F.col("known"), F.col("n_tokens")).otherwise(
        F.raise_error(F.concat(F.lit("no whole document "), F.col("doc").cast("string"), F.lit(" in pack "), F.col("pack"))).cast("bigint")
    )
    return both.select(F.col("id").alias(key), "pack", "doc", n.alias("n_tokens"))


def op6(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    return count_tokens(table(spark, sf_dir, "documents"), new_path(spark, "tokens"), RANKS)
