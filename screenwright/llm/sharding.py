"""Two-pass external shuffle into shards.

Pass 1 scatters whole records into memory-sized buckets by a seeded hash of the
record; pass 2 permutes each bucket with a seeded Fisher-Yates shuffle (Spark's
``shuffle``) and lays the buckets end to end.  Cut into equal runs, that
sequence gives shards whose row counts differ by one at most (law ``rows``).

A bucket is the only thing that a task holds at once.  Its expected size is
``bucket_bytes``: by default a 48th of an executor's memory for each of its
cores, 16 MB at least and 256 MB at most, so that the number of buckets, each a
partition of the one exchange, follows the cluster (100 TB on executors of 12 GB
a core: 400,000).  The hash covers the id, the text and every other column, so
copies of a text spread over all buckets.  Rows equal in every column, from
``REPEATED`` of them on, are counted to one row each and dealt out again by copy
number, so they spread as well; fewer share a bucket.  A bucket is sorted by that
hash before it is permuted and always sits in the same partition, so a rerun, or
a task that is repeated after an executor is lost, gives the same order.

Defined results: a null text has 1 byte (size is the bytes plus 1), and the CRC
of the empty text; repeated rows each get a slot of their own; with fewer rows
than shards some shards are empty; an empty table gives no rows; maps within
other columns take no part in the hash; columns ``shard`` and ``slot`` of the
input give way to those of the result, other columns (but ``_sw_*``) may have
any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwright.llm.tables import fingerprint, with_copies, without_maps

LEAST_BUCKET, MOST_BUCKET = 16 << 20, 256 << 20
#: Equal rows are spread from so many on.
REPEATED = 1000
#: The offsets (a row per bucket) are broadcast up to so many buckets.
BROADCAST_BUCKETS = 200_000
LAW = "rows"


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def bucket_size(spark) -> int:
    """The bytes of a bucket that suit the executors of this session."""
    conf, master = spark.sparkContext.getConf(), spark.sparkContext.master
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    said = conf.get("spark.executor.memory", "1g").lower().removesuffix("b")
    memory = int(said[:-1]) * units[said[-1]] if said[-1] in units else int(said)
    cores = master.split(",")[1] if master.startswith("local-cluster[") else conf.get("spark.executor.cores", "4")
    return max(LEAST_BUCKET, min(MOST_BUCKET, memory // int(cores) // 48))


class ExternalShuffle:
    """The two passes over ``docs``; the number of buckets follows its bytes."""

    def __init__(self, docs: DataFrame, seed: int, bucket_bytes: int | None, text: str):
        self.columns, self.seed = docs.columns, seed
        size, self.rows = docs.agg(F.sum(text_size(f"`{text}`")), F.count("*")).first()
        self.buckets = int((size or 0) // (bucket_bytes or bucket_size(docs.sparkSession))) + 1
        self.docs = with_copies(docs, REPEATED)
        self.mix = F.xxhash64(F.lit(seed), fingerprint(docs, seed), F.col("_sw_copy"))
        self.bucket = F.pmod(F.xxhash64(F.lit(seed + 1), self.mix), F.lit(self.buckets)).cast("int")

    def shuffled(self) -> DataFrame:
        """The columns of ``docs`` with ``_sw_bucket`` and ``_sw_pos`` (gapless from 0 within a bucket)."""
        own = self.columns
        row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
        order = F.struct(self.mix.alias("m"), row.alias("r"))
        scattered = self.docs.select(self.bucket.alias("_sw_bucket"), order.alias("o")).repartitionById(self.buckets, "_sw_bucket")
        if without_maps(self.docs) == self.docs.columns:
            ordered = F.array_sort(F.collect_list("o"))
        else:  # rows with maps can't be compared as a whole
            ordered = F.array_sort(F.collect_list("o"), lambda x, y: F.when(x["m"] < y["m"], -1).when(x["m"] > y["m"], 1).otherwise(0))
        held = scattered.groupBy("_sw_bucket").agg(ordered.alias("a"))
        permuted = held.sortWithinPartitions("_sw_bucket").select("_sw_bucket", F.shuffle("a", self.seed).alias("a"))
        one = permuted.select("_sw_bucket", F.posexplode("a").alias("_sw_pos", "o"))
        return one.select("_sw_bucket", "_sw_pos", *[F.col(f"o.r.c{i}").alias(c) for i, c in enumerate(own)])

    def offsets(self) -> DataFrame:
        """(_sw_bucket, _sw_offset): where each bucket starts in the whole sequence."""
        sizes = self.docs.groupBy(self.bucket.alias("_sw_bucket")).agg(F.count("*").alias("n"))
        before = Window.orderBy("_sw_bucket").rowsBetween(Window.unboundedPreceding, -1)
        found = sizes.select("_sw_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_sw_offset"))
        return F.broadcast(found) if self.buckets <= BROADCAST_BUCKETS else found


def shards(docs: DataFrame, n_shards: int, seed: int = 17, bucket_bytes: int | None = None, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in a shard).

    ``docs`` is read four times (sizes, equal rows, offsets, records); give a
    table or a materialised frame.
    """
    docs = docs.drop("shard", "slot")
    x = ExternalShuffle(docs, seed, bucket_bytes, text)
    n, at = max(x.rows, 1), F.col("_sw_offset") + F.col("_sw_pos")
    out = x.shuffled().join(x.offsets(), "_sw_bucket").withColumn("_sw_at", at)
    out = out.withColumn("_sw_shard", F.expr(f"({n_shards}L * _sw_at) div {n}L"))
    slot = F.expr(f"_sw_at - (_sw_shard * {n}L + {n_shards - 1}L) div {n_shards}L")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_sw_shard").cast("int").alias("shard"), slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int, **options) -> None:
    """Parquet folders ``shard=0`` ... under ``path``, each file in the order of its slots."""
    shards(docs, n_shards, **options).repartitionByRange(
        F.col("shard"), F.col("slot")
    ).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    rows = shards(table(spark, sf_dir, "documents"), 16)
    return rows.select(
        "doc_id", text_size().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
