"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and split into words (runs of letters and digits).  A
fixed mask picks some of the words of a window and ignores the others, so a
seed survives substitutions at the ignored positions; the masks cover each
other's blind spots: whatever words an accepted run lacks, one mask fits it.
Seeds of the benchmark, a table of bounded size, are joined with the seeds of
all documents.  Each hit fixes an alignment (document position minus item
position); along it the item's words are compared one by one, and the pair
counts if some run of ``window`` words (the whole item, if it is shorter) holds
at least ``agree`` % equal words.  An item of fewer than SPAN words, of which a
few equal words say little, is one seed as a whole and must occur word for word.

All of it is DataFrame functions.  Words are laid side by side with
``arrays_zip`` and hashed in generated code; the text itself never takes part in
the explosion.  Only hits go on, and only documents with a hit are read again.
A seed that many items share makes a hit for each of them in a document: what
is gathered is bounded by the documents times the items, of which there are few.

Defined results: null and empty texts match nothing; repeated rows and items are
reported alike (once per pair of ids); null ids are not reported, but
``decontaminated`` judges each row by its text, whatever its id; empty tables
give no rows; only the id and the text of either side are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwright.storage import bounded_broadcast, materialize

#: Positions that each mask looks at, within SPAN words. Every run of 8 to 13 words with 75 % equal words holds one of them (enumerated in the tests).
MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4), (0, 2, 3, 4, 5), (0, 1, 2, 3, 7), (0, 2, 5, 6, 7), (0, 1, 3, 5, 7))
SPAN = 8
WINDOW, AGREE = 13, 75
#: Seeds and hits are broadcast up to so many rows; beyond, the joins shuffle.
BROADCAST_SEEDS, BROADCAST_HITS = 1_000_000, 500_000


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _plain_words(text: str) -> Column:
    """As words(), with an empty word first if the text begins with a separator: cheaper for whole corpora."""
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")


def seeds(rows: DataFrame, key: str, w: str, short: tuple[int, ...] = ()) -> DataFrame:
    """(key, pos, seed) of every place in the word arrays of column ``w`` where a mask fits, or ``short`` words stand."""
    needs = [(i, m) for i, m in enumerate(MASKS)] + [(-n, tuple(range(n))) for n in short]
    at = sorted({o for _, m in needs for o in m})
    columns = [F.slice(w, o + 1, F.greatest(F.size(w) - o, F.lit(0))).alias(f"w{o}") for o in at]
    one = rows.select(key, F.posexplode(F.arrays_zip(*columns)).alias("pos", "c")).where(F.col(f"c.w{min(m[-1] for _, m in needs)}").isNotNull())
    hashes = F.array(*[F.when(F.col(f"c.w{m[-1]}").isNotNull(), F.xxhash64(F.lit(i), *[F.col(f"c.w{o}") for o in m])) for i, m in needs])
    return one.select(key, "pos", F.explode(hashes).alias("seed")).where("seed is not null")


def matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", window: int = WINDOW, agree: int = AGREE
) -> DataFrame:
    """(key, item, aligned, equal, first, last): the best alignment of each matching pair.

    ``aligned`` is the number of words of the item that lie beside a word of the
    document, ``equal`` how many of them agree, ``first`` and ``last`` the first and last of those
    in the document's words.
    """
    theirs = items.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), words(text).alias("iw")).where(F.size("iw") > 0)
    long_, few = theirs.where(F.size("iw") >= SPAN), theirs.where(F.size("iw") < SPAN)
    # at most SPAN - 1 lengths
    short = tuple(sorted(r.n for r in few.select(F.size("iw").alias("n")).distinct().collect()))
    index = seeds(long_, "item", "iw")
    for n in short:
        index = index.union(few.where(F.size("iw") == n).select("item", F.lit(0), F.xxhash64(F.lit(-n), *[F.get("iw", F.lit(k)) for k in range(n)])))
    index = materialize(index.toDF("item", "ipos", "seed").distinct(), "benchmark-seeds")
    ours = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), _plain_words(text).alias("w"))
    hits = seeds(ours, "id", "w", short).join(bounded_broadcast(index, BROADCAST_SEEDS), "seed").select(
        "id", "item", (F.col("pos") - F.col("ipos")).alias("at")
    ).distinct()
    hits = materialize(hits, "seed-hits")
    pairs = ours.join(bounded_broadcast(hits, BROADCAST_HITS), "id").join(bounded_broadcast(theirs, BROADCAST_HITS), "item")
    beside = F.transform("iw", lambda x, j: F.coalesce(F.get("w", j + F.col("at")) == x, F.lit(False)))
    pairs = pairs.select("id", "item", "at", F.size("iw").alias("n"), F.size("w").alias("words"), beside.alias("same"))
    run = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(F.lit(1), F.col("n") - run + 1)
    best = F.array_max(F.transform(starts, lambda i: F.size(F.filter(F.slice("same", i, run), lambda x: x))))
    pairs = pairs.where(best * 100 >= run * F.when(F.col("n") < SPAN, 100).otherwise(agree))
    equal = F.size(F.filter("same", lambda x: x))
    aligned = F.least(F.col("at") + F.col("n"), F.col("words")) - F.greatest("at", F.lit(0))
    first = F.col("at") + F.array_position("same", True) - 1
    last = F.col("at") + F.col("n") - F.array_position(F.reverse("same"), True)
    found = pairs.select("id", "item", equal.alias("equal"), aligned.alias("aligned"), first.cast("long").alias("first"), last.cast("long").alias("last"))
    top = found.groupBy("id", "item").agg(F.max(F.struct("equal", "aligned", "first", "last")).alias("m"))
    return top.select(
        F.col("id").alias(key), F.col("item").alias(item), *[F.col(f"m.{c}").cast("long").alias(c) for c in ("aligned", "equal", "first", "last")]
    )


def decontaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text matches no item; equal texts are looked at once a row and judged alike."""
    texts = docs.select(F.xxhash64(F.col(f"`{text}`")).alias("_sw_h"), F.col(f"`{text}`").alias("_sw_text"))
    theirs = items.select("item_id", F.col("text").alias("_sw_text"))
    bad = materialize(matches(texts, theirs, "_sw_h", text="_sw_text", **options).select("_sw_h").distinct(), "contaminated")
    return docs.join(bounded_broadcast(bad, BROADCAST_HITS), F.xxhash64(F.col(f"`{text}`")) == F.col("_sw_h"), "left_anti")


def op4(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
