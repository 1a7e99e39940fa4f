"""Duplicate search inside a corpus and against reference sets.

A row is named by (file, line); ``order`` columns say which row of a group is
the earliest, which is the one kept.  Two rows are near duplicates if a band of
their MinHash signatures (256 permutations over windows of 60 characters of the
normalised text) is equal: a band collision is a duplicate, there is no further
test unless ``verified`` is asked for.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from screenwright.functions.text import ngrams, normalize
from screenwright.operators.components import connected_components
from screenwright.storage import bounded_broadcast, materialize

#: Word windows of the reference rows are broadcast up to so many; beyond, the join shuffles.
BROADCAST_WINDOWS = 1_000_000
WIDTH, BANDS, ROWS = 60, 32, 8
_RNG = np.random.default_rng(256)
_MULTIPLY = _RNG.integers(0, 1 << 31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, 1024, dtype=np.uint32)


def check_bands(bands: int, rows: int, permutations: int) -> None:
    if bands < 1 or rows < 1 or bands * rows != permutations:
        raise ValueError(f"{bands} bands of {rows} rows don't make {permutations} permutations")


def digest(text: Column) -> Column:
    """The SHA-256 of the normalised text, null if nothing is left of it; the text is normalised once."""
    return F.nullif(F.sha2(normalize(text).cast("binary"), 256), F.lit(hashlib.sha256(b"").hexdigest()))


def exact_groups(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with ``digest``."""
    return rows.withColumn("digest", digest(text))


def digests(rows: DataFrame, keep: list[str], text: Column) -> DataFrame:
    """``keep`` and ``digest`` of each row, written once: what groups and decisions read in place of the texts."""
    return materialize(rows.select(*keep, digest(text).alias("digest")), "digests")


def decisions(rows: DataFrame, group: str, order: list[str], location: list[str]) -> DataFrame:
    """(location..., original_<location>...): every row of a group but the earliest, with that one.

    One aggregate, which combines on the map side, and one equi-join on the
    group.  ``rows`` should be narrow (``digests``); a group whose rows fill
    several partitions of the advisory size is split by adaptive execution.
    """
    first = rows.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.min(F.struct(*dict.fromkeys([*order, *location]))).alias("o"), F.count("*").alias("c")
    ).where("c > 1")
    joined = rows.join(first.select(group, "o"), group)
    same = F.lit(True)
    for c in location:
        same = same & F.col(c).eqNullSafe(F.col(f"o.{c}"))
    return joined.where(~same).select(*location, *[F.col(f"o.{c}").alias(f"original_{c}") for c in location])


def band_hashes(permutations: int, bands: int, width: int, batches):
    """Adds ``bands`` to the other columns: one 64-bit hash per band of each text's signature (null without characters)."""
    import pyarrow as pa

    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).to_pylist()
        made = []
        for first, part in _blocks(texts):
            made.append(_bands(part, permutations, bands, width))
        flat = np.concatenate(made) if made else np.zeros((0, bands), dtype=np.int64)
        empty = pa.array([not t for t in texts], type=pa.bool_())
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * bands)
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()), mask=empty) if len(texts) else pa.array([], type=pa.list_(pa.int64()))
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], lists], names=[*names, "bands"])


#: Texts are hashed in blocks of about so many characters, whose hashes stay in a core's cache.
BLOCK_CHARS = 1 << 16


def _blocks(texts: list[str | None]):
    """(index of the first text, texts) of consecutive blocks; a longer text is a block of its own."""
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > BLOCK_CHARS:
            yield first, held
            first, size, held = i, 0, []
        held.append(t)
        size += len(t)
    if held:
        yield first, held


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_CHARS + 1)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, dtype=np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS


def _windows(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every window of ``width`` characters, where each text's windows begin, the texts that have any)."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    has = np.flatnonzero(sizes)
    if not len(has):
        return np.zeros(0, dtype=np.uint64), has, has
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    forth, back = _powers(len(points) + 1)
    with np.errstate(over="ignore"):
        prefix = np.concatenate(([np.uint64(0)], np.cumsum((points + np.uint64(0x1234567)) * forth[: len(points)])))
        begin = (np.cumsum(sizes) - sizes)[has]
        span = np.minimum(sizes[has], width)
        n = sizes[has] - span + 1
        to = np.cumsum(n)
        start = np.arange(int(to[-1])) + np.repeat(begin - (to - n), n)
        h = (prefix[start + np.repeat(span, n)] - prefix[start]) * back[start]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32)), to - n, has


def _bands(texts: list[str], permutations: int, bands: int, width: int) -> np.ndarray:
    """A row of band hashes for each text; zeros for an empty one."""
    out = np.zeros((len(texts), bands), dtype=np.uint64)
    h, at, has = _windows(texts, width)
    if not len(has):
        return out.view(np.int64)
    x = h.astype(np.uint32)
    with np.errstate(over="ignore"):
        signature = np.empty((permutations, len(has)), dtype=np.uint64)
        for k in range(permutations):
            signature[k] = np.minimum.reduceat(x * _MULTIPLY[k] + _ADD[k], at)
        made = np.zeros((bands, len(has)), dtype=np.uint64)
        for row in signature.reshape(bands, -1, len(has)).transpose(1, 0, 2):
            made = (made ^ row) * np.uint64(0xFF51AFD7ED558CCD)
            made ^= made >> np.uint64(33)
    out[has] = made.T
    return out.view(np.int64)


def distinct_windows(rows: DataFrame, id: str, text: Column, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles): how many different windows of ``width`` characters the normalised text of each row has."""
    held = rows.select(F.col(id).alias("id"), F.coalesce(normalize(text), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts = [np.zeros(0, dtype=np.int64)]
            for _, part in _blocks(batch.column("text").to_pylist()):
                h, at, has = _windows(part, width)
                owner = np.repeat(has, np.diff(np.append(at, len(h))))
                order = np.lexsort((h, owner))
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
                counts.append(np.bincount(owner[order][first], minlength=len(part)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate(counts), type=pa.int64())], names=["id", "n_shingles"])

    kind = held.schema["id"].dataType.simpleString()
    return held.mapInArrow(run, f"id {kind}, n_shingles long").withColumnRenamed("id", id)


def signed(rows: DataFrame, keep: list[str], text: Column, bands: int, rows_each: int, width: int) -> DataFrame:
    """``keep``, ``digest`` and ``bands`` (array<long>, null without characters) of each row, in one pass over the texts."""
    check_bands(bands, rows_each, bands * rows_each)
    norm = rows.select(*keep, normalize(text).alias("text"))
    held = norm.select(*keep, F.nullif(F.sha2(F.col("text").cast("binary"), 256), F.lit(hashlib.sha256(b"").hexdigest())).alias("digest"), "text")
    out = StructType([f for f in held.schema.fields if f.name != "text"]).add("bands", ArrayType(LongType()))
    return held.mapInArrow(partial(band_hashes, bands * rows_each, bands, width), out)


def banded(rows: DataFrame, id: str, text: Column, bands: int = BANDS, rows_each: int = ROWS, width: int = WIDTH) -> DataFrame:
    """(id, band, hash): a row per band of each hashable text."""
    made = signed(rows.select(F.col(id).alias("id"), text.alias("_t")), ["id"], F.col("_t"), bands, rows_each, width)
    return made.where("bands is not null").select("id", F.posexplode("bands").alias("band", "hash"))


def star_edges(bands: DataFrame) -> DataFrame:
    """(a, b): each id of a bucket with the bucket's smallest id; the components are those of all pairs."""
    least = bands.groupBy("band", "hash").agg(F.min("id").alias("b"), F.count("*").alias("c")).where("c > 1").select("band", "hash", "b")
    return bands.join(least, ["band", "hash"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def copies_of(made: DataFrame) -> DataFrame:
    """(digest, rep, bands): the smallest id of each normalised text; exact copies enter the bands once."""
    return made.where("digest is not null").groupBy("digest").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))


def near_duplicates(rows: DataFrame, id: str, text: Column, bands: int = BANDS, rows_each: int = ROWS, width: int = WIDTH) -> DataFrame:
    """(id, duplicate_of): every row that is removed, with the earliest row of its component."""
    made = materialize(signed(rows.select(F.col(id).alias("id"), text.alias("_t")), ["id"], F.col("_t"), bands, rows_each, width), "signed")
    reps = materialize(copies_of(made), "copies")
    edges = star_edges(materialize(reps.select(F.col("rep").alias("id"), F.posexplode("bands").alias("band", "hash")), "bands"))
    of = connected_components(edges).toDF("rep", "component")
    named = reps.select("digest", "rep").join(of, "rep", "left").select("digest", F.coalesce("component", "rep").alias("duplicate_of"))
    return made.select("id", "digest").join(named, "digest").select("id", "duplicate_of").where("id <> duplicate_of")


def cross_pairs(
    candidates: DataFrame, reference: DataFrame, id: str, ref_id: str, text: Column, ref_text: Column, bands: int = BANDS, rows_each: int = ROWS,
    width: int = WIDTH
) -> DataFrame:
    """(id, ref_id): candidates that share a band with a reference row; candidates aren't compared with each other.

    Exact copies of either side meet as one row and are named again at the end.
    """
    sides = []
    for rows, key, t in ((candidates, id, text), (reference, ref_id, ref_text)):
        made = materialize(signed(rows.select(F.col(key).alias("id"), t.alias("_t")), ["id"], F.col("_t"), bands, rows_each, width), "signed")
        sides.append((made.where("digest is not null").select("id", "digest"), copies_of(made).select("digest", F.posexplode("bands").alias("band", "hash"))))
    (ours, a), (theirs, b) = sides
    met = materialize(a.join(b.withColumnRenamed("digest", "ref_digest"), ["band", "hash"]).select("digest", "ref_digest").distinct(), "met")
    return met.join(ours.withColumnRenamed("id", id), "digest").join(
        theirs.select(F.col("id").alias(ref_id), F.col("digest").alias("ref_digest")), "ref_digest"
    ).select(id, ref_id)


def word_windows(rows: DataFrame, keys: list[str], text: Column, widths: list[int], short: bool = False) -> DataFrame:
    """(keys..., n, h): the length and the hash of every window of ``widths`` words of the normalised texts.

    With ``short`` a text of fewer words than the one width is one window.
    """
    held = rows.select(*keys, normalize(text).alias("_t")).where(F.length("_t") > 0).select(*keys, F.split("_t", " ").alias("_w"))
    size, top = F.size("_w"), max(widths)
    beside = F.arrays_zip(*[F.slice("_w", k + 1, F.greatest(size - k, F.lit(0))).alias(f"w{k}") for k in range(top)])
    laid = held.select(*keys, size.alias("_n"), F.posexplode(beside).alias("_p", "c"))

    def window(n: int, met: Column) -> Column:
        return F.when(met, F.struct(F.lit(n).alias("n"), F.xxhash64(*[F.col(f"c.w{k}") for k in range(n)]).alias("h")))

    made = [window(n, F.col("_p") + n <= F.col("_n")) for n in widths]
    if short:
        made += [window(n, (F.col("_n") == n) & (F.col("_p") == 0)) for n in range(1, top)]
    if len(made) == 1:
        return laid.where(F.col("_p") + top <= F.col("_n")).select(*keys, F.lit(top).alias("n"), F.xxhash64(*[F.col(f"c.w{k}") for k in range(top)]).alias("h"))
    return laid.select(*keys, F.explode(F.array(*made)).alias("x")).where("x is not null").select(*keys, "x.n", "x.h")


def containing(candidates: DataFrame, reference: DataFrame, keys: list[str], ref_id: str, text: Column, ref_text: Column, width: int = 8) -> DataFrame:
    """(keys..., ref_id): candidates that share any window of ``width`` normalised words with a reference row, once a pair.

    A reference row of fewer words is one window as a whole; one without words matches nothing.
    """
    index = materialize(word_windows(reference, [ref_id], ref_text, [width], short=True).distinct(), "reference-windows")
    widths = sorted(r.n for r in index.select("n").distinct().collect()) or [width]
    ours = word_windows(candidates, keys, text, widths)
    return ours.join(bounded_broadcast(index, BROADCAST_WINDOWS), ["n", "h"]).select(*keys, ref_id).distinct()


def earliest(pairs: DataFrame, candidate: list[str], reference: list[str]) -> DataFrame:
    """One decision per candidate: its earliest reference match."""
    return pairs.groupBy(*candidate).agg(F.min(F.struct(*reference)).alias("m")).select(*candidate, *[F.col(f"m.{c}").alias(c) for c in reference])


def contamination(pairs: DataFrame, hashed: DataFrame, group: str, item: str, candidate: str) -> DataFrame:
    """Per reference group: rows hashed, distinct contaminated items, percent, distinct matched candidates; groups without a match stay."""
    met = pairs.groupBy(group).agg(F.countDistinct(item).alias("contaminated"), F.countDistinct(candidate).alias("matched_rows"))
    base = hashed.groupBy(group).agg(F.count("*").alias("hashed"))
    out = base.join(met, group, "left").select(
        group, "hashed", F.coalesce("contaminated", F.lit(0)).alias("contaminated"), F.coalesce("matched_rows", F.lit(0)).alias("matched_rows")
    )
    return out.withColumn("percent", F.round(100.0 * F.col("contaminated") / F.col("hashed"), 4))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, width: int = WIDTH) -> DataFrame:
    """Opt-in test of pairs (a, b) by the Jaccard similarity of their character windows; ``texts`` has (id, text)."""
    t = texts.select("id", "text")
    both = pairs.join(t.toDF("a", "ta"), "a").join(t.toDF("b", "tb"), "b")

    def keep(batches):
        import pyarrow as pa

        grams = lambda x: {x[i : i + width] for i in range(max(1, len(x) - width + 1))} if x else set()
        for batch in batches:
            score = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                x, y = grams(x), grams(y)
                score.append(len(x & y) / len(x | y) if x | y else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(score)], names=["a", "b", "similarity"])

    return both.select("a", "b", "ta", "tb").mapInArrow(keep, "a long, b long, similarity double").where(F.col("similarity") >= similarity)


def glob_rule(source: Column, reference: Column, rules: list[str]) -> Column:
    """Whether a pair meets one of the rules ``SOURCE_GLOB::REFERENCE_GLOB`` (case-sensitive; * crosses /)."""
    import fnmatch

    out = F.lit(False)
    for rule in rules:
        left, sep, right = rule.partition("::")
        if not (left and sep and right):
            raise ValueError(f"not SOURCE_GLOB::REFERENCE_GLOB: {rule!r}")
        out = out | (source.rlike(fnmatch.translate(left)) & reference.rlike(fnmatch.translate(right)))
    return out


def priority_order(dataset: Column, order: list[str], protected: list[str] = ()) -> Column:
    """A rank that leads the row order: protected sets first, then those listed, then the rest."""
    ranks = {d: i for i, d in enumerate([*protected, *[d for d in order if d not in protected]])}
    out = F.lit(len(ranks))
    for d, i in ranks.items():
        out = F.when(dataset == d, F.lit(i)).otherwise(out)
    return out


def canonical(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``is_canonical``: the earliest of each group (ties kept by ``order`` being unique)."""
    w = Window.partitionBy(group)
    return rows.withColumn("is_canonical", F.struct(*order) == F.min(F.struct(*order)).over(w))


def md5_bands(rows: DataFrame, id: str, text: Column, bands: int, rows_each: int, width: int = WIDTH) -> DataFrame:
    """As ``banded`` with an MD5 hash family, all in the JVM: for few permutations and short texts, and for comparison with other engines."""
    # a lambda evaluates what it captures once per element, so the normalised texts and the windows are written first
    norm = materialize(rows.select(F.col(id).alias("id"), normalize(text).alias("t")).where(F.length("t") > 0), "normalised")
    held = materialize(norm.select("id", F.array_distinct(ngrams(F.col("t"), width)).alias("g")), "ngrams")

    def least(k: int) -> Column:
        return F.array_min(F.transform("g", lambda x: F.md5(F.concat(F.lit(f"{k}:"), x).cast("binary"))))

    keys = [F.concat_ws("|", *[least(b * rows_each + r) for r in range(rows_each)]) for b in range(bands)]
    return held.select("id", F.posexplode(F.array(*keys)).alias("band", "hash"))


def selected(matches: DataFrame, rules: list[str]) -> DataFrame:
    """The matches (source_file, source_line, reference_file, reference_line) that a rule wants; no rule, no such match, or a place that is none stops the run."""
    from screenwright.operators.runs import proper_path

    if not rules:
        raise ValueError("at least one rule is needed")
    fine = proper_path(F.col("source_file")) & proper_path(F.col("reference_file")) & (F.col("source_line") >= 1) & (F.col("reference_line") >= 1)
    checked = matches.withColumn("source_file", F.when(fine, F.col("source_file")).otherwise(F.raise_error(F.lit("a match has no proper place"))))
    out = materialize(checked.where(glob_rule(F.col("source_file"), F.col("reference_file"), rules)), "selected")
    if out.isEmpty():
        raise ValueError("no match satisfies the rules")
    return out


def with_records(matches: DataFrame, rows: DataFrame, location: list[str], text: str) -> DataFrame:
    """``matches`` with the texts of both of their rows (``text``, ``original_text``); a place without a row stops the run."""
    mine = rows.select(*location, F.col(text).alias("text"), F.lit(True).alias("_m"))
    other = rows.select(*[F.col(c).alias(f"original_{c}") for c in location], F.col(text).alias("original_text"), F.lit(True).alias("_o"))
    both = matches.join(mine, location, "left").join(other, [f"original_{c}" for c in location], "left")
    found = F.col("_m").isNotNull() & F.col("_o").isNotNull()
    return both.withColumn("text", F.when(found, F.col("text")).otherwise(F.raise_error(F.lit("a match has no record")))).drop("_m", "_o")
