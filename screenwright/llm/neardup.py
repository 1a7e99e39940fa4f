"""Near-duplicate documents by a signature-coordinate inverted join.

1.  A kernel reduces each text to its set of distinct word shingles, a MinHash
    signature, and a 128-bit fingerprint of the set.  Texts with equal sets form
    one *class* with a number of its own, so a group of copies, however large,
    goes on as one row.
2.  A coordinate of the signature is a run of ``rows`` minima taken as one value
    (a single minimum is shared by too many unlike texts to be worth a posting;
    ``rows_each=1`` gives plain coordinates).  Every class is posted under each
    of its ``coords`` (coordinate, value) pairs.  Values held by one class only
    can't collide and are dropped.
3.  Two classes match if at least ``match`` coordinates collide.  Ordered by
    (frequency, value), such a pair shares one of its first
    ``coords - match + 1`` postings (prefix filter), so only these rare ones
    are merged; the long lists behind the prefix are skipped and looked up in
    the signatures of the candidate pairs (as MergeSkip does).
4.  Within a posting list each class first meets the list's leader; confirmed
    links are followed to groups.  In lists that still hold several groups,
    classes of which over a fifth of the shingles occur nowhere else in such
    lists can't be linked at all and leave.  Those that stay meet the classes of
    other groups.  A large group and all classes that share a list with it are
    dealt to blocks of bounded size; a kernel counts common shingles by merging
    and reports only links that join two groups of its blocks.  The others, in
    small groups, meet pair by pair, each pair in one list only.  So a large
    group never becomes rows of pairs.  Only pairs of one group, whose
    connection is known, are skipped: no component is lost.
5.  A match is confirmed on the full shingle sets (64-bit hashes).

A pair at the similarity threshold 0.8 is missed with a probability of about
1e-6 (fewer than 4 of 32 coordinates of 3 minima).

Defined results: texts without words (null, empty, blank) have 0 shingles and
are linked with nothing; repeated rows are copies; an id with several texts is
a document for each text; a null id is kept and never names a component; an
empty table gives no rows; only the id and the text of the input are used, so
other columns may have any names and types.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwright.llm.tables import without_maps
from screenwright.llm.words import Block, map_texts, mix, windows
from screenwright.operators.components import connected_components
from screenwright.storage import bounded_broadcast, materialize

_RNG = np.random.default_rng(20240607)
_MULTIPLY = _RNG.integers(0, 1 << 31, 256, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, 256, dtype=np.uint32)
#: Ids are broadcast up to so many rows (8 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000
#: Components from this size on are met in blocks of about so many shingles.
LARGE, BLOCK_SHINGLES = 8, 1 << 16
#: A posting list is cut into parts of about so many rows, each of which meets what the list has to meet.
LIST_ROWS = 512


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    b = Block(texts)
    h = b.hash_spans(b.start, b.end, lower=True)
    wh, lo, hi = windows(h, b.lo, b.hi, width)
    out = []
    for i in range(len(texts)):
        n = b.hi[i] - b.lo[i]
        if n >= width or n == 0:
            out.append(np.unique(wh[lo[i] : hi[i]]))
        else:  # fewer words than a shingle has: the whole sequence
            whole = windows(h, b.lo[i : i + 1], b.hi[i : i + 1], int(n))[0]
            out.append(mix(whole + np.uint64(n)))
    return out


def sketches(width: int, minima: int, texts: list[bytes]) -> list:
    """(set size, two fingerprint halves, signature) of each text; without shingles 0, 0, 0, null."""
    sets = shingle_sets(texts, width)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    has = np.flatnonzero(sizes)
    first, second = np.zeros((2, len(texts)), dtype=np.int64)
    signature: list[bytes | None] = [None] * len(texts)
    if len(has):
        x = np.concatenate([sets[i] for i in has])
        at = np.concatenate(([0], np.cumsum(sizes[has])[:-1]))
        with np.errstate(over="ignore"):
            first[has] = np.add.reduceat(mix(x ^ np.uint64(0xA5A5_1234_5678_9ABC)), at).view(np.int64)
            second[has] = np.add.reduceat(mix(x + np.uint64(0x0F1E_2D3C_4B5A_6978)), at).view(np.int64)
            small = (x >> np.uint64(32)).astype(np.uint32)
            rows = np.empty((minima, len(has)), dtype=np.uint32)
            for k in range(minima):
                rows[k] = np.minimum.reduceat(small * _MULTIPLY[k] + _ADD[k], at)
        for i, row in zip(has, np.ascontiguousarray(rows.T), strict=True):
            signature[i] = row.tobytes()
    return [sizes, first, second, signature]


def in_parts(rows: DataFrame, small: DataFrame, size: str = "c") -> DataFrame:
    """``rows`` (key, rep, ...) joined with ``small`` (key, size, ...), in which ``size`` is the number of rows of the key.

    The rows of a long list are dealt to parts by their class, and what stands in
    ``small`` is repeated for each part, so that no key is one task.  Lists longer
    than LIST_ROWS are few (rows / LIST_ROWS); their sizes are broadcast.
    """
    long_ = small.where(F.col(size) > LIST_ROWS).select("key", F.expr(f"({size} div {LIST_ROWS}) + 1").cast("int").alias("parts")).distinct()
    dealt = rows.join(bounded_broadcast(long_, BROADCAST_IDS), "key", "left")
    dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("rep"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    every = small.withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.when(F.col(size) > LIST_ROWS, F.expr(f"{size} div {LIST_ROWS}")).otherwise(0).cast("int")))
    ).drop(size)
    return dealt.join(every, ["key", "part"]).drop("part")


def _postings(coords: int, rows: int, batches):
    import pyarrow as pa

    salt = mix(np.arange(1, coords + 1, dtype=np.uint64))
    for batch in batches:
        sigs = batch.column("sig").to_pylist()
        for k in range(0, len(sigs), 4096):
            minima = np.frombuffer(b"".join(sigs[k : k + 4096]), dtype=np.uint32).reshape(-1, coords, rows)
            key = np.broadcast_to(salt, minima.shape[:2])
            for j in range(rows):
                key = mix(key + minima[:, :, j])
            rep = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False)[k : k + 4096], coords)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).ravel()), pa.array(rep, type=pa.int64())], names=["key", "rep"])


def _colliding(coords: int, rows: int, match: int, batches):
    """The pairs (a, b) of which at least ``match`` coordinates collide."""
    import pyarrow as pa

    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, coords, rows) for c in ("ga", "gb"))
        keep = pa.array((a == b).all(axis=2).sum(axis=1) >= match)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def _spread(batches):
    """(h, rep) for each shingle of each set."""
    import pyarrow as pa

    for batch in batches:
        for rep, v in zip(batch.column("rep").to_pylist(), batch.column("shingles"), strict=True):
            h = np.frombuffer(v.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), rep, dtype=np.int64))], names=["h", "rep"])


def _confirmed(percent: int, batches):
    """The pairs (a, b) whose full sets have at least ``percent`` % in common."""
    import pyarrow as pa

    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        keep = pa.array(keep, type=pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def _joining(percent: int, batches):
    """(a, b): links between the classes of two blocks, as many as join their groups; the other links would add nothing."""
    import pyarrow as pa

    for batch in batches:
        out: list[tuple[int, int]] = []
        for mine, theirs in zip(batch.column("mine"), batch.column("theirs"), strict=True):
            mine, theirs = mine.as_py(), theirs.as_py()
            root = {r["comp"]: r["comp"] for r in (*mine, *theirs)}

            def find(x, root=root):
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            sets = [np.frombuffer(r["s"], dtype=np.uint64) for r in theirs]
            sizes = np.array([len(x) for x in sets])
            value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(value, kind="stable")
            value, owner = value[order], owner[order]
            for r in mine:
                x = np.frombuffer(r["s"], dtype=np.uint64)
                lo, hi = np.searchsorted(value, x, "left"), np.searchsorted(value, x, "right")
                n = hi - lo
                to = np.cumsum(n)
                both = np.bincount(owner[np.arange(to[-1]) + np.repeat(lo - to + n, n)], minlength=len(sets))
                for k in np.flatnonzero(100 * both >= percent * (len(x) + sizes - both)):
                    p, q = find(r["comp"]), find(theirs[k]["comp"])
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        out.append((r["rep"], theirs[k]["rep"]))
        columns = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["a", "b"])


class _Links:
    """Candidate search and confirmation over the classes of one corpus."""

    def __init__(self, docs: DataFrame, classes: DataFrame, key: str, text: str, width: int, percent: int, shape: tuple[int, int, int]):
        self.percent, self.classes, (self.coords, self.rows, self.match) = percent, classes, shape
        # counted and joined apart, so that the rows of a hot value can be split
        posts = classes.select("rep", "sig").mapInArrow(partial(_postings, self.coords, self.rows), "key long, rep long")
        shared = posts.join(posts.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "key")
        held = shared.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("k")).where(F.size("k") >= self.match)
        self.keys = materialize(held.select("rep", F.col("k.key").alias("every")), "keys")
        prefix = F.slice("every", F.lit(1), F.size("every") - (self.match - 1))
        self.lists = materialize(self.keys.select("rep", F.explode(prefix).alias("key")).join(classes.select("rep", "n"), "rep"), "postings")
        wanted = materialize(classes.select("rep", "id", "h").join(self.lists.select("rep").distinct(), "rep"), "posted")
        mine = docs.select(
            F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text")
        ).join(bounded_broadcast(wanted, BROADCAST_IDS), ["id", "h"])
        sets = map_texts(mine, ["rep"], "text", lambda texts: [[s.tobytes() for s in shingle_sets(texts, width)]], "shingles binary")
        self.sets = materialize(sets.dropDuplicates(["rep"]), "shingles")

    def _fits(self, n: str, m: str):
        """Sets of such sizes can reach the similarity."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def confirm(self, pairs: DataFrame) -> DataFrame:
        sig = self.classes.select("rep", "sig")
        colliding = partial(_colliding, self.coords, self.rows, self.match)
        near = pairs.join(sig.toDF("a", "ga"), "a").join(sig.toDF("b", "gb"), "b").mapInArrow(colliding, "a long, b long")
        full = near.join(self.sets.toDF("a", "sa"), "a").join(self.sets.toDF("b", "sb"), "b")
        return materialize(full.select("a", "b", "sa", "sb").mapInArrow(partial(_confirmed, self.percent), "a long, b long"), "links")

    def to_leaders(self, rows: DataFrame) -> DataFrame:
        """Each class with that leader that it meets most often in its lists; a hash ranks leaders."""
        lead = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "n")).alias("l"), F.count("*").alias("c"))
        lead = materialize(lead.where("c > 1").select("key", "c", F.col("l.rep").alias("b"), F.col("l.n").alias("m")), "leaders")
        met = in_parts(rows, lead).where((F.col("rep") != F.col("b")) & self._fits("n", "m")).groupBy("rep", "b").agg(F.count("*").alias("c"))
        return met.groupBy(F.col("rep").alias("a")).agg(F.max(F.struct("c", (-F.col("b")).alias("b"))).alias("t")).select("a", (-F.col("t.b")).alias("b"))

    def open_lists(self, rows: DataFrame) -> DataFrame:
        """The rows of lists that hold several components."""
        open_ = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
        return rows.join(open_, "key", "left_semi")

    def moved(self, rows: DataFrame, moves: DataFrame) -> DataFrame:
        """``rows`` with groups joined as ``moves`` (comp, to; no cycles) says, closed lists left out.

        Moves are followed up to four steps.  Groups that could be joined further
        stay apart, which costs work but no link.
        """
        for _ in range(2):
            moves = moves.join(moves.toDF("to", "further"), "to", "left").select("comp", F.coalesce("further", "to").alias("to"))
        rows = rows.join(moves, "comp", "left").select("key", "rep", "n", F.coalesce("to", "comp").alias("comp"))
        return materialize(self.open_lists(rows), "open-lists")

    def alive(self, rows: DataFrame) -> DataFrame:
        """The rows of classes that share enough of their shingles with others of these lists to be linked."""
        reps = rows.select("rep", "n").distinct()
        each = self.sets.join(reps, "rep", "left_semi").mapInArrow(_spread, "h long, rep long")
        common = each.join(each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1").select("h"), "h")
        enough = common.groupBy("rep").agg(F.count("*").alias("s")).join(reps, "rep").where(F.col("s") * 100 >= F.col("n") * self.percent).select("rep")
        return materialize(self.open_lists(rows.join(enough, "rep", "left_semi")), "alive")

    def across(self, rows: DataFrame, visits: DataFrame) -> DataFrame:
        """All pairs of other, small groups that share a list and enough coordinates, each from its first common list.

        Pairs that visit the same large group have met there.  The largest group
        of a list stands on the right only.
        """
        main = rows.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("c"))
        main = materialize(main.select("key", "c", F.col("m.comp").alias("main"), F.expr(f"cast(c div {LIST_ROWS} as int)").alias("more")), "lists")
        rows = in_parts(rows.join(rows.groupBy("rep").agg(F.collect_set("key").alias("keys")), "rep").join(self.keys, "rep"), main)
        rows = rows.join(
            visits.groupBy("rep").agg(F.collect_set("to").alias("to")), "rep", "left"
        ).withColumn("to", F.coalesce("to", F.array().cast("array<bigint>")))
        # what stands on the right is repeated for each part of a long list, what stands on the left is dealt to them
        left = rows.where("comp <> main").select(
            "key", F.pmod(F.xxhash64("rep"), F.col("more") + 1).cast("int").alias("part"), F.col("rep").alias("a"), "n", F.col("comp").alias("ca"),
            F.col("keys").alias("ka"), F.col("every").alias("ea"), F.col("to").alias("ta")
        )
        right = rows.select(
            "key", F.explode(F.sequence(F.lit(0), F.col("more"))).alias("part"), F.col("rep").alias("b"), F.col("n").alias("m"),
            F.col("comp").alias("cb"), F.col("keys").alias("kb"), F.col("every").alias("eb"), F.col("to").alias("tb"),
            (F.col("comp") == F.col("main")).alias("own")
        )
        enough = F.size(F.array_intersect("ea", "eb")) >= self.match
        first = F.array_min(F.array_intersect("ka", "kb")) == left["key"]
        apart = (F.col("ca") != F.col("cb")) & (F.col("own") | (F.col("a") > F.col("b"))) & self._fits("n", "m") & ~F.arrays_overlap("ta", "tb")
        return left.join(right, (left["key"] == right["key"]) & (left["part"] == right["part"]) & apart & enough & first).select("a", "b").distinct()

    def _blocks(self, rows: DataFrame, name: str) -> DataFrame:
        """(to, block, blocks, name): the sets of ``rows`` (to, rep, comp, n), dealt to blocks of about BLOCK_SHINGLES shingles."""
        deal = rows.groupBy("to").agg(F.expr(f"(sum(n) div {BLOCK_SHINGLES}) + 1").alias("blocks"))
        dealt = rows.join(deal, "to").select("to", "rep", "comp", "blocks", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"))
        return dealt.join(self.sets, "rep").groupBy("to", "block", "blocks").agg(
            F.collect_list(F.struct("rep", "comp", F.col("shingles").alias("s"))).alias(name)
        )

    def visits(self, rows: DataFrame, sizes: DataFrame) -> DataFrame:
        """(to, rep, comp, n): the classes of smaller groups that share a list with a large group ``to``."""
        there = rows.join(sizes.where(F.col("size") >= LARGE), "comp").select("key", F.col("comp").alias("to"), F.col("size").alias("to_size")).distinct()
        smaller = F.struct("size", "comp") < F.struct("to_size", "to")
        return materialize(rows.join(sizes, "comp").join(there, "key").where(smaller).select("to", "rep", "comp", "n").distinct(), "visits")

    def to_large(self, rows: DataFrame, sizes: DataFrame, visits: DataFrame) -> DataFrame:
        """Links that join the visitors of each large group with it and with each other."""
        members = rows.join(sizes.where(F.col("size") >= LARGE), "comp").select(F.col("comp").alias("to"), "rep", "comp", "n").distinct()
        # each pair of blocks is a key of its own
        theirs = self._blocks(members.union(visits), "theirs")
        many = theirs.select("to", "blocks").distinct()
        mine = self._blocks(visits, "mine").drop("block", "blocks").join(many, "to")
        mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        met = mine.join(theirs.drop("blocks"), ["to", "block"])
        return materialize(met.select("mine", "theirs").mapInArrow(partial(_joining, self.percent), "a long, b long"), "links")

    def all(self) -> DataFrame:
        """Links (a, b) between classes that have the components of all links."""
        links = self.confirm(self.to_leaders(self.lists))
        rows = self.alive(self.moved(self.lists.withColumn("comp", F.col("rep")), links.toDF("comp", "to")))
        sizes = materialize(rows.select("rep", "comp").distinct().groupBy("comp").agg(F.count("*").alias("size")), "sizes")
        visits = self.visits(rows, sizes)
        links = links.union(self.to_large(rows, sizes, visits))
        small = self.open_lists(rows.join(sizes.where(F.col("size") >= LARGE), "comp", "left_anti"))
        return links.union(self.confirm(self.across(small, visits)))


def labelled(docs: DataFrame, key: str, text: str, width: int, percent: int, shape: tuple[int, int, int]) -> DataFrame:
    """(id, h, n, first): a row for each of ``docs``, with the hash of its text, the size of its set and the first (id, h) of its component.

    ``first`` is null for texts without words and for classes without an id.
    """
    coords, rows_each, _ = shape
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    rows = materialize(map_texts(rows, ["id", "h"], "text", partial(sketches, width, coords * rows_each), "n long, f1 long, f2 long, sig binary"), "sketches")
    classes = rows.where("n > 0 and id is not null").groupBy("f1", "f2", "n").agg(F.min(F.struct("id", "h")).alias("o"), F.max("sig").alias("sig"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("rep"), "o.id", "o.h", "f1", "f2", "n", "sig"), "classes")
    of = connected_components(_Links(docs, classes, key, text, width, percent, shape).all()).toDF("rep", "comp")
    linked = materialize(classes.select("rep", F.struct("id", "h").alias("o")).join(of, "rep"), "linked")
    first = linked.groupBy("comp").agg(F.min("o").alias("first"))
    named = classes.join(linked.join(first, "comp").select("rep", "first"), "rep", "left")
    named = named.select("f1", "f2", "n", F.coalesce("first", F.struct("id", "h")).alias("first"))
    return rows.select("id", "h", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left").select("id", "h", "n", "first")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, coords: int = 32, rows_each: int = 3, match: int = 4
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``.

    Rows are linked if their sets of ``width``-word shingles have a Jaccard
    similarity of at least ``percent`` %; the component is named by its smallest
    id, and the row of that id is kept.
    """
    out = labelled(docs, key, text, width, percent, (coords, rows_each, match))
    component = F.coalesce("first.id", "id")
    return out.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept")
    )


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, coords: int = 32, rows_each: int = 3, match: int = 4
) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest (id, text hash); rows with a null id or without words stay.

    Of rows equal in id and text one stays, that with the smallest hash of the
    other columns (maps take no part in it).
    """
    rows = labelled(docs, key, text, width, percent, (coords, rows_each, match))
    rows = materialize(rows.where("n > 0 and id is not null").select("id", "h", (F.struct("id", "h") == F.col("first")).alias("stays")), "stays")
    gone = materialize(rows.where("not stays").select(F.col("id").alias("_sw_id"), F.col("h").alias("_sw_h")).distinct(), "near-copies")
    twice = materialize(
        rows.where("stays").groupBy("id", "h").agg(F.count("*").alias("c")).where("c > 1").select(
            F.col("id").alias("_sw_id"), F.col("h").alias("_sw_h")
        ),
        "repeated-rows"
    )
    own = [F.col(f"`{c}`") for c in docs.columns]
    here = (F.col(f"`{key}`").cast("long") == F.col("_sw_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_sw_h"))
    left = docs.join(bounded_broadcast(gone, BROADCAST_IDS), here, "left_anti")
    if twice.isEmpty():
        return left
    again = bounded_broadcast(twice, BROADCAST_IDS)
    one = left.join(again, here).groupBy("_sw_id", "_sw_h").agg(
        F.min_by(F.struct(*own), F.xxhash64(*[F.col(f"`{c}`") for c in without_maps(docs)])).alias("_sw_row")
    )
    return left.join(again, here, "left_anti").unionByName(one.select(*[F.col(f"_sw_row.`{c}`") for c in docs.columns]))


def op7(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
