"""Toxicity with noisy-channel deobfuscation.

1.  A character trigram model is counted over every text of the corpus.
2.  Tokens that look disguised (leetspeak, letters set apart, repeated letters)
    become a lattice: each character may stand for itself, for the letters that
    it resembles, or for nothing (separators, repeats), at a cost; a space
    between letters set apart may also be a space.  Viterbi decoding under the
    character model, over every state of the lattice, restores the likeliest
    spelling; other tokens have one path and are taken as they are.
3.  A lexicon of words and word beginnings is learned from labelled rows: a
    greedy cover of the toxic texts by features of high precision.  A score is
    the noisy-or of the features found in the restored text.

Training is bounded by ``train_rows`` labelled rows (those with the smallest
hash of the id; 8,000 unless said otherwise); everything else covers all rows.
Features are counted on the cluster.  The driver gets a signature of 64 minima
for each toxic training row, the ``MAX_FEATURES`` most frequent features of the
toxic rows, and the groups of those that are precise enough; never a text.
Rows whose crc32 of the id modulo 3 is 1 are held out: their labels are never
read.  A score depends on the text alone.

Defined results: a null, empty or wordless text has the base score; repeated
rows get equal scores; an id with several labels counts as toxic if one says
so; null labels are no labels; without labels every score is 0.5; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwright.llm.words import map_texts, mix
from screenwright.storage import materialize

#: The alphabet of the character model; 0 stands for all else.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâäãåæçèéêëìíîïñòóôöõœùúûüÿ"
#: Letters that a character can stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
SEPARATORS = " .-_*'~"
COST_LEET, COST_ANY, COST_REPEAT, COST_SEPARATOR, COST_DROP = 1.0, 2.0, 0.5, 0.2, 12.0
WIDTH = 64
THRESHOLD = 0.7
PREFIXES = (3, 4, 5, 6, 7)
TRAIN_ROWS = 8000
#: Clean rows that a feature is taken to have besides those seen: rare features need company.
DOUBT = 8
#: Features of the toxic training rows that are looked at, the most frequent first: a bound of the fit.
MAX_FEATURES = 100_000
#: Minima of a training row's signature, and how they are cut into bands.
MINIMA, BAND = 64, 4

_CODE = np.zeros(0x250, dtype=np.int32)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i + 1
_AT = {c: i + 1 for i, c in enumerate(LETTERS)}
_WORD = re.compile(r"[^\W\d_]+")
_LEET_CLASS = re.escape("".join(LEET))
#: Within a token: a look-alike beside a letter, a letter three times in a row, or letters set apart; to these come unusual doubles.
_DISGUISED = rf"[^\W\d_][{_LEET_CLASS}]|[{_LEET_CLASS}][^\W\d_]|([^\W\d_])\1\1|[^\W\d_][._~'-][^\W\d_]"
#: A letter's double is unusual if it is less likely than this after any letter.
UNUSUAL = 0.02
#: At least two single characters with a space between.
_SPACED = re.compile(rf"(?<!\S)[\w{_LEET_CLASS}](?: [\w{_LEET_CLASS}])+(?![^\s.,;:!?])")
#: Marks around a token; an exclamation mark in front may be a letter.
_BEFORE, _AFTER = ".,;:?\"'()[]{}«»“”‘’…-", ".,;:?!\"'()[]{}«»“”‘’…-"
#: A worker remembers the words of so many tokens.
REMEMBERED = 50_000


def trigram_counts(batches):
    """(code, n) of the character trigrams of a task's texts; words are padded on both sides."""
    import pyarrow as pa

    total = np.zeros(WIDTH**3, dtype=np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            text = "\n\n".join(t or "" for t in batch.column(0).slice(k, 256).to_pylist()).lower()
            for j in range(0, len(text), 1 << 20):  # two characters of overlap: whole texts
                points = np.frombuffer(text[max(0, j - 2) : j + (1 << 20)].encode("utf-32-le", "replace"), dtype=np.uint32)
                c = _CODE[np.where(points < len(_CODE), points, 0)]
                total += np.bincount((c[:-2] * WIDTH + c[1:-1]) * WIDTH + c[2:], minlength=WIDTH**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities [a, b, c] of c after a, b.  The driver gets one row per trigram: 64**3 at most."""
    counted = docs.select(F.col(text).alias("text")).mapInArrow(trigram_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(WIDTH**3)
    n[counted.column("code").to_numpy()] = counted.column("n").to_numpy()
    n = n.reshape(WIDTH, WIDTH, WIDTH)
    one = n.sum((0, 1)) + 1
    two = (n.sum(0) + 0.5 * one / one.sum()) / (n.sum((0, 2))[:, None] + 0.5)
    return np.log((n + 0.5 * two) / (n.sum(2)[:, :, None] + 0.5)).astype(np.float32)


def lattice(token: str) -> list[tuple[list[tuple[int, float]], float | None]]:
    """For each character the codes that it may stand for with their costs (0 is a boundary), and the cost of standing for nothing."""
    out = []
    for i, ch in enumerate(token):
        ways = [(_AT[ch], 0.0)] if ch in _AT else [(0, 0.0)] if ch == " " else []
        ways += [(_AT[x], COST_ANY if ch == "*" else COST_LEET) for x in LEET.get(ch, "")]
        silent = COST_SEPARATOR if ch in SEPARATORS else COST_REPEAT if i and token[i - 1] == ch else COST_DROP if ch not in _AT else None
        out.append((ways, silent))
    return out


def restore(token: str, penalty: list) -> str:
    """The likeliest spelling of a disguised token; ``penalty`` is the negative character model as nested lists.

    A state is the last two codes; every state is kept.  There are at most as
    many as pairs of letters that the token's characters can stand for, and one
    only after two characters that can stand for themselves alone.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for ways, silent in lattice(token):
        if not ways and silent is None:
            ways = [(0, 0.0)]
        new = {} if silent is None else {s: (cost + silent, path) for s, (cost, path) in states.items()}
        for (a, b), (cost, path) in states.items():
            after = penalty[a][b]
            for c, extra in ways:
                price = cost + extra + after[c]
                if (b, c) not in new or price < new[b, c][0]:
                    new[b, c] = (price, (c, path))
        states = new
    # a word ends with a boundary
    _, path = min((s for s in ((cost + penalty[a][b][0], path) for (a, b), (cost, path) in states.items())), key=lambda s: s[0])
    out = []
    while path:
        c, path = path
        out.append(LETTERS[c - 1] if c else " ")
    return "".join(reversed(out))


class Restorer:
    """The distinct words of a text after restoration; remembers tokens."""

    def __init__(self, model: np.ndarray):
        self.penalty, self.known = (-model).tolist(), {}
        rare = [c for c, i in _AT.items() if model[:, i, i].max() < np.log(UNUSUAL)]
        self.disguised = re.compile("|".join([_DISGUISED, *[c * 2 for c in rare]]))

    def words(self, token: str) -> tuple[str, ...]:
        core = token.lstrip(_BEFORE).rstrip(_AFTER)
        plain = (core,) if core.isalpha() else tuple(_WORD.findall(core))
        return (*plain, *restore(core, self.penalty).split()) if self.disguised.search(core) else plain

    def __call__(self, text: str) -> set[str]:
        text = text.lower()
        tokens, known = set(text.split()), self.known
        if len(known) > REMEMBERED:
            known.clear()
        out: set[str] = set()
        for token in tokens:
            words = known.get(token)
            if words is None:
                words = known[token] = self.words(token)
            out.update(words)
        if sum(len(t) == 1 for t in tokens) > 1:
            for m in _SPACED.finditer(text):
                out.update(restore(m.group(), self.penalty).split())
        out.discard("")
        return out


def features(words) -> set[str]:
    """Whole words as ``word$``, beginnings as they are."""
    out = {w + "$" for w in words}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


_SALT = mix(np.arange(1, MINIMA + 1, dtype=np.uint64))


def signature(words) -> bytes:
    """The minima of a set of words; the share of equal minima estimates the similarity of two sets."""
    if not words:
        return b""
    h = np.array([int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little") for w in words], dtype=np.uint64)
    return (mix(h[None, :] ^ _SALT[:, None]) >> np.uint64(32)).min(axis=1).astype(np.uint32).tobytes()


def _training(model: np.ndarray, texts: list[bytes]) -> list:
    """(words, signature) of each text."""
    r = Restorer(model)
    words = [r(t.decode("utf-8", "replace")) for t in texts]
    return [[sorted(w) for w in words], [signature(w) for w in words]]


def _toxic_features(batches):
    """(g, f): the features of each row of group g."""
    import pyarrow as pa

    for batch in batches:
        for g, words in zip(batch.column("g").to_pylist(), batch.column("words").to_pylist(), strict=True):
            f = sorted(features(words))
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(f), type=pa.int32()), pa.array(f, type=pa.string())], names=["g", "f"])


def _clean_counts(open_: frozenset, batches):
    """(f, n): in how many rows of a task each open feature occurs."""
    import pyarrow as pa

    n = Counter()
    for batch in batches:
        for words in batch.column("words").to_pylist():
            n.update(open_ & features(words))
    yield pa.RecordBatch.from_arrays([pa.array(list(n), type=pa.string()), pa.array(list(n.values()), type=pa.int64())], names=["f", "n"])


def _speaking(chosen: frozenset, batches):
    """For each row whether it has one of the features."""
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([not chosen.isdisjoint(features(w)) for w in batch.column("words").to_pylist()], type=pa.bool_())], names=["speaks"]
        )


def _parent(feature: str) -> str:
    """The next less specific feature; of two with equal support the specific one is meant."""
    return feature[:-1][: PREFIXES[-1]] if feature.endswith("$") else feature[:-1]


def groups(signatures: list[bytes]) -> list[int]:
    """A group for each row, named by its first row.

    A row belongs to the first group leader with which it shares a band of its
    signature and at least half of the minima (near copies); rows without words
    are one group.
    """
    leaders, out = defaultdict(list), []
    for i, s in enumerate(signatures):
        minima = np.frombuffer(s, dtype=np.uint32)
        bands = [(k, s[4 * k : 4 * (k + BAND)]) for k in range(0, len(minima), BAND)] or [(-1, b"")]
        near = sorted({j for b in bands for j in leaders.get(b, ())})
        found = next((j for j in near if 2 * (np.frombuffer(signatures[j], dtype=np.uint32) == minima).sum() >= len(minima)), i)
        if found == i:
            for b in bands:
                leaders[b].append(i)
        out.append(found)
    return out


def cover(of: dict[str, set[int]], gain: int) -> tuple[set[str], set[int]]:
    """A greedy cover of the toxic groups: (features, groups that they cover)."""
    left, seen = {f: set(g) for f, g in of.items()}, {f: len(g) for f, g in of.items()}
    chosen: set[str] = set()
    covered: set[int] = set()
    while left:
        best = max(left, key=lambda f: (len(left[f]), seen[f], len(f), f))
        got = left.pop(best)
        if len(got) < gain:
            break
        chosen.add(best)
        covered |= got
        for f in list(left):
            left[f] -= got
            if len(left[f]) < gain:
                del left[f]
    return chosen, covered


def learn(rows: DataFrame, precision: float = 0.9, gain: int = 3) -> tuple[dict[str, float], float]:
    """(feature -> probability, base) from training rows (toxic, words, sig).

    Rows with equal words count once, near copies among the toxic rows as one
    group.  Features come from a greedy cover of the toxic groups; to them are
    added those that are too often toxic, given the share of toxic rows and the
    number of features, to be so by chance.
    """
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("h", F.xxhash64("words")).dropDuplicates(["toxic", "h"]), "toxic-distinct")
    bad, clean = rows.where("toxic"), rows.where("not toxic").select("words")
    signed = bad.select("h", "sig").orderBy("h").collect()
    n_clean = clean.count()
    of_row = groups([bytes(r.sig) for r in signed])
    n_bad = len(set(of_row))
    if not n_bad or not n_clean:
        return {}, 0.5
    named = spark.createDataFrame([(r.h, g) for r, g in zip(signed, of_row, strict=True)], "h long, g int")
    each = bad.join(F.broadcast(named), "h").select("g", "words").mapInArrow(_toxic_features, "g int, f string")
    held = each.groupBy("f").agg(F.collect_set("g").alias("groups")).where(F.size("groups") >= gain)
    held = materialize(held.orderBy(F.desc(F.size("groups")), "f").limit(MAX_FEATURES), "toxic-features")
    open_ = frozenset(r.f for r in held.select("f").collect())
    counts = clean.mapInArrow(partial(_clean_counts, open_), "f string, n long").groupBy("f").agg(F.sum("n").alias("clean"))
    both = held.join(counts, "f", "left").select("f", "groups", F.coalesce("clean", F.lit(0)).alias("clean"))
    of, seen_clean = {}, {}
    for r in both.where(F.size("groups") >= precision * (F.size("groups") + F.col("clean"))).collect():
        of[r.f], seen_clean[r.f] = set(r.groups), r.clean
    for f in [_parent(f) for f in of if len(of.get(_parent(f), ())) == len(of[f])]:
        of.pop(f, None)
    chosen, covered = cover(of, gain)
    share = n_bad / (n_bad + n_clean)
    sure = np.log(0.01 / max(len(open_), 1)) / np.log(share)
    chosen |= {f for f, g in of.items() if not seen_clean[f] and len(g) >= max(gain, sure)}
    free = clean.mapInArrow(partial(_speaking, frozenset(chosen)), "speaks boolean").where("not speaks").count()
    left = n_bad - len(covered)
    base = (left + 0.5) / (left + free + 1)
    return {f: (len(of[f]) + 0.5) / (len(of[f]) + seen_clean[f] + DOUBT) for f in sorted(chosen)}, min(base, 0.5)


def _scores(model: np.ndarray, lexicon: dict[str, float], base: float, texts: list[bytes]) -> list:
    """The noisy-or over the words of each text; a word speaks through its likeliest feature only."""
    r = Restorer(model)
    whole = {f[:-1] for f in lexicon if f.endswith("$")}
    begins = {f for f in lexicon if not f.endswith("$")}
    short = {f[: PREFIXES[0]] for f in begins}
    out = []
    for t in texts:
        words = r(t.decode("utf-8", "replace"))
        hits = words & whole
        hits.update(w for w in words if w[: PREFIXES[0]] in short and any(w[:n] in begins for n in PREFIXES))
        clear = 1 - base
        for w in sorted(hits):
            clear *= 1 - max(lexicon.get(w + "$", 0.0), *(lexicon.get(w[:n], 0.0) for n in PREFIXES))
        out.append(1 - clear)
    return [np.array(out, dtype=np.float64)]


def held_out(key: str):
    """Rows whose labels are never read."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text"):
    """The kernel that scores texts: the character model of ``docs`` and what ``labels`` (key, toxic) teach."""
    model = character_model(docs, text)
    known = labels.where(~held_out(key) & F.col("toxic").isNotNull()).groupBy(key).agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64(key), key).limit(train_rows)
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(sample), key).select(F.col("toxic").cast("boolean").alias("toxic"), "text")
    made = map_texts(rows, ["toxic"], "text", partial(_training, model), "words array<string>, sig binary")
    lexicon, base = learn(made)
    return partial(_scores, model, lexicon, base)


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score) of every row of ``docs``; ``labels`` has (key, toxic)."""
    kernel = fitted(docs, labels, train_rows, key, text)
    return map_texts(docs.select(key, held_out(key).alias("held_out"), text), [key, "held_out"], text, kernel, "score double")


def accepted(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; they pass by without a shuffle."""
    kernel = fitted(docs, labels, train_rows, key, text)
    own = docs.columns
    rows = map_texts(docs.withColumn("_sw_text", F.col(f"`{text}`")), own, "_sw_text", kernel, "_sw_score double")
    return rows.where(F.col("_sw_score") < threshold).select(*[F.col(f"`{c}`") for c in own])


def op5(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    rows = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
