"""The queries on whole tables: against their SQL, or against brute force where SQL can't say it."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from screenwright.llm import queries as Q
from tests.compare import check, connection


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    check(spark, sf, Q.queries()[name], Q.oracle_sql()[name])


def documents(sf):
    return dict(connection(sf).sql("select doc_id, text from documents").fetchall())


def rows(spark, sf, name):
    return Q.queries()[name](spark, sf).collect()


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for i, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or "", re.A):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(
                int(x) <= 255 for x in m.group().split(".")
            ) or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15:
                out.append((m.start(), i, m.end()))
    return ",".join(f"{PATTERNS[i][0]}:{a}:{b}" for a, i, b in sorted(out))


def test_pii(spark, sf):
    docs = documents(sf)
    got = rows(spark, sf, "op1_pii")
    assert len(got) == len(docs)
    for r in got:
        said = plain_spans(docs[r.doc_id])
        kinds = Counter(x.split(":")[0] for x in said.split(",") if x)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k, _ in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


TERM, NAME = re.compile(r"[^\W_]+"), re.compile(r"(?<![^\W_])[A-ZÀ-ÖØ-Þ][^\W_]*(?: [A-ZÀ-ÖØ-Þ][^\W_]*)+")


def plain_classes():
    """Of a term its class; of a text the classes that it shows."""
    def of(term):
        return 0 if re.fullmatch(r"\d+", term) else 1 if re.search(r"\d", term) else 2 if term[0].isupper() else 3

    shows = (r"(?<![^\W_])\d+(?![^\W\d_])", r"[^\W\d_]\d|\d[^\W\d_]", r"(?<![^\W_])[A-ZÀ-ÖØ-Þ]", r"(?<![^\W_])(?![A-ZÀ-ÖØ-Þ])[^\W\d_]")
    return of, lambda text: {i for i, p in enumerate(shows) if re.search(p, text)}


def test_disclosing_terms(spark, sf):
    """All spans of the query, and what becomes of them, against counts made row by row."""
    import math

    from screenwright.llm import pii

    docs = {k: t for k, t in documents(sf).items() if t is not None}
    of, shown = plain_classes()
    n, n_t, n_e, n_te, kinds = len(docs), Counter(), Counter(), Counter(), defaultdict(set)
    mentions = defaultdict(list)
    for k, text in docs.items():
        low = text.lower()
        n_t.update({w for w in re.split(r"[\W_]+", low) if w} | {m.lower() for m in NAME.findall(text)} | {f"class:{i}" for i in shown(text)})
        spans = [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in plain_spans(text).split(",") if x)]
        held, near_e = set(), set()
        for a, b, kind in spans:
            entity = (kind, low[a:b])
            near_e.add(entity)
            lo, hi = max(0, a - 60), b + 60
            left, right = text[lo:a], text[b:hi]
            cut = TERM.match(left).end() if lo and TERM.match(left) else 0
            tail = re.search(r"[^\W_]+$", right) if len(right) == 60 else None
            for at, part in ((lo + cut, left[cut:]), (b, right[: tail.start()] if tail else right)):
                for m in [*TERM.finditer(part), *NAME.finditer(part)]:
                    s, e = at + m.start(), at + m.end()
                    if not any(x < e and s < y for x, y, _ in spans):
                        held |= {(entity, m.group().lower()), (entity, f"class:{of(m.group())}")}
                        mentions[k].append((s, e, entity, m.group().lower(), of(m.group())))
        n_e.update(near_e)
        n_te.update(held)

    def share(entity, term):
        ic = math.log2(n / n_e[entity])
        return (math.log2((n_te[entity, term] + n_e[entity] / n) / (n_t[term] + 1)) + ic) / ic

    got = {r.doc_id: r for r in rows(spark, sf, "op1_pii")}
    assert sum(r.n_generalised for r in got.values()) and sum(r.n_removed for r in got.values())
    for k in docs:
        action = {}
        for s, e, entity, term, kind in mentions[k]:
            x = share(entity, term)
            if x >= 0.7:
                cut = x >= 0.9 or share(entity, f"class:{kind}") >= 0.7
                action[s, e] = max(action.get((s, e), -1), pii.CUT if cut else kind)
        want, reached = [], 0
        for s, e in sorted(action, key=lambda p: (p[0], -p[1])):
            if s >= reached:
                want.append((s, e))
            reached = max(reached, e)
        assert [tuple(map(int, x.split(":")[1:])) for x in got[k].spans.split(",") if x.startswith("term")] == want, k
        assert got[k].n_removed == sum(action[p] == pii.CUT for p in want) and got[k].n_generalised == len(want) - got[k].n_removed


def test_decontamination(spark, sf):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    items = {i: words(t) for i, t in connection(sf).sql("select item_id, text from benchmark").fetchall()}
    at = defaultdict(list)
    for i, w in items.items():
        for j, x in enumerate(w):
            at[x].append((i, j))
    want = set()
    for k, text in documents(sf).items():
        same = defaultdict(set)
        for p, x in enumerate(words(text)):
            for i, j in at.get(x, ()):
                same[i, p - j].add(j)
        for (i, _), js in same.items():
            n = len(items[i])
            run = min(13, n)
            if n >= 8 and any(100 * sum(j in js for j in range(b, b + run)) >= 75 * run for b in range(n - run + 1)):
                want.add((k, i))
    assert {(r.doc_id, r.item_id) for r in rows(spark, sf, "op4_decontamination")} == want and want


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in rows(spark, sf, "op5_toxicity")}
    labels = dict(connection(sf).sql("select doc_id, toxic from labels").fetchall())
    held = [(got[k].predicted, t) for k, t in labels.items() if got[k].held_out]
    assert len(got) == 1000 and sum(p == t for p, t in held) >= 0.9 * len(held)
    assert not any(p > t for p, t in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_scores(spark, sf):
    """Every score again, from the lexicon and the character model, one text and one word at a time."""
    from screenwright.llm import toxicity as T
    from screenwright.llm.tables import table

    kernel = T.fitted(table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", "toxic"))
    model, lexicon, base = kernel.args
    assert lexicon and 0 < base <= 0.5
    r = T.Restorer(model)
    got = {x.doc_id: x.score for x in rows(spark, sf, "op5_toxicity")}
    for k, text in documents(sf).items():
        low, words = (text or "").lower(), set()
        for token in low.split():
            core = token.lstrip(T._BEFORE).rstrip(T._AFTER)
            words |= {core} if core.isalpha() else set(re.findall(r"[^\W\d_]+", core))
            if r.disguised.search(core):
                words |= set(T.restore(core, r.penalty).split())
        for m in T._SPACED.finditer(low):
            words |= set(T.restore(m.group(), r.penalty).split())
        clear = 1 - base
        for w in words:
            clear *= 1 - max([p for f, p in lexicon.items() if f == w + "$" or not f.endswith("$") and w.startswith(f)], default=0.0)
        assert abs(got[k] - (1 - clear)) < 1e-9, k


def test_lexicon(spark):
    """What is learned from a handful of rows, against counts by hand."""
    from screenwright.llm import toxicity as T

    bad = [[f"bad{i}", f"only{k}x", *[f"w{k}y{j}" for j in range(30)]] for k in range(12) for i in range(1)]
    good = [[f"good{k}", "bad" if k < 1 else "fine", *[f"v{k}y{j}" for j in range(30)]] for k in range(40)]
    data = [(True, sorted(w), T.signature(w)) for w in [*bad, bad[0]]] + [(False, sorted(w), T.signature(w)) for w in good]
    lexicon, base = T.learn(spark.createDataFrame(data, "toxic boolean, words array<string>, sig binary"))
    assert set(lexicon) == {"bad0$"} or max(lexicon, key=lambda f: (lexicon[f], len(f))) in ("bad0$", "bad0")
    assert abs(max(lexicon.values()) - 12.5 / (12 + T.DOUBT)) < 1e-9 and abs(base - 0.5 / 41) < 0.02
    assert T.learn(spark.createDataFrame(data[:3], "toxic boolean, words array<string>, sig binary")) == ({}, 0.5)


def test_tokens(spark, sf):
    from screenwright.llm.tokens import RANKS, encoder, vocabulary

    e = encoder(vocabulary(RANKS))
    got = rows(spark, sf, "op6_token_counts")
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((k, len(e.encode_ordinary(t or ""))) for k, t in documents(sf).items())


def near_components(texts, width, percent=80):
    fold = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for k, t in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", (t or "").translate(fold)) if x]
        sets[k] = set(zip(*(w[i:] for i in range(width)), strict=False)) if len(w) >= width else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            near = b < a and 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b]))
            both = len(sets[a] & sets[b]) if near else 0
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize(
    ("sf", "width"), [("/root/testdata/sf0.001", 2), ("/root/testdata/sf0.001", 5), ("/root/testdata/sf0.01", 2), ("/root/testdata/sf0.01", 5)]
)
def test_near_duplicates(spark, sf, width):
    """The components of all pairs: no link is missed among 1,000 documents."""
    from screenwright.llm.neardup import near_duplicates
    from screenwright.llm.tables import table

    got = near_duplicates(table(spark, sf, "documents"), width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_components(documents(sf), width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sharding(spark, sf):
    docs = documents(sf)
    got = rows(spark, sf, "op10_sharding")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    import zlib

    assert all(r.size == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in got)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1 and set(shards) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    assert sorted(map(tuple, rows(spark, sf, "op10_sharding"))) == sorted(map(tuple, got))


def test_pipeline(spark, sf):
    """Every stage against a plain statement of it on what its predecessor kept."""
    import corpus_pipeline as P
    from screenwright.llm import mixing, toxicity
    from screenwright.llm.decontamination import matches
    from screenwright.llm.tables import table

    docs = table(spark, sf, "documents")
    columns = docs.columns
    kept = {}
    frames = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf)
        held = [r.asDict() for r in out.collect()]
        frames[name], kept[name] = docs, held
        if name != "sharding":
            assert out.columns == columns
        docs = spark.createDataFrame([tuple(h[c] for c in out.columns) for h in held], out.schema)
    ids = lambda name: sorted(h["doc_id"] for h in kept[name])
    scores = {r.doc_id: r.score for r in toxicity.score(frames["toxicity"], table(spark, sf, "labels").select("doc_id", "toxic")).collect()}
    assert ids("toxicity") == sorted(k for k, s in scores.items() if s < 0.7)
    comps = near_components({h["doc_id"]: h["text"] for h in kept["toxicity"]}, 5)
    assert ids("near_duplicates") == sorted(k for k, (_, c) in comps.items() if k == c)
    bad = {r.doc_id for r in matches(frames["decontamination"], table(spark, sf, "benchmark")).collect()}
    assert ids("decontamination") == sorted(set(ids("near_duplicates")) - bad)
    want = {r.id: r.taken for r in mixing.taken(mixing.mix(frames["mixing"])).collect()}
    count = Counter()
    for h in kept["mixing"]:
        count[h["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", h["text"]))
    assert {k: v for k, v in want.items() if v} == dict(count)
    assert Counter(h["doc_id"] for h in kept["sharding"]) == Counter(h["doc_id"] for h in kept["mixing"])
    assert len(P.run(spark, sf).collect()) == len(kept["sharding"])


ODD = [
    (1, "a b c d e f g h", "en", "s", 15), (1, "a b c d e f g h", "en", "s", 15), (1, "q r s t u v w x y z", "en", "s", 19), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "null id " * 5, "en", "t", 40),
    (None, None, "en", None, 0), (4, "x" * 50_000 + " end", "de", "t", 50_004), (5, "A B C d e f g h", "en", "u", 15),
]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, tmp_path, empty):
    """Nulls, repeated ids and rows, empty and very long texts, maps and clashing names go through every stage."""
    import corpus_pipeline as P
    from pyspark.sql import functions as F

    shape = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(ODD[:0] if empty else ODD, shape)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, "one two three four five six seven eight nine")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    wide = docs.withColumn(
        "m", F.create_map(F.lit("k"), F.col("doc_id"))
    ).withColumn("shard", F.lit(1)).withColumn("size", F.lit(2)).withColumn("id", F.lit(3)).withColumn("key", F.lit(4)).withColumn("rep", F.lit(5))
    for rows_ in (docs, wide):
        now = rows_
        for name, stage in P.STAGES:
            out = stage(spark, now, str(tmp_path))
            out.write.mode("overwrite").parquet(f"{tmp_path}/out-{name}-{len(rows_.columns)}")
            if name != P.STAGES[-1][0]:
                assert out.columns == now.columns
            now = spark.read.parquet(f"{tmp_path}/out-{name}-{len(rows_.columns)}")
            if name in ("toxicity", "decontamination"):
                kept = {(r.doc_id, r.text) for r in now.collect()}
                assert empty or (1, "q r s t u v w x y z") in kept
        ids = sorted((r.doc_id or 0, (r.text or "")[:5]) for r in now.collect())
        if not empty:  # mixing takes no document without words
            assert {(1, "a b c"), (1, "q r s"), (0, "null "), (4, "xxxxx")} <= set(ids) and 5 not in {k for k, _ in ids}
    assert len(P.run(spark, str(tmp_path)).collect()) == (0 if empty else len(ids))
