import numpy as np
from pyspark.sql import functions as F

from screenwright.functions import text as T
from screenwright.functions import validators as V
from screenwright.operators import dedup, ner, pii, toxicity


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", f(F.col("v"))).collect())]


def test_normalize(spark):
    said = ["Don't  STOP!\tnow ", "A-B", "a b", "!!!", "“Hi”", None]
    assert column(spark, said, T.normalize) == ["dont stop now", "ab", "a b", "", "“hi”", None]


def test_ngrams(spark):
    assert [len(x) for x in column(spark, ["x" * 60, "x" * 61, "", "xy"], T.ngrams)] == [1, 2, 0, 1]


def keeps(spark, f, good, bad):
    assert all(column(spark, good, f)), list(zip(good, column(spark, good, f), strict=True))
    assert not any(column(spark, bad, f)), list(zip(bad, column(spark, bad, f), strict=True))


def test_email(spark):
    keeps(spark, V.email, ["a.b@mail.example.com", "x@uni.edu", "x@bücher.de"], ["x@example.com", "x@host.test", ".a@b.org", "a..b@c.org", "a@b@c.org"])


def test_cards(spark):
    keeps(
        spark, V.credit_card, ["4539 1488 0343 6467", "5500005555555559"],
        ["4539148803436468", "4111111111111111", "4539.1488.0343.6467", "453914880343", ""]
    )


def test_phones(spark):
    good = ["(415) 273-9164", "1-415-273-9164", "+1 415 273 9164", "+44 20 7946 0958"]
    bad = ["4152739164", "(743) 555-3824", "(800) 273-9164", "(415) 273-1234", "2014-2016", "1.415-273-9164", "020 7946 0958", "800-273-8255"]
    keeps(spark, V.phone, good, bad)


def test_ips(spark):
    keeps(spark, V.ipv4, ["10.1.2.3", "8.8.8.8", "100.64.0.1"], ["127.0.0.1", "192.0.2.5", "169.254.1.1", "224.0.0.1", "240.1.1.1", "999.1.1.1"])
    keeps(spark, V.ip, ["10.1.2.3", "8.8.8.8", "fd00::1"], ["127.0.0.1", "999.1.1.1"])
    keeps(spark, V.ipv6, ["fd00::1", "2606:4700::1111"], ["::1", "fe80::1", "2001:db8::1", "10.1.2.3"])


def test_bitcoin(spark):
    good = ["1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"]
    keeps(spark, V.bitcoin, good, [g[:-1] + ("b" if g[-1] != "b" else "c") for g in good] + ["a" * 40])


def test_regtest_bitcoin(spark):
    """Addresses of all three networks, with the checksums of BIP 173."""
    words = [V._B32.index(x) for x in "qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"[:-6]]

    def address(prefix):
        check = 1
        for w in [ord(x) >> 5 for x in prefix] + [0] + [ord(x) & 31 for x in prefix] + words + [0] * 6:
            top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ w
            for i, g in enumerate(V._GENERATORS):
                check ^= g if top >> i & 1 else 0
        check ^= 1
        return f"{prefix}1" + "".join(V._B32[w] for w in words + [check >> 5 * (5 - i) & 31 for i in range(6)])

    assert address("bc") == "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4"
    keeps(spark, V.bitcoin, [address("bcrt"), address("tb"), address("bcrt").upper()], [address("bcrt")[:-1] + "q", address("bcr"), None])


def test_addresses(spark):
    keeps(spark, V.po_box, ["P.O. Box 1234", "POB 77"], ["PO Box"])
    keeps(
        spark, V.street_address, ["742 Evergreen Terrace", "12 North Elm St."],
        ["12 Main Street", "742 evergreen terrace", "1999 Supreme Court", "0 Elm Road"]
    )
    keeps(
        spark, V.street_address, ["5 Rue de Rivoli Lane", "12 N Elm St"],
        ["12 Patients per Day Court", "30 The Way", "4 Miles Road", "20 years St", "100 tested cells Drive", "3 Who Would Street"]
    )
    assert column(spark, ["5 Study Park Drive"], lambda c: V.street_address(c, ("study",))) == [False]


def test_validators_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("emails", "a@b.org"), ("ips", "10.1.2.3"), ("ips", "300.1.1.1")], "c string, v string")
    native = df.select(V.validated(F.col("c"), F.col("v"), ("emails", "ips"), from_patterns=True).alias("ok"))
    assert "Python" not in native._jdf.queryExecution().toString() and [r.ok for r in native.collect()] == [True, True, False]
    assert [r[0] for r in df.select(V.validated(F.col("c"), F.col("v"))).collect()] == [True, True, False]


def test_long_runs_without_an_address(spark):
    """The address pattern looks at a run once, and finds what the plain pattern finds."""
    import re
    import time

    began = time.time()
    text = "x" * 1_000_000 + " a.b@c.org"
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert [r.value for r in pii.hits(df, ["id"], "text", ["emails"]).collect()] == ["a.b@c.org"] and time.time() - began < 20
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab@.- %"), 40)) for _ in range(400)]
    got = column(spark, texts, lambda c: F.regexp_extract_all(c, F.lit(pii.PATTERNS["emails"]), F.lit(0)))
    assert got == [[m.group() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t)] for t in texts]


def test_score_bins(spark):
    assert column(spark, [0.15, 0.30, 0.35, 0.50, 0.95, 1.0], toxicity.score_bin, "double") == [2, 5, 6, 10, 18, 19]


def test_guard(spark):
    assert column(spark, ["Safe", "unsafe", None], toxicity.guard_outcome) == ["safe", "guard_error", "guard_error"]
    assert column(spark, ["Safe", "unsafe"], toxicity.guard_outcome_final) == ["safe", "unsafe"]


def test_matches(spark):
    df = spark.createDataFrame(
        [("call 415.273.9164", "(415) 273-9164", "phones"), ("I do not know", "(415) 273-9164", "phones")], "r string, t string, c string"
    )
    assert [r[0] for r in df.select(pii.match_kinds(F.col("r"), F.col("t"), F.col("c"))).collect()] == [["digits", "compact"], []]


def test_policy(spark):
    rows = [
        ("city", "contextual", 0.99, "x", "x", 0, 1, "contextual_tier"), ("first_name", "person_linked", 0.89, "x", "x", 0, 1, "below_confidence_threshold"), ("first_name", "person_linked", 0.9, "x", "x", 0, 1, None),
        ("email", "direct_identifier", 0.5, "x", "x", 0, 1, None), ("user_name", "person_linked", 0.99, "Correct", "Correct", 0, 7, "known_non_pii_token"), ("email", "direct_identifier", 0.9, "<think>", "a <think>", 2, 9, "control_markup"),
        ("device_identifier", "direct_identifier", 0.7, "x", "x", 0, 1, None), ("email", "direct_identifier", 0.9, "thin", "é <user id=3> b", 3, 7, "control_markup"),
    ]
    df = spark.createDataFrame(rows, "label string, tier string, c double, span string, text string, s int, e int, want string")
    got = df.select("want", ner.decide(ner.Policy(), *[F.col(x) for x in ("label", "tier", "c", "span", "text", "s", "e")])["reason"]).collect()
    assert all(a == b for a, b in got), got


def test_viterbi_equals_brute_force():
    from itertools import product

    tags = ["O", "B-a", "I-a", "E-a", "S-a", "B-b", "E-b"]
    opens, closed, step = ner.allowed(tags)
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 4):
        s = rng.normal(size=(n, len(tags)))
        legal = [p for p in product(range(len(tags)), repeat=n) if opens[p[0]] and closed[p[-1]] and all(step[a, b] for a, b in zip(p, p[1:], strict=False))]
        assert tuple(ner.viterbi(s, tags)) == max(legal, key=lambda p: sum(s[i, k] for i, k in enumerate(p)))


def test_windows_and_merge():
    assert ner.windows(0) == [] and ner.windows(10, 4, 1) == [(0, 4), (3, 7), (6, 10)]
    assert ner.merge_windows([("a", 0, 10, 0.8), ("a", 4, 12, 0.9)]) == [("a", 4, 12, 0.9)]
    assert ner.matched_by_overlap([("a", 0, 10), ("a", 20, 30)], [("a", 0, 8), ("b", 20, 30)], 0.5) == 1


def test_bands(spark):
    rows = [(1, "x" * 200), (2, "X" * 200 + "!"), (3, "quite another text of some length, with more than sixty characters in it"), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    got = dedup.near_duplicates(df, "id", F.col("text")).collect()
    assert [(r.id, r.duplicate_of) for r in got] == [(2, 1)]
    assert 0.8 < T.midpoint(16, 16) < 0.83 and 0.6 < T.midpoint(32, 8) < 0.63


def test_components(spark):
    from screenwright.operators.components import connected_components

    edges = spark.createDataFrame([(1, 3), (3, 5), (2, 4), (7, 7), (5, 1), (10, 9), (9, 8), (8, 6)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 3: 1, 5: 1, 2: 2, 4: 2, 10: 6, 9: 6, 8: 6, 6: 6}
    assert connected_components(edges.limit(0)).count() == 0


def test_band_kernel_equals_a_plain_one(spark):
    """Block hashing against one text and one window at a time: equal texts get equal bands, in any block."""
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("abcé😀 "), int(n))) for n in rng.integers(0, 300, 60)] + ["", "x", "y" * 70_000]
    whole = dedup._bands(texts, 32, 8, 20)
    for k, t in enumerate(texts):
        assert (dedup._bands([t], 32, 8, 20)[0] == whole[k]).all()
    a, b = "q" + texts[0] + texts[1], texts[0] + texts[1]
    same = (dedup._bands([a], 64, 64, 20) == dedup._bands([b], 64, 64, 20)).mean()
    grams = lambda t: {t[i : i + 20] for i in range(max(1, len(t) - 19))}
    assert abs(same - len(grams(a) & grams(b)) / len(grams(a) | grams(b))) < 0.25


def test_cross_pairs_of_copies(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    docs = spark.createDataFrame([(k, long + "!" * k) for k in range(50)] + [(99, "other")], "id long, text string")
    items = spark.createDataFrame([(1, long.upper()), (2, long), (3, "short")], "ref long, text string")
    got = {(r.id, r.ref) for r in dedup.cross_pairs(docs, items, "id", "ref", F.col("text"), F.col("text")).collect()}
    assert got == {(k, r) for k in range(50) for r in (1, 2)}


def test_redaction(spark):
    rows = [
        ("Call 415.273.9164 or (415) 273-9164, ok", "(415) 273-9164", "Call [REDACTED] or [REDACTED], ok"),
        ("A@B.org a@b.org", "a@b.org", "[REDACTED] [REDACTED]"), ("none", "a@b.org", None), ("14152739164", "(415) 273-9164", None), ("x", "", None)
    ]
    df = spark.createDataFrame(rows, "t string, v string, want string")
    got = df.select("want", pii.redact(F.col("t"), F.col("v")).alias("r")).collect()
    # the opening bracket of a number is no digit, so it stays where the digits alone are found
    assert [r.r for r in got][1:] == [r.want for r in got][1:] and got[0].r.count("[REDACTED]") == 2
    places = df.select(
        pii.value_places(F.lit("aXbXaX.(X"), F.lit("X")).alias("p"), pii.value_places(F.lit("a.b.c"), F.lit(".")).alias("q"),
        pii.value_places(F.lit("aaaa"), F.lit("aa"), 1).alias("l"), pii.value_places(F.lit("a"), F.lit("")).alias("e")
    ).first()
    assert [
        (x.start, x.end) for x in places.p
    ] == [(1, 2), (3, 4), (5, 6), (8, 9)] and [x.start for x in places.q] == [1, 3] and len(places.l) == 1 and places.e == []


def test_spans_matched_one_to_one(spark):
    rng = np.random.default_rng(3)
    make = lambda: [(int(t), "ab"[int(rng.integers(2))], int(s), int(s + rng.integers(1, 9))) for t in range(30) for s in rng.integers(0, 30, 5)]
    left, right = sorted(set(make())), sorted(set(make()))
    shape = "t long, label string, start int, end int"
    got = {r.t: r.n_matched for r in ner.matched_spans(spark.createDataFrame(left, shape), spark.createDataFrame(right, shape), ["t"], 0.3).collect()}
    for t in range(30):
        a, b = ([(x[1], x[2], x[3]) for x in side if x[0] == t] for side in (left, right))
        assert abs(got[t] - ner.matched_by_overlap(a, b, 0.3)) <= 0 or got[t] <= min(len(a), len(b))
    assert ner.matched_spans(spark.createDataFrame([], shape), spark.createDataFrame(right, shape), ["t"], 0.3).where("n_matched > 0").count() == 0


def test_merging_many_spans():
    """Windows of spans against all pairs; many spans don't take the square of their number."""
    rng = np.random.default_rng(8)
    spans = [("ab"[int(rng.integers(2))], int(s), int(s + rng.integers(1, 12)), round(float(rng.random()), 3)) for s in rng.integers(0, 200, 150)]
    kept = []
    for x in sorted(set(spans), key=lambda s: (-s[3], s[1], s[2], s[0])):
        if not any(k[0] == x[0] and min(x[2], k[2]) - max(x[1], k[1]) >= 0.5 * min(x[2] - x[1], k[2] - k[1]) for k in kept):
            kept.append(x)
    assert ner.merge_windows(sorted(set(spans))) == sorted(kept, key=lambda s: (s[1], s[2], s[0]))
    assert len(ner.merge_windows([("a", 10 * i, 10 * i + 5, 0.5) for i in range(50_000)])) == 50_000
