"""Operators on the parts of their job that the driver's tables don't reach."""

import numpy as np
from pyspark.sql import functions as F

from screenwright.operators import dedup, pii
from screenwright.plans import catalog
from tests.compare import check


def plain(text):
    kept = "".join(c for c in (text or "").lower() if c not in catalog.T.PUNCTUATION)
    return kept.split()


def windows(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_contamination_of_any_part(spark, tmp_path):
    item = [f"word{i}" for i in range(20)]
    items = [(1, " ".join(item)), (2, "Just five words, in all!"), (3, "one"), (4, "..."), (5, None), (6, " ".join(["again"] * 12)), (7, " ".join(item[:8]))]
    texts = [
        " ".join(["x", *item[9:], "y"]), " ".join(["changed", *item[1:]]), " ".join(item[:7] + ["cut"]), " ".join(item[12:]), " ".join(item[13:]), " ".join(item[:8]),
        "and just five words in ALL, then", "just five words in", "one", "someone", "", None, "again " * 8, "again " * 7, " ".join(item[5:12] + ["z"] + item[13:]),
    ]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(
        [(k, t, f"s{k % 2}") for k, t in enumerate(texts)], "doc_id long, text string, source string"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, t in items:
        w = plain(t)
        n = min(8, len(w))
        want |= {(k, i) for k, x in enumerate(texts) if n and windows(w, n) & windows(plain(x), n)}
    got = [(r.doc_id, r.item_id) for r in catalog.queries()["contamination_exact"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and {(0, 1), (1, 1), (3, 1), (6, 2), (8, 3), (12, 6)} <= want
    kept = {r.doc_id for r in catalog.queries()["decontaminated_documents"](spark, str(tmp_path)).collect()}
    assert kept == set(range(len(texts))) - {k for k, _ in want}


def test_contamination_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BROADCAST_WINDOWS", 1)
    rows = spark.createDataFrame([(1, "a b c d e f g h i j")], "id long, text string")
    other = spark.createDataFrame([(5, "z c d e f g h i j z"), (6, "c d e f g h i")], "ref long, text string")
    got = dedup.containing(rows, other, ["id"], "ref", F.col("text"), F.col("text"))
    assert sorted((r.id, r.ref) for r in got.collect()) == [(1, 5), (1, 6)]


def test_recall_of_near_copies(spark):
    """Pairs at a window similarity of 0.7 to 0.9: nearly all are met by the bands that the queries use."""
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows, true, size = [], {}, 1500
    for k in range(120):
        whole = "".join(rng.choice(letters, size))
        want = 0.7 + 0.2 * k / 119
        cut = round((size - 59) * (1 - want) / (1 + want))
        other = "".join(rng.choice(letters, cut)) + whole[cut:]
        a, b = ({t[i : i + 60] for i in range(size - 59)} for t in (whole, other))
        true[k] = len(a & b) / len(a | b)
        rows += [(2 * k, whole), (2 * k + 1, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met = {(r.id, r.duplicate_of) for r in dedup.near_duplicates(docs, "doc_id", F.col("text")).collect()}
    assert met <= {(2 * k + 1, 2 * k) for k in true}
    strict = {(r.id, r.duplicate_of) for r in dedup.near_duplicates(docs, "doc_id", F.col("text"), 16, 16).collect()}
    high = [k for k, s in true.items() if s >= 0.8]
    low = [k for k, s in true.items() if s < 0.8]
    share = lambda found, ks: sum((2 * k + 1, 2 * k) in found for k in ks) / len(ks)
    assert len(high) > 20 and len(low) > 20
    assert share(met, high) >= 0.99 and share(met, low) >= 0.85, (share(met, high), share(met, low))
    assert share(strict, low) < 0.5


def test_redacted_contexts_of_repeated_values(spark, tmp_path):
    """Equal numbers with one character between them, and letters that only some engines fold, as its SQL has them; the operator itself takes every place."""
    ip, phone, mail = "69.215.74.137", "+1 (307) 555-5491", "kim.s@mail7.example.com"
    texts = [
        f"{ip} {ip}", f"{ip}\n{ip}\n{ip}\n{ip}", f"{ip}, {ip}", f"a {ip}😀{ip}", f"{phone}/{phone} {phone}", "307-555-5491 307-555-5491\n", f"x{ip}", f"{ip}0 {ip}",
        f"{mail} kım.s@maıl7.example.com", f"{mail} KİM.S@MAİL7.EXAMPLE.COM", f"{mail} \u212aIM.ſ@mail7.example.com", "4322 9489 4646 3802é4322 9489 4646 3802"
    ]
    rows = [(4 * i + k, t, f"s{k}") for i, t in enumerate(texts) for k in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, str(tmp_path), catalog.queries()["redacted_contexts"], catalog.oracle_sql()["redacted_contexts"])
    asked = F.lit(ip.replace(".", "/"))
    both = spark.range(1).select(*[pii.redact(F.lit(texts[0]), asked, re2=r).alias(n) for n, r in (("whole", False), ("sql", True))]).first()
    assert both.whole == "[REDACTED] [REDACTED]" and both.sql == f"[REDACTED] {ip}"
