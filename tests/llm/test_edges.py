"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenwright.llm import chat, decontamination, mixing, neardup, pii, quality, sharding, tokens, toxicity, warc
from screenwright.llm.words import Block, windows

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
SHAPE = "doc_id long, text string, source string, n long, key string, rep long, size long, _text string, h string"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        (1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "A B C d e f g h"), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, LONG + " tail"),
        (None, "a b c d e f g h"), (8, "é😀 x@y.zz é"), (9, "one")
    ]
    return spark.createDataFrame([(k, t, None if k == 9 else f"s{(k or 0) % 3}", 1, "k", 2, 3, "t", "h") for k, t in texts], SHAPE)


def test_words_of_blocks():
    b = Block([b"", b" a  bb\tc", b"dd"])
    assert [bytes(b.buf[s:e]) for s, e in zip(b.start, b.end, strict=True)] == [b"a", b"bb", b"c", b"dd"]
    assert list(b.hi - b.lo) == [0, 3, 1]
    h = b.hash_spans(b.start, b.end)
    assert len(set(h.tolist())) == 4 and h[3] == Block([b"x dd"]).hash_spans(np.array([2]), np.array([4]))[0]
    assert list(windows(h, b.lo, b.hi, 2)[2]) == [0, 2, 2]


def test_pii(spark, odd):
    got = {r.doc_id: r for r in pii.sanitise(odd).collect()}
    # the letter beside the address stands nowhere else, so it gives the address away
    assert got[8].sanitised == "[WORD]😀 [EMAIL] [WORD]" and [(s.start, s.end) for s in got[8].base] == [(3, 9)]
    assert got[3].base == [] and got[3].sanitised == "" and got[6].sanitised == LONG
    assert pii.sanitise(odd.limit(0)).count() == 0


def test_disclosing_terms(spark):
    """A word that only stands beside one address gives it away; words of all texts don't."""
    told = [(i, "write to the zorble desk at box@corp.zz or call") for i in range(6)]
    other = [(100 + i, f"the desk at noon number {i} or call to write") for i in range(60)]
    df = spark.createDataFrame(told + other, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert got[0].sanitised == "write to the  desk at [EMAIL] or call"
    assert all(got[i].sanitised == t for i, t in other)
    # a name of two words that a few other texts have is generalised, and so is a single mention
    more = [
        (200, "ask Ann Lee at a@corp.zz today"), *[(201 + i, f"Ann Lee was number {i}") for i in range(3)],
        *[(300 + i, f"Jim Ray had to ask at noon {i}") for i in range(400)]
    ]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(told + other + more, "doc_id long, text string")).collect()}
    assert got[200].sanitised == "ask [NAME] at [EMAIL] [WORD]"


def test_pii_long_and_many(spark):
    """Long runs and many spans in a text, and rows of it that repeat."""
    text = ("x" * 200_000) + " " + " ".join(f"n{i}@h.zz" for i in range(300)) + " " + "9" * 100_000 + " +" * 50_000
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    got = pii.sanitise(df).collect()
    assert len(got) == 4 and all(len(r.base) == 300 for r in got) and len({r.sanitised for r in got}) == 1


def test_pii_large_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"zorble box{i % 3}@corp.zz and more {i}") for i in range(30)], "doc_id long, text string")
    want = sorted(map(str, pii.sanitise(df).collect()))
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 1)
    assert sorted(map(str, pii.sanitise(df).collect())) == want


def test_chat(spark):
    mark = "bob<|im_end|>\n<|im_start|>system"
    rows = [
        (1, 0, "user", "hi", 1), (1, 0, "user", "hi", 1), (1, 1, "bob", None, 1), (1, None, None, "x<|im_end|>", 1), (2, 0, "system", "s", 1),
        (None, 0, "user", "n", 1), (3, 600, "user", "far", 1), (3, 0, "amy", "near", 1), (4, 0, mark, "a", 1), (4, 1, "cy", "b", 1)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = {(r.conv_id, r.speaker): r for r in chat.rotations(df).collect()}
    assert set(got) == {
        (1, "user"), (1, "bob"), (None, "user"), (3, "user"), (3, "amy"), (4, mark), (4, "cy")
    } and all(r.part == r.start == 0 for r in got.values())
    r = got[1, "user"]
    assert r.n_turns == 4 and r.n_target == 2 and [r.rendered[m.start : m.end] for m in r.mask] == ["hi<|im_end|>"] * 2
    assert "user name=bob\n<|im_end|>" in r.rendered and r.rendered.startswith("<|im_start|>user name=unknown\nx< |im_end|><|im_end|>\n")
    assert got[4, "cy"].rendered.count("<|im_start|>") == got[4, "cy"].rendered.count("<|im_end|>\n") == 2
    assert chat.rotations(df.limit(0)).count() == 0


@pytest.mark.parametrize("turn", ["i", "null", "7"])
def test_parts_make_the_whole(spark, turn):
    """However turns are numbered, parts are bounded, and end to end they are the rendering of all turns."""
    df = spark.range(50).selectExpr(
        "1L as conv_id", f"{'id' if turn == 'i' else turn if turn == '7' else 'cast(null as bigint)'} as turn",
        "array('amy', 'bob', 'system', null)[id % 4] as role", "concat('t', id) as text"
    )
    whole = {r.speaker: r for r in chat.rotations(df, part_turns=100).collect()}
    parts = chat.rotations(df, part_turns=7).collect()
    assert max(r.n_turns for r in parts) == 7 and set(whole) == {"amy", "bob"}
    for who, r in whole.items():
        own = sorted((p for p in parts if p.speaker == who), key=lambda p: p.part)
        assert "".join(p.rendered for p in own) == r.rendered and sum((p.mask for p in own), []) == r.mask
        at = 0
        for p in own:
            assert p.start == at
            at += len(p.rendered)


def test_quality(spark, odd):
    got = {r.doc_id: r for r in quality.ledger(odd).collect()}
    assert got[3].n_words == got[4].n_words == got[5].n_words == 0 and got[3].fail_bits & 1
    assert got[6].n_words == 60_000 and got[6].fail_bits == quality.mask(["digits"]) and got[8].word_chars == 9
    rep = spark.createDataFrame([(1, "a b c x a b c\nl\nl\n\n\nl")], "doc_id long, text string")
    r = quality.ledger(rep).first()
    assert (r.n_repeat_words, r.n_dup_lines, r.n_lines) == (6, 2, 4)
    assert quality.ledger(odd.limit(0)).count() == 0
    loud = spark.createDataFrame([(1, "LOUD WORDS éA"), (2, "a b c d"), (3, "x" * 201 + " y")], "doc_id long, text string")
    r = {x.doc_id: x for x in quality.ledger(loud).collect()}
    assert (r[1].n_upper, r[1].longest_word, r[3].longest_word) == (10, 5, 201) and quality.mask(["few_words", "shouting"]) == r[1].fail_bits
    assert r[2].fail_bits == quality.mask(["few_words", "short_words"]) and r[3].fail_bits & quality.mask(["endless_word"])
    ab = {r.rule: r for r in quality.ablations(quality.ledger(odd), "v1").collect()}
    assert ab["few_words"].failed == 9 and ab["few_words"].failed_alone <= 9 and ab["few_words"].kept_without >= 2


def test_decontamination(spark, odd):
    items = spark.createDataFrame(
        [(1, "A, b c-d e f g h!", 0), (1, "A, b c-d e f g h!", 0), (2, "too short", 0), (3, None, 0), (None, "a b c d e f g h", 0)],
        "item_id long, text string, seed long"
    )
    got = decontamination.matches(odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.equal) for r in got) == [(1, 1, 8), (2, 1, 8)]
    kept = decontamination.decontaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9]
    assert decontamination.matches(odd.limit(0), items).count() == 0 and decontamination.matches(odd, items.limit(0)).count() == 0


def test_short_items(spark):
    """Items of fewer words than a mask spans are found word for word, wherever they stand."""
    items = [(n, " ".join(f"s{n}w{i}" for i in range(n))) for n in range(1, 9)]
    docs, want = [], set()
    for n, t in items:
        docs += [(10 * n, f"before, {t.upper()}! after"), (10 * n + 1, t), (10 * n + 2, " ".join(["x", *t.split()[:-1], "other"])), (10 * n + 3, t + "s")]
        want |= {(10 * n, n), (10 * n + 1, n)}
    want |= {(82, 8), (83, 8)}  # eight words: one may differ
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_decontamination_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (1, "clean"), (None, "x a b c d e f g h"), (None, None)], "doc_id long, text string")
    kept = decontamination.decontaminated(docs, spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string"))
    assert [r.text for r in kept.orderBy("text").collect()] == [None, "clean"]


def test_substitutions(spark):
    item = [f"item{i}" for i in range(30)]
    rng = np.random.default_rng(5)
    rows = []
    for k in range(40):
        w = list(item)
        for i in rng.choice(30, 3, replace=False):
            w[i] = "other"
        rows.append((k, " ".join(["x y z"] * 5 + w + ["tail"] * 9)))
    rows += [(100 + k, " ".join(f"clean{k}w{i}" for i in range(50))) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontamination.matches(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and all(r.equal == 27 for r in got)


def test_toxicity(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert toxicity.score(odd, labels.limit(0)).select("score").distinct().collect()[0][0] == 0.5
    assert toxicity.score(odd.limit(0), labels).count() == 0
    assert toxicity.accepted(odd, labels).columns == odd.columns


def test_restoration(spark):
    docs = spark.createDataFrame([(i, "the stupid idiot and the moron are losers with trash") for i in range(20)], "doc_id long, text string")
    r = toxicity.Restorer(toxicity.character_model(docs))
    for said, want in (
        ("1d10t", "idiot"), ("$tup!d", "stupid"), ("stuuupid", "stupid"), ("iidiot", "idiot"), ("m.o.r.o.n", "moron"), ("t r a s h", "trash"),
        ("a n d", "and"), ("STUPID", "stupid")
    ):
        assert want in r(f"the {said} and"), said


def test_viterbi_equals_brute_force(spark):
    """The decoder finds the cheapest of all ways to read a token."""
    docs = spark.createDataFrame([(1, "so as is all lass sail")], "doc_id long, text string")
    model = toxicity.character_model(docs)
    for token in ("5a1l", "l@5s", "a11", "s a 1 l", "i s a", "l.a.s.s", "****s", "ssaaiill", "12345"):
        paths = [(0.0, "")]
        for i, ch in enumerate(token):
            ways = ([(ch, 0.0)] if ch in toxicity._AT else [(" ", 0.0)] if ch == " " else []) + [
                (x, toxicity.COST_ANY if ch == "*" else toxicity.COST_LEET) for x in toxicity.LEET.get(ch, "")
            ]
            if ch in toxicity.SEPARATORS:
                ways.append(("", toxicity.COST_SEPARATOR))
            elif i and token[i - 1] == ch:
                ways.append(("", toxicity.COST_REPEAT))
            elif ch not in toxicity._AT:
                ways.append(("", toxicity.COST_DROP))
            paths = [(c + w, s + x) for c, s in paths for x, w in ways]

        def cost(c, s):
            codes = [0, 0, *[toxicity._AT.get(x, 0) for x in s], 0]
            return c - sum(float(model[codes[i], codes[i + 1], codes[i + 2]]) for i in range(len(codes) - 2))

        least = min(cost(c, s) for c, s in paths)
        got = toxicity.restore(token, (-model).tolist())
        assert min(cost(c, s) for c, s in paths if s == got) <= least + 1e-6, token


def test_long_tokens(spark):
    model = toxicity.character_model(spark.createDataFrame([(1, "so as is all lass sail")], "doc_id long, text string"))
    assert len(toxicity.restore("s1" * 20_000 + "@$*!" * 500, (-model).tolist())) > 1000


def test_groups_of_near_copies():
    words = [[f"a{i}" for i in range(40)], [f"a{i}" for i in range(1, 41)], [f"b{i}" for i in range(40)], [], [], [f"a{i}" for i in range(38)]]
    assert toxicity.groups([toxicity.signature(w) for w in words]) == [0, 0, 2, 3, 3, 0]


def test_tokens(spark, odd, tmp_path):
    e = tokens.encoder(tokens.vocabulary(tokens.RANKS))
    n = lambda t: len(e.encode_ordinary(t or ""))
    for k, pack in enumerate((1, 40, 1 << 20)):
        got = tokens.count_tokens(odd, str(tmp_path / f"t{k}"), tokens.RANKS, pack_bytes=pack).collect()
        assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((r.doc_id or 0, n(r.text)) for r in odd.collect())
    assert tokens.count_tokens(odd.limit(0), str(tmp_path / "none"), tokens.RANKS).collect() == []
    again = tokens.count_tokens(odd, str(tmp_path / "again"), tokens.RANKS, pack_bytes=40).collect()
    assert sorted(map(str, again)) == sorted(map(str, tokens.count_tokens(odd, str(tmp_path / "more"), tokens.RANKS, pack_bytes=40).collect()))
    by_name = tokens.count_tokens(odd.select("key", "text"), str(tmp_path / "names"), tokens.RANKS, key="key").collect()
    assert {r.key for r in by_name} == {"k"} and len(by_name) == odd.count()


def test_token_files(spark, tmp_path):
    raw = np.array([1, 2, tokens.SEPARATOR, tokens.SEPARATOR, 3, 4, 5], dtype="<u2")
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "f.bin").write_bytes(raw.tobytes())
    (tmp_path / "u" / "empty.bin").write_bytes(b"")
    for block in (1, 2, 3, 100):
        for size in (2, 4, 8, 1 << 20):
            got = sorted(
                (r.doc, r.first, r.n_tokens, r.sealed) for r in tokens.scan_tokens(
                    spark, str(tmp_path / "u"), block_tokens=block, range_bytes=size
                ).collect()
            )
            assert got == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 3, False)], (block, size)


def test_near_duplicates(spark, odd):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd, width=5).collect()}
    assert got >= {(1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (7, 59_997, 6, False), (9, 1, 9, True)}
    assert {c for d, _, c, _ in got if d is None} == {1}
    kept = neardup.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9]
    assert neardup.near_duplicates(odd.limit(0)).count() == 0 and neardup.deduplicated(odd.limit(0)).count() == 0


def test_an_id_with_several_texts(spark):
    """Each text is a document; columns that can't be ordered pass by."""
    a, b = "a b c d e f", "q r s t u v w"
    rows = [(1, a), (1, b), (2, a), (2, b), (3, b), (3, b), (None, a), (5, None), (6, "q r s t u v w x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    kept = neardup.deduplicated(df, percent=60).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, a), (1, a), (1, b), (5, "")] and all(r.m == {1: 2} for r in kept)


def test_large_groups_of_near_copies(spark):
    """A family whose members differ in a few words each, and outliers of it: the components of brute force."""
    from tests.llm.test_queries import near_components

    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    texts = {}
    for k in range(120):
        w = list(base)
        for i in rng.choice(60, int(rng.integers(0, 9)), replace=False):
            w[i] = f"m{int(rng.integers(0, 40))}"
        texts[k] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, width=2).collect()}
    assert got == near_components(texts, 2)


@pytest.mark.parametrize("rows", [1, 8])
def test_lists_in_parts(spark, monkeypatch, rows):
    """Small parts of lists and blocks change nothing."""
    monkeypatch.setattr(neardup, "LIST_ROWS", rows)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 64)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 1)
    test_large_groups_of_near_copies(spark)


def test_warc(spark, tmp_path):
    rows = [
        (1, "http://a/ b\n", "x" * 100_000, 0), (2, None, "x" * 100_000, 0), (3, "u", None, 0), (4, "u", "", 0), (None, "u", "é", 0),
        (5, "u", "é", 0), (6, "u", "WARC/1.1\r\n\r\n\r\n0\r\n\r\n", 0), (7, "u", "q", 0), (7, "u", "q", 0)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, sha long")
    warc.write_archives(df, str(tmp_path / "w"), segment_bytes=700, chunk_bytes=64, pack_bytes=500, rows_per_file=5)
    records = warc.read_records(spark, str(tmp_path / "w"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.catalogue(records).collect())
    assert got == [
        (0, 2, "revisit", 5), (1, 100_000, "response", None), (2, 100_000, "revisit", 1), (3, 0, "response", None), (4, 0, "revisit", 3),
        (5, 2, "response", None), (6, 19, "response", None), (7, 1, "response", None), (7, 1, "response", None)
    ]
    assert {bytes(r.payload) for r in warc.responses(records).collect()} == {b"x" * 100_000, b"", "é".encode(), b"WARC/1.1\r\n\r\n\r\n0\r\n\r\n", b"q"}
    with pytest.raises(Exception, match="segments are missing|bytes of"):
        warc.responses(records.where("segment is null or segment <> 2")).collect()
    warc.write_archives(df.limit(0), str(tmp_path / "e"))
    assert warc.catalogue(warc.read_records(spark, str(tmp_path / "e"))).collect() == []
    assert warc.dechunked(warc.chunked(b"abc" * 50, 7)) == b"abc" * 50


def test_warc_ranges(spark, tmp_path):
    """Large archives are read by byte ranges: each record once, whatever the ranges; other readers can read them too."""
    import gzip

    rng = np.random.default_rng(2)
    rows = [(i, f"http://h/{i}", "".join(map(chr, rng.integers(32, 1000, int(rng.integers(0, 900)))))) for i in range(60)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"), segment_bytes=400)
    want = sorted(map(str, warc.read_records(spark, str(tmp_path / "w")).collect()))
    for size in (100, 1000, 7777):
        assert sorted(map(str, warc.read_records(spark, str(tmp_path / "w"), size).collect())) == want
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*"))
    assert whole.count(b"WARC/1.1\r\n") == len(want)
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.warc").write_bytes(whole)
    assert sorted(map(str, warc.read_records(spark, str(tmp_path / "plain")).collect())) == want


def test_many_equal_payloads(spark, tmp_path):
    df = spark.range(400).selectExpr(
        "id as page_id", "'u' as url", "case when id % 3 > 0 then '' else 'x' end as html"
    ).union(spark.createDataFrame([(7, "u", "")] * 5, "page_id long, url string, html string"))
    warc.write_archives(df, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    got = warc.catalogue(records).collect()
    assert len(got) == 405 and sorted(r.page_id for r in got if r.record_type == "response") == [0, 1]
    assert all(r.refers_to == (0 if r.page_id % 3 == 0 else 1) for r in got if r.record_type == "revisit")
    ids = [r.id for r in records.select("id").collect()]
    assert len(set(ids)) == 405
    warc.write_archives(df, str(tmp_path / "again"))
    assert sorted(ids) == sorted(r.id for r in warc.read_records(spark, str(tmp_path / "again")).select("id").collect())


def test_mixing(spark, odd):
    m = mixing.mix(odd)
    got = mixing.taken(m).collect()
    assert len(got) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(t - n) <= 1 for t, n in by.values())
    assert mixing.mixed_documents(odd, m).columns == odd.columns
    assert mixing.taken(mixing.mix(odd.limit(0))).count() == 0
    assert all((r.first_slot is None) == (r.taken == 0) for r in got)


def test_mixing_of_equal_rows(spark):
    """Repeated rows are taken in their places; equal texts of other sources stay apart."""
    rows = [(1, "a", "w x y z")] * 20 + [(1, "b", "w x y z")] * 5 + [(None, None, "q")] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    m = mixing.mix(df, block_words=3)
    got = mixing.taken(m).collect()
    assert len(got) == 28 and abs(sum(r.taken for r in got) - 1.5 * 103) <= 1
    out = mixing.mixed_documents(df, m).collect()
    n = lambda s: sum(len(r.text.split()) for r in out if r.source == s)
    assert {s: n(s) for s in ("a", "b", None)} == {s: sum(r.taken for r in got if r.source == s) for s in ("a", "b", None)}


def test_schedule_is_even(spark):
    """Each source has its share in every run of the schedule, up to a few slots."""
    rows = [(i, "ab"[i % 2] if i % 6 else "c", "w " * 50) for i in range(600)]
    m = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_words=10)
    slots = sorted((r.slot, r.i) for r in m.slots.collect())
    total = np.bincount([i for _, i in slots]) / len(slots)
    for a in range(0, len(slots) - 400, 400):
        part = np.bincount([i for _, i in slots[a : a + 400]], minlength=3)
        assert np.abs(part - 400 * total).max() <= 8
    assert sorted({r["rank"] for r in m.slots.where("i = 0").collect()}) == list(range(m.slots.where("i = 0").count()))


def test_sharding(spark, odd, tmp_path):
    extra = odd.withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    got = sharding.shards(extra, 16, bucket_bytes=200_000).collect()
    assert len(got) == odd.count() and len({r.shard for r in got}) == odd.count() and {r.slot for r in got} == {0}
    assert sharding.shards(odd.limit(0), 16).count() == 0
    sharding.write_shards(odd, str(tmp_path / "s"), 3, bucket_bytes=1000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [3, 4, 4]
    named = odd.select("doc_id", "text", F.lit(99).alias("shard"), F.lit(77).alias("slot"))
    assert {(r.shard, r.slot) for r in sharding.shards(named, 16).collect()} == {(int(16 * k / 11), 0) for k in range(11)}


@pytest.mark.parametrize("more", [[], ["map(1, doc_id) as m"], ["array(map(1, doc_id)) as m"]])
def test_many_equal_rows(spark, monkeypatch, more):
    """Equal rows are dealt to all buckets, none is lost, and reruns agree."""
    monkeypatch.setattr(sharding, "REPEATED", 50)
    df = spark.createDataFrame(
        [(1, "same")] * 3000 + [(2, "twice")] * 2 + [(i, f"t{i}") for i in range(10, 200)], "doc_id long, text string"
    ).selectExpr("*", *more)
    got = sharding.shards(df, 8, bucket_bytes=1000).collect()
    count = {k: sum(r.doc_id == k for r in got) for k in (1, 2, 10)}
    assert len(got) == 3192 and count == {1: 3000, 2: 2, 10: 1}
    assert sorted((r.shard, r.slot) for r in got) == sorted((8 * k // 3192, k - -(-(8 * k // 3192) * 3192 // 8)) for k in range(3192))
    if not more or "array" not in more[0]:
        x = sharding.ExternalShuffle(df, 17, 1000, "text")
        assert max(r["count"] for r in x.shuffled().where("doc_id = 1").groupBy("_sw_bucket").count().collect()) < 600
    assert sorted(map(str, got)) == sorted(map(str, sharding.shards(df, 8, bucket_bytes=1000).collect()))


def test_every_accepted_pattern_has_a_seed(spark):
    """All ways to change as many words as the rule allows, in items of 8 to 15 words."""
    from itertools import combinations

    items, docs, want = [], [], set()
    for n in range(8, 16):
        item = [f"n{n}w{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        run = min(13, n)
        spare = run - -(-run * 75 // 100)
        for start in range(n - run + 1):
            for bad in combinations(range(start, start + run), spare):
                k = len(docs)
                docs.append((k, " ".join(w if start <= i < start + run and i not in bad else "other" for i, w in enumerate(item))))
                want.add((k, n))
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
