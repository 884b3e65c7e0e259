import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import canon, components, fusion, incremental, leak, mixing, neardup, ocr, residue, truncation
from termloom.llm.keys import gloss_words, khmer_letters, same_term
from termloom.llm.sketch import char_shingles, sketch

SYL = ["ក", "ខា", "គី", "ងូ", "ចេះ", "ឆោ", "ជាន", "ឈូង", "ញិត", "ដើម", "តុប", "ថែក", "ទ្រា", "ន្សៃ", "ប្អូង", "ផ្លើស", "ពៅម", "ភឿន", "មាស", "យើង", "រួច", "ល្មម", "វ៉ាន", "សំ", "ហើយ", "ឡាន", "អាច"]


def word(r, n=6):
    return "".join(r.choice(SYL) for _ in range(n))


# --- canonical form --------------------------------------------------------------------------


@pytest.mark.parametrize(
    "a, b",
    [
        ("ភាព​ល្អ", "ភាពល្អ"), ("ក ខ", "ក ខ"), ("ក  ខ ", "ក ខ"), ("ទี", "ទី"), ("ក̊", "កំ"), ("យេាល", "យោល"), ("យេីល", "យើល"),
        ("ភាព឵", "ភាព"), ("កៀ្រយ", "ក្រៀយ"), ("ស្ដ", "ស្ត"), ("(ＤＡＳ)", "(DAS)"), ("café", "café"), ("(КΟ)", "(KO)"), ("﻿ក", "ក"), ("ស្រ្តី", "ស្ត្រី"), ("ក\r\nខ", "ក\nខ"),
    ],
)
def test_canonical_pairs(a, b):
    assert canon.canonical(a) == canon.canonical(b) == b


def test_canonical_properties():
    r = random.Random(1)
    al = [chr(c) for c in range(0x1780, 0x17DE)] + list("​  ี̊aé\n\r ＡΑ-‐")
    for _ in range(5000):
        t = "".join(r.choice(al) for _ in range(r.randint(0, 12)))
        assert canon.canonical(canon.canonical(t)) == canon.canonical(t), ascii(t)
    assert canon.canonical(None) is None and canon.canonical("") == "" and canon.canonical("​ ") == ""
    long = "ភាព​" * 50_000
    assert canon.canonical(long) == "ភាព" * 50_000


def test_canonical_equivalents_are_equal():
    import unicodedata

    for p in range(0x80, 0x110000):
        c = chr(p)
        d = unicodedata.normalize("NFD", c)
        if d != c:
            assert canon.canonical("x" + c + "y") == canon.canonical("x" + d + "y"), hex(p)
    for a, b in (("か\u3099", "が"), ("\u212b", "Å"), ("\u2126", "Ω"), ("ﬁ", "fi"), ("Ⅳ", "IV"), ("𝐀", "A"), ("ｶ", "カ"), ("q\u0307\u0323", "q\u0323\u0307")):
        assert canon.canonical(a) == canon.canonical(b), (a, b)
    for a, b in (("①", "1"), ("x²", "x2"), ("½", "1/2")):
        assert canon.canonical(a) != canon.canonical(b)


def test_same_looking_pairs(spark):
    rows = [(1, "ភាព​ល្អ", 0), (2, "ភាពល្អ", 0), (3, "ភាពល្អ", 0), (4, None, 0), (5, "", 0), (6, "​", 0), (7, " ", 0), (8, "ភាប", 0)]
    df = spark.createDataFrame(rows, "pos_ord long, khmer string, pos long")
    assert sorted(map(tuple, canon.same_looking_pairs(df, "pos_ord", "khmer").collect())) == [(1, 2), (1, 3)]
    assert canon.same_looking_pairs(df.limit(0), "pos_ord", "khmer").count() == 0


# --- sketches, components, near duplicates ---------------------------------------------------


def test_sketch_estimates_jaccard():
    r = random.Random(2)
    a = [word(r, 12) for _ in range(200)]
    b = [t[: len(t) // 2] + word(r, 3) + t[len(t) // 2 :] for t in a]
    s = [sketch(*char_shingles(x, 3), len(x), 128) for x in (a, b)]
    got = (s[0] == s[1]).mean(axis=1)
    g = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    want = np.array([len(g(x) & g(y)) / len(g(x) | g(y)) for x, y in zip(a, b)])
    assert abs((got - want).mean()) < 0.02 and abs(got - want).max() < 0.25
    assert (sketch(*char_shingles(["", "ab"], 3), 2, 8)[0] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(1, 40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x.id: x.comp for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def lexicon(seed, groups=60):
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        k, e = word(r, 8), f"{r.choice(['lawful', 'arid', 'net', 'open'])} term{word(r, 1)}{g}x{r.randint(100, 999)} code".replace("x", "chrono")
        e = f"{r.choice(['lawful', 'arid', 'net'])} {''.join(r.choice('abcdefghij') for _ in range(10))} permit"
        for _ in range(r.randint(1, 4)):
            i = r.randint(1, len(k) - 2)
            kk = r.choice([k, k, k[:i] + k[i + 1 :], k[:i] + " " + k[i:], k[:i] + "​" + k[i:]])
            rows.append((kk, r.choice([e, e.upper(), "the " + e, e + "s", "", None])))
    rows += [(rows[0][0], rows[0][1])] * 40 + [(None, "x"), ("", ""), ("ក", "ka")]
    r.shuffle(rows)
    return [(i, k, e) for i, (k, e) in enumerate(rows)]


def brute_pairs(rows):
    keys = [(i, khmer_letters(k), gloss_words(e)) for i, k, e in rows]
    return {(a[0], b[0]) for a, b in itertools.combinations(keys, 2) if same_term(a[1], a[2], b[1], b[2])}


def test_near_duplicates_against_brute_force(spark):
    rows = lexicon(4)
    df = spark.createDataFrame([(*x, "z", 0) for x in rows], "pos_ord long, khmer string, english string, source string, pos long")
    g = neardup.TermGroups(df)
    got = {tuple(x) for x in g.row_pairs().collect()}
    want = brute_pairs(rows)
    assert got <= want and len(got) >= 0.99 * len(want)
    groups = {x.pos: x.group_row for x in g.membership().collect()}
    assert all(groups[a] == groups[b] for a, b in got) and all(v <= k for k, v in groups.items())
    assert neardup.TermGroups(df.limit(0)).row_pairs().count() == 0


def test_hot_headword_with_many_glosses(spark):
    # one headword on a third of the rows; glosses differ, some by one letter, some are blank
    r = random.Random(21)
    k = word(r, 8)
    glosses = ["".join(r.choice("abcdefghijklmnop") for _ in range(12)) for _ in range(150)]
    rows = [(k, g) for g in glosses] + [(k[:9] + "ា" + k[9:], g[:5] + "z" + g[6:]) for g in glosses[:60]] + [(k, "")]
    rows += [(word(r, 8), "".join(r.choice("abcdefghijklmnop") for _ in range(12))) for _ in range(400)]
    rows = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, "pos_ord long, khmer string, english string")
    got, want = {tuple(x) for x in neardup.TermGroups(df).row_pairs().collect()}, brute_pairs(rows)
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 250


def test_large_component_is_tested_whole(spark):
    # one headword, a row without a gloss that joins them all, glosses that differ in several letters
    r = random.Random(31)
    k, rows = word(r, 8), []
    for _ in range(60):
        g = "".join(r.choice("abcdefghijklmnop") for _ in range(18))
        i, j = r.randint(1, 6), r.randint(9, 15)
        rows += [(k, g), (k, g[:i] + "z" + g[i + 1 : j] + "y" + g[j + 1 :])]
    rows = [(i, a, b) for i, (a, b) in enumerate([(k, "")] + rows)]
    df = spark.createDataFrame(rows, "pos_ord long, khmer string, english string")
    assert {tuple(x) for x in neardup.TermGroups(df).row_pairs().collect()} == brute_pairs(rows)


def test_every_pair_of_a_bucket_is_compared(spark):
    # pairs of rows alike under one headword, as few bins agree as in the worst of them; with hot buckets too
    r = random.Random(33)
    rows = []
    for k in (word(r, 8), word(r, 7)):
        for _ in range(150):
            g = "".join(r.choice("abcdefghijklmnop") for _ in range(14))
            i, j = r.randint(1, 5), r.randint(8, 12)
            rows += [(k, g), (k, g[:i] + g[i + 1] + g[i] + g[i + 2 : j] + "z" + g[j + 1 :])]
    rows = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(rows, "pos_ord long, khmer string, english string")
    want = brute_pairs(rows)
    pairs = lambda: {tuple(x) for x in neardup.TermGroups(df).row_pairs().collect()}
    assert pairs() == want
    keep, neardup.HOT = neardup.HOT, 20
    try:
        assert pairs() == want
    finally:
        neardup.HOT = keep


def test_pairs_of_buckets_that_span_batches():
    import pandas as pd

    r = np.random.default_rng(36)
    keep, neardup.PAIRS = neardup.PAIRS, 37
    try:
        for most in (None, 0, 5, 17, 1000) * 4:
            d = pd.DataFrame({"key": np.repeat(np.arange(60) * 2, r.integers(1, 30, 60))})
            d = d.assign(pos=np.arange(len(d)), sig=0, sig2=0)
            cuts = [0, *np.sort(r.choice(len(d), 40, replace=False)).tolist(), len(d)]
            out = [x for b in neardup._pairs_inside(most)(iter([d[a:b] for a, b in zip(cuts, cuts[1:])])) for x in b.to_numpy().tolist()]
            by = d.groupby("key")["pos"].agg(list)
            small = [p for p in by if most is None or len(p) <= most]
            assert sorted((a, b) for a, b, hot in out if not hot) == sorted(x for p in small for x in itertools.combinations(p, 2))
            assert sorted((a, b) for a, b, hot in out if hot) == [(k, x) for k, p in by.items() if most is not None and len(p) > most for x in p]
    finally:
        neardup.PAIRS = keep


def test_bounds_exclude_no_true_pair():
    r = random.Random(34)
    rows = [(khmer_letters(k), gloss_words(g)) for _, k, g in lexicon(35, 150)] + [(word(r, 60), "a" * 70), (word(r, 90), "")]
    rows += [(k[:-2], g) for k, g in rows if len(k) > 4]
    sig, sig2 = neardup.bounds([k for k, _ in rows], [g for _, g in rows])
    for i, x in enumerate(rows):
        may = neardup.may_match(sig[i], sig2[i], sig, sig2)
        want = [same_term(*x, *y) for y in rows]
        assert not (np.array(want) & ~may).any()
        got = neardup.same_terms([x[0]] * len(rows), [x[1]] * len(rows), [k for k, _ in rows], [g for _, g in rows])
        assert got.tolist() == want


def test_bounds_tell_unlike_rows_apart():
    # rows of one headword with other glosses, of phrases with other glosses, and without glosses
    r = random.Random(39)
    n = 600
    i, j = np.triu_indices(n, 1)
    g = ["".join(r.choice("eeeettaaooiinnssrrlcdumpgbvh") for _ in range(20)) for _ in range(n)]
    for k, g, most in (([word(r)] * n, g, 0.05), ([word(r, 25) for _ in g], g, 0.05), ([word(r) for _ in g], [""] * n, 0.04)):
        sig, sig2 = neardup.bounds(k, g)
        assert neardup.may_match(sig[i], sig2[i], sig[j], sig2[j]).mean() < most


def test_star_edges_span_batches():
    import pandas as pd

    n = 500
    sig = np.full(n, 0x1111111111111111, np.int64)
    sig[::2] = 0x2222222222222222
    b = pd.DataFrame({"key": np.ones(n, np.int64), "pos": np.arange(n), "sig": sig})
    edges = [tuple(x) for out in neardup._stars(iter([b[:3], b[3:200], b[200:]])) for x in out[["a", "b"]].to_numpy()]
    assert len(edges) == n - 2 and {a for a, _ in edges} == {0, 1}


def test_keys():
    assert gloss_words("Eng. Boundary, the direct protogressions (term)") == gloss_words("direct protogression boundary")
    assert khmer_letters("12. ភាពល្អ", True) == khmer_letters("ភាព ល្អ") and khmer_letters("ក") == "" and khmer_letters(None) == ""


# --- incremental -----------------------------------------------------------------------------


def test_batches_against_brute_force(spark):
    rows = lexicon(5)
    hist, new = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    h = spark.createDataFrame(hist, "pos_ord long, khmer string, english string")
    b = spark.createDataFrame([(10_000 + i, n * 6 // len(new), k, e) for n, (i, k, e) in enumerate(new)], "raw_id long, batch_no int, khmer string, english string")
    got = {x.id for x in incremental.repeated_batches(h, b, "pos_ord", "raw_id", "batch_no").collect()}
    keys = [(-1 - i, khmer_letters(k), gloss_words(e)) for i, k, e in hist]
    want = set()
    for r in b.orderBy("raw_id").collect():
        k = (r.raw_id, khmer_letters(r.khmer, True), gloss_words(r.english))
        if any(same_term(k[1], k[2], x[1], x[2]) for x in keys if x[0] < k[0]):
            want.add(r.raw_id)
        keys.append(k)
    order_bound = {r.raw_id for r in b.collect()}
    assert got <= order_bound and len(got ^ want) <= 0.03 * len(want)
    assert incremental.repeated_batches(h, b.limit(0), "pos_ord", "raw_id", "batch_no").count() == 0


def test_history_is_met_where_it_lies():
    # any stretches of the history give the pairs of the whole, merged with the batch
    import pandas as pd
    from types import SimpleNamespace

    r = np.random.default_rng(38)
    n, cols = 3000, incremental._COLUMNS
    x = pd.DataFrame({"pass": r.integers(0, 2, n).astype(np.int32), "key": r.integers(0, 40, n) << 16, "key2": r.integers(0, 3, n) << 32, "id": np.arange(n)})
    x = x.assign(range=x["pass"], sig=0, sig2=0, fresh=r.random(n) < 0.1)
    whole = x.sort_values(["pass", "range", "key", "key2", "id"])
    fresh = dict(zip(x["id"], x["fresh"]))
    pairs = lambda out: {(min(a, b), max(a, b)) for y in out for a, b in y.to_numpy().tolist()}
    want = {(a, b) for a, b in pairs(incremental._neighbours(iter([whole]))) if fresh[a] != fresh[b]}
    new = incremental._in_order({c: x[x.fresh][c].to_numpy() for c in cols})
    old = whole[~whole.fresh]
    got = pairs(incremental._beside(SimpleNamespace(value=new))(old[i : i + 170] for i in range(0, len(old), 170)))
    assert want <= got and all(fresh[a] != fresh[b] for a, b in got) and len(want) > 1000


def test_history_of_another_form_is_not_read(spark, tmp_path):
    path = f"file://{tmp_path}/history"
    rows = spark.createDataFrame([(1, "ដើមតុប", "tree")], "pos_ord long, khmer string, english string")
    h = incremental.TermHistory(spark, path)
    h.accept(rows, "pos_ord", sign=-1)
    assert incremental.TermHistory(spark, path).check(rows, "pos_ord").collect() == [(1, -1)]
    h.state["form"], h.state["serial"] = None, 99
    h._save()
    with pytest.raises(ValueError):
        incremental.TermHistory(spark, path)


def test_ranges_of_hot_keys():
    bounds = [[5, -(2**63)], [9, -(2**63)], [9, 10], [9, 20], [12, -(2**63)]]
    key, key2 = np.array([1, 5, 8, 9, 9, 9, 9, 11, 12, 99]), np.array([0, 0, 0, -5, 10, 19, 20, 0, 0, 0])
    assert incremental.range_of(bounds, key, key2).tolist() == [0, 1, 1, 2, 3, 3, 4, 4, 5, 5]
    assert incremental.range_of([], key, key2).tolist() == [0] * 10


def test_hot_keys_are_divided_at_their_own_numbers(spark, tmp_path):
    # keys are numbers of 64 bits: a quantile taken as a double is none of them
    r = random.Random(4)
    letters = lambda n: "".join(chr(0x1780 + r.randrange(33)) for _ in range(n))
    head = letters(8)
    rows = [(i, head + letters(6) if i % 2 else letters(14), "".join(r.choice("abcdefgh") for _ in range(9))) for i in range(1000)]
    keep, incremental.RANGE_ROWS = incremental.RANGE_ROWS, 100
    try:
        h = incremental.TermHistory(spark, "file://" + str(tmp_path / "h"))
        h.accept(spark.createDataFrame(rows, "pos_ord long, khmer string, english string"), "pos_ord", sign=-1)
        of = incremental.ANCHORS  # the pass by the whole text
        sizes = [r["count"] for r in spark.read.schema(incremental.ENTRY).parquet(h.state["runs"][0]).where(F.col("pass") == of).groupBy("range").count().collect()]
        assert sum(sizes) == 1000 and max(sizes) <= 200, sizes
    finally:
        incremental.RANGE_ROWS = keep


def test_history_is_reopened_and_pruned(spark, tmp_path):
    r = random.Random(22)
    keep, incremental.RANGE_ROWS = incremental.RANGE_ROWS, 100
    assert incremental.FEW_PARTS < 12  # the twelve ranges here are asked for
    try:
        make = lambda n, at: [(at + i, word(r, 7), "".join(r.choice("abcdefgh") for _ in range(9))) for i in range(n)]
        old = make(1200, 1)
        path = "file://" + str(tmp_path / "h")
        h = incremental.TermHistory(spark, path)
        cols = "raw_id long, khmer string, english string"
        h.accept(spark.createDataFrame(old, cols), "raw_id", sign=-1)
        new = [(5000 + i, k, g) for i, (_, k, g) in enumerate(old[:3])] + make(2, 5100)
        again = incremental.TermHistory(spark, path)  # another session
        got = {x.id: x.partner for x in again.check(spark.createDataFrame(new, cols), "raw_id").collect()}
        assert got == {5000: -1, 5001: -2, 5002: -3}
        # only the ranges that the batch touches are read
        e = again._entries(spark.createDataFrame([(x[0], x[1], x[2]) for x in new[:1]], "id long, kkey string, gkey string"))
        part = again._read(again.state["runs"][:1], incremental.ENTRY, ["pass", "range"], e.select("pass", "range"))
        assert part.count() < 0.3 * spark.read.schema(incremental.ENTRY).parquet(again.state["runs"][0]).count()
        assert "PartitionFilters: [" in part._jdf.queryExecution().toString()
        for i in range(6):  # compaction loses nothing
            again.check(spark.createDataFrame(make(5, 6000 + 10 * i), cols), "raw_id")
        assert len(again.state["runs"]) <= incremental.COMPACT_EVERY
        last = incremental.TermHistory(spark, path).check(spark.createDataFrame([(9000, old[700][1], old[700][2]), (9001, new[3][1], new[3][2])], cols), "raw_id")
        assert {x.id: x.partner for x in last.collect()} == {9000: -701, 9001: 5100}
    finally:
        incremental.RANGE_ROWS = keep


def test_small_runs_are_one_file_each(spark, tmp_path):
    # a read of the history opens no file for each range of every batch; large runs still stand by range
    r = random.Random(40)
    keep = incremental.RANGE_ROWS, incremental.SEND_MAX
    incremental.RANGE_ROWS = 100
    cols = "raw_id long, khmer string, english string"
    make = lambda n, at: [(at + i, word(r, 7), "".join(r.choice("abcdefgh") for _ in range(9))) for i in range(n)]
    old, new = make(300, 1), make(60, 1000)
    files = lambda p: len(list((tmp_path / p[len(f"file://{tmp_path}/") :]).rglob("*.parquet")))
    try:
        for most, path in ((keep[1], f"file://{tmp_path}/a"), (100, f"file://{tmp_path}/b")):
            incremental.SEND_MAX = most
            h = incremental.TermHistory(spark, path)
            h.accept(spark.createDataFrame(old, cols), "raw_id", sign=-1)
            for i in range(6):
                h.check(spark.createDataFrame(new[10 * i : 10 * i + 10], cols), "raw_id")
            n = [files(p) for p in h.state["runs"]]
            assert n[0] >= 2 * incremental.PASSES and n[2:] == [1, 1] and (n[1] == 1) == (most > 100), n
            last = h.check(spark.createDataFrame([(9000 + i, *x[1:]) for i, x in enumerate(old[::50] + new[::7])], cols), "raw_id")
            want = [-x[0] for x in old[::50]] + [x[0] for x in new[::7]]
            assert {x.id: x.partner for x in last.collect()} == {9000 + i: p for i, p in enumerate(want)}
    finally:
        incremental.RANGE_ROWS, incremental.SEND_MAX = keep


# --- truncation ------------------------------------------------------------------------------


def test_limits_are_found(spark):
    r = random.Random(6)
    rows, cut = [], set()
    for i in range(6000):
        src = ["free", "chars", "bytes"][i % 3]
        t = " ".join(word(r, 2) for _ in range(r.choice([2, 2, 2, 9, 12])))
        t += "។" if len(t) > 60 else ""
        full = t
        if src == "chars":
            t = t[:64]
        if src == "bytes":
            t = t.encode()[:150].decode("utf-8", "ignore")
        if t != full:
            cut.add(i)
        rows.append((i, src, t))
    rows += [(9001, "free", None), (9002, None, "ភាព"), (9003, "free", ""), (9004, "free", "ភាពល្អ (ab"), (9005, "free", "ភាពល្អ�")]
    c = truncation.CutValues(spark.createDataFrame(rows, "pos_ord long, source string, khmer string"))
    s = {x.source: x for x in c.by_source().collect()}
    assert s["chars"].limit_length == 64 and s["bytes"].limit_length in (148, 149, 150) and s["free"].limit_length is None
    got = {x.pos for x in c.cut_rows().collect()}
    assert {9004, 9005} <= got and not got & {9001, 9002, 9003}
    got -= {9004, 9005}
    assert len(got & cut) >= 0.95 * len(cut) and len(got - cut) <= 0.02 * len(cut)


def test_censored_fit():
    r = np.random.default_rng(1)
    x = np.round(np.exp(r.normal(3.5, 0.4, 5000))).astype(int)
    v, n = np.unique(np.minimum(x, 40), return_counts=True)
    comps = truncation.fit_lengths(v, n, 40, [(0.5, 3.0, 0.5), (0.5, 3.6, 0.4)], 200)
    mean = sum(w * m for w, m, _ in comps)
    assert abs(mean - 3.5) < 0.1


def test_empty_table(spark):
    e = spark.createDataFrame([], "pos_ord long, source string, khmer string, definition string")
    assert truncation.CutValues(e).cut_rows().count() == 0
    assert ocr.ScannedText(e).found().count() == 0


# --- scanned text ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, damaged",
    [
        ("ភាព-\nល្អ។", True), ("ភាព­\nល្អ", True), ("ភាព- ល្អ", True), ("ភាពល្អ\n- 18 -", True), ("ទំព័រ ៣\nភាពល្អ", True), ("ចំណងជើង ២០០៨   |   ៦\nភាពល្អ", True),
        ("ភា8ពល្អ", True), ("The chronoca1orium", True), ("ភាពល្អ។\nភាពថ្មី។", False), ("ភាពល្អ (façade) ៣៤៥។", False), ("In 1996 the board printed 3 entries.", False), ("ភាពល្អ(EPT)។", False), ("", False),
    ],
)
def test_damage(text, damaged):
    assert (ocr.layout_damage(text) or ocr.misread(text)) == damaged


def test_rejoin_and_repair(spark):
    assert ocr.rejoin("ភាព-\r\nល្អ។\n- 12 -\nថ្មី។") == "ភាពល្អ។ ថ្មី។"
    assert ocr.rejoin("ភា\nទំព័រ ៨៦\nពល្អ។") == "ភាពល្អ។" and ocr.rejoin("One.\nTwo.") == "One.\nTwo."
    good = "the lateral channel register covers further cases"
    rows = [(i, None, good) for i in range(20)] + [(50, None, "the 1ateral channe1 covers"), (51, None, "the lateral channcl register"), (52, None, None), (53, "ភាពល្អ", "ok")]
    t = ocr.ScannedText(spark.createDataFrame(rows, "pos_ord long, khmer string, definition string"))
    assert {(r.pos, r.field_name) for r in t.found().collect()} == {(50, "definition"), (51, "definition")}
    fixed = {r.pos: r.repaired for r in t.repaired().collect()}
    assert fixed == {50: "the lateral channel covers", 51: "the lateral channel register"}


def test_weighted_distance():
    assert ocr.weighted_distance("auc1it", "audit") == pytest.approx(0.2) and ocr.weighted_distance("abc", "abc") == 0
    assert ocr.weighted_distance("tcrm", "term") == pytest.approx(0.2) and ocr.weighted_distance("kitten", "sitting") >= 2


# --- fusion ----------------------------------------------------------------------------------


def test_survivors(spark):
    cols = "pos_ord long, definition string, year string, source string, pos long"
    rows = [
        (1, "One whole sentence.", "2010", "a", 0), (2, "One whole sentence. And ano", "20l9", "b", 0), (3, "One whole sentence. Another.", "២០១៥", "c", 0), (4, "One whole sentence. Another.", "2015", "c", 0),
        (5, "The 1ine is broken and longer than all the others here.", "1850", "zz", 0), (10, None, "", "b", 0), (11, "", None, None, 0),
    ]
    m = spark.createDataFrame([(i, 1) for i in range(1, 6)] + [(10, 10), (11, 10)], "pos long, group_row long")
    reg = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "source string, trust_rank int")
    got = {(r.group_row, r.field_name): r.best_row for r in fusion.survivors(spark.createDataFrame(rows, cols), m, reg).collect()}
    assert got == {(1, "definition"): 3, (1, "year"): 3, (1, "source"): 3, (10, "source"): 10}


def test_copied_votes_count_less(spark):
    r = random.Random(7)
    rows = []
    for g in range(120):
        true = g % 4 != 0
        bad = f"wrong{g}"
        for s in ("x", "y"):  # y copies x, mistakes too
            rows.append((g, "f", g, s, "right" if true else bad, 1, 3.0))
        for s in ("p", "q", "w"):
            rows.append((g, "f", g, s, "right" if r.random() < 0.9 else f"{s}{g}", 1, 3.0))
    df = spark.createDataFrame(rows, "group_row long, field_name string, pos long, source string, value string, score int, evidence double")
    post, acc, dep = fusion.fuse(df)
    p = {(min(d.source, d.t), max(d.source, d.t)): d.p_copy for d in dep.collect()}
    assert p[("x", "y")] > 0.9 and max(v for k, v in p.items() if k != ("x", "y")) < 0.5
    a = {x.source: x.a for x in acc.collect()}
    assert a["p"] > a["x"]


def test_votes_decide_what_is_credible(spark):
    # x and y copy one another, mistakes too; p, q and w are independent
    rows, members, n = [], [], 0
    for g in range(60):
        cases = {"x": f"Text {g}.", "y": f"Text {g}.", "p": f"Text {g}.", "q": f"Text {g}.", "w": f"Text {g}."}
        if g < 12:
            cases |= {"x": f"Wrong {g} and cu", "y": f"Wrong {g} and cu"}
        if g == 50:
            cases |= {"x": "A long text that two copies give without an end", "y": "A long text that two copies give without an end"}
        if g == 51:
            cases |= {"p": "A long text that two others give without an end", "q": "A long text that two others give without an end"}
        for s, t in cases.items():
            rows.append((n, t, "2010", s))
            members.append((n, g * 5))
            n += 1
    df = spark.createDataFrame(rows, "pos_ord long, definition string, year string, source string")
    m = spark.createDataFrame(members, "pos long, group_row long")
    reg = spark.createDataFrame([], "source string, trust_rank int")
    best = lambda: {r.group_row: rows[r.best_row][1] for r in fusion.survivors(df, m, reg).where("field_name = 'definition'").collect()}
    got = best()
    assert got[51 * 5].startswith("A long") and not got[50 * 5].startswith("A long")
    keep, fusion.COPY_RATE = fusion.COPY_RATE, 0.0
    try:
        assert best()[50 * 5].startswith("A long")  # without copy detection the copied votes are believed
    finally:
        fusion.COPY_RATE = keep


# --- leaks -----------------------------------------------------------------------------------


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(n))


def test_leaks(spark):
    r = random.Random(8)
    stock = "Give the official rendering of the marked term and nothing else."
    items = [(i, f"{stock} {prose(r, 45)}.") for i in range(20)] + [(98, ""), (99, None), (30, "Qzx vbn mkl!"), (31, f"{stock} {prose(r, 2)}"), (32, "Short one of twenty-nine letters")]
    items += [(40, items[0][1])]  # the same item again
    body = dict(items)
    half = body[3][: len(body[3]) * 7 // 10]
    docs = [
        (1, prose(r, 200) + " " + body[0].upper().replace(" ", "\n ") + prose(r, 300)),
        (2, prose(r, 50) + half + prose(r, 50)),
        (3, prose(r, 50) + body[5][:90] + prose(r, 90)),
        (4, stock + " " + prose(r, 80)),
        (5, " ".join("changed" if n % 12 == 5 else w for n, w in enumerate(body[7].split()))),
        (6, None), (7, ""), (8, body[0]), (9, body[0]), (10, "so QZX-vbn MKL. " + prose(r, 9)), (11, prose(r, 9) + " short one of twenty " + prose(r, 9)),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 0), (2, 3), (5, 7), (8, 0), (9, 0), (1, 40), (8, 40), (9, 40), (10, 30), (11, 32)}
    assert {(x.doc_id, x.item_id) for x in leak.leaks(d, i).collect()} == want
    keep, leak.BROADCAST_MAX = leak.BROADCAST_MAX, 0
    try:
        assert {(x.doc_id, x.item_id) for x in leak.leaks(d, i).collect()} == want
    finally:
        leak.BROADCAST_MAX = keep
    assert leak.leaks(d.limit(0), i).count() == 0


def test_passage_that_several_items_share(spark):
    # a passage in the middle of four items counts; the instruction that opens them does not
    r = random.Random(37)
    stock, passage = "Give the official rendering of the marked term and nothing else.", prose(r, 50)
    items = [(i, f"{stock} {prose(r, 8)} {passage} {prose(r, 6)}") for i in range(4)] + [(9, f"{stock} {prose(r, 3)}")]
    docs = [(1, prose(r, 40) + " " + passage + " " + prose(r, 40)), (2, prose(r, 40) + " " + stock + " " + prose(r, 40)), (3, items[4][1])]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 0), (1, 1), (1, 2), (1, 3), (3, 9)}
    assert {(x.doc_id, x.item_id) for x in leak.leaks(d, i).collect()} == want
    keep, leak.BROADCAST_MAX = leak.BROADCAST_MAX, 0
    try:
        assert {(x.doc_id, x.item_id) for x in leak.leaks(d, i).collect()} == want
    finally:
        leak.BROADCAST_MAX = keep


def test_winnowing_guarantee():
    r = random.Random(9)
    for _ in range(100):
        shared = "".join(r.choice("abcdef") for _ in range(leak.GRAM + leak.WINDOW - 1))
        a, b = (leak.squash(prose(r, 10)) + shared + leak.squash(prose(r, 10)) for _ in range(2))
        x, y = (set(leak.fingerprints([t])[1].tolist()) for t in (a, b))
        assert x & y


# --- mixing ----------------------------------------------------------------------------------


def test_blend(spark):
    r = random.Random(10)
    docs = [(i, ["a", "b", "c", "d"][i % 4], prose(r, r.randint(20, 120))) for i in range(1200)] + [(5000, "a", None), (5001, "a", ""), (5002, None, "x")]
    docs += [(6000 + i, "b", docs[1][2]) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.2, 1), ("none", None, 2)], "source string, target_share double, max_repeats int")
    b = mixing.Blend(df, t)
    s = {x.source: x for x in b.shares().collect()}
    for k, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(s[k].actual_share - share) < 0.003 and s[k].most_uses <= s[k].max_repeats
    assert s["none"].tokens == 0
    rows = b.rows.collect()
    used = Counter((x.doc_id, x["pass"], i) for x in rows for i in range(x.from_token, x.from_token + x.tokens))
    assert max(used.values()) == 1  # every token once a pass
    assert not ({6000 + i for i in range(5)} | {5000, 5001, 5002}) & {k[0] for k in used}
    by_slot = Counter()
    for x in rows:
        by_slot[x.slot] += x.tokens
    assert set(by_slot.values()) == {b.block} and len(by_slot) == b.n_slots
    # the schedule decides: any stretch of the blend is close to the targets
    first = Counter(x.source for x in rows if x.slot < b.n_slots // 8)
    assert abs(first["a"] / sum(first.values()) - 0.5) < 0.05
    # more than the shares allow: what runs out falls short, the rest keep their proportions
    big = {x.source: x for x in mixing.Blend(df, t, total_tokens=10**9).shares().collect()}
    assert all(big[k].most_uses <= big[k].max_repeats for k in "abc") and sum(x.tokens for x in big.values()) > 1.1 * sum(x.tokens for x in s.values())
    assert mixing.Blend(df.limit(0), t).rows.count() == 0


def test_allocation():
    got = mixing.allocation(np.array([0.5, 0.3, 0.2, 0.0]), np.array([10.0, 100.0, 100.0, 5.0]), 60)
    assert got.tolist() == [10, 30, 20, 0]


# --- residue ---------------------------------------------------------------------------------


@pytest.mark.parametrize("t", ["a {{ name }} b", "x ${entry.khmer} y", "##GLOSS_EN##", "__TITLE__", "[[DEFINITION]]", "<insert headword here>", "%(date)s", "[term à compléter]", "{% if x %}", "@@USER@@", "{title}"])
def test_placeholders(t):
    assert residue.PLACEHOLDER.search(t)


@pytest.mark.parametrize("t", ["the slot marked [name] by hand", "a pair such as {x, y, z}", "given as $5 or 7% and footnotes as [3]", "a < b > c", "snake_case words"])
def test_no_placeholders(t):
    assert not residue.PLACEHOLDER.search(t)


def test_residue(spark):
    r = random.Random(11)
    vocab = [prose(r, 1) for _ in range(150)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n)) + "."
    mention = "The handbook explains what a server error is and which term replaced the loan. "
    docs = [(i, f"host{i % 3}-notes", (mention if i % 5 == 0 else "") + text(120)) for i in range(200)]
    docs += [(300 + i, "host1-notes", text(12)) for i in range(20)] + [(400, "host1-notes", mention + text(10))]
    bad = {
        500: "Error 504: Gateway timed out while waiting.", 501: "Please enable JavaScript to view this page.\nHome | Search", 502: "test " * 200, 503: text(60) + " {{ name }} " + text(30),
        504: "404\nNot Found. The page you asked for is not here.", 505: "lorem ipsum rigidis phosphat nominis dolor jectis urbus grav",
    }
    docs += [(k, "host2-notes", v) for k, v in bad.items()] + [(600, None, None), (601, "x", ""), (602, "x", " ")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    assert {x.doc_id for x in residue.Residue(df).found().collect()} == set(bad)
    assert residue.Residue(df.limit(0)).found().count() == 0


def known_shares(spark, docs):
    rows = residue.Residue(spark.createDataFrame(docs, "doc_id long, source string, text string")).scores.select("id", "known_share").collect()
    return {x.id: x.known_share for x in rows}


def test_residue_known_grams_are_a_rate(spark):
    r = random.Random(12)
    vocab = [prose(r, 1) for _ in range(150)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n)) + "."
    page = "Error 502: bad gateway. The upstream server refused the request, try again. "
    long_page = page + " ".join(f"Session {prose(r, 3)} expired, please sign in." for _ in range(12))
    docs = [(i, "host1-notes", text(80)) for i in range(7000)]
    rare = "quibz wevox jyndar plukth"  # three of 7,000 documents
    docs += [(8000 + i, "host1-notes", f"{text(60)} {rare} {text(20)}") for i in range(3)]
    docs += [(8100, "host1-notes", f"{text(60)} {'fjorx gwelm vazzik ' * 4} {text(20)}")]  # one document, again and again
    docs += [(8200 + i, "host2-notes", long_page) for i in range(6)]  # one page, fetched six times
    docs += [(9000, "host2-notes", rare), (9001, "host2-notes", "fjorx gwelm vazzik"), (9002, "host2-notes", page), (9003, "host2-notes", text(12))]
    got = known_shares(spark, docs)
    assert got[9000] < 0.2 and got[9001] < 0.2 and got[9002] < 0.2 and got[9003] > 0.9


def test_residue_of_any_length(spark):
    r = random.Random(13)
    vocab = [prose(r, 1) for _ in range(150)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n)) + "."
    mention = "The handbook explains what a server error is and which term replaced the loan. "
    docs = [(i, f"host{i % 3}-notes", (mention if i % 5 == 0 else "") + text(30 + i)) for i in range(200)]
    trace = "Error 500: the server could not complete the request.\n" + "\n".join(f"  at org.{prose(r, 1)}.{prose(r, 1)}(Main.java:{n})" for n in range(40))
    cookies = "Home | Search | Help\n" + prose(r, 30) + ".\nThis site uses cookies. Enable cookies in your browser to log in and try again.\n" + prose(r, 60)
    lorem = "Annual bulletin of terms\nLorem ipsum " + prose(r, 100)
    other = prose(r, 120)  # filler in other words
    bad = {500: trace, 501: cookies, 502: lorem, 503: other}
    docs += [(k, "host2-notes", v) for k, v in bad.items()]
    assert all(residue.letters_of(v) >= 450 for v in bad.values())
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    assert {x.doc_id for x in residue.Residue(df).found().collect()} == set(bad)


def test_misreading_that_recurs(spark):
    good = "the lateral channel register covers further cases"
    rows = [(i, None, good) for i in range(200)] + [(1000 + i, None, "the lateral channcl register") for i in range(5)]
    t = ocr.ScannedText(spark.createDataFrame(rows, "pos_ord long, khmer string, definition string"))
    assert {r.pos for r in t.found().collect()} == {1000 + i for i in range(5)}
    assert {r.repaired for r in t.repaired().collect()} == {"the lateral channel register"}


def test_index_decides_what_is_misread(spark):
    good = "the lateral channel register covers further cases"
    r = random.Random(14)
    rows = [(i, None, good) for i in range(60)]
    rows += [(100 + i, None, "the mp3x register covers cases") for i in range(20)]  # odd, but the corpus attests it
    rows += [(200, None, "the 1ateral channe1"), (201, None, "the lateral channcl register"), (202, None, "channcl")]
    khmer = [word(r, 9) for _ in range(12)]
    rows += [(300 + i, k + "។", None) for i, k in enumerate(khmer * 3)]
    broken = khmer[0][:10] + "§" + khmer[0][11:]
    rows += [(400, broken + "។", None), (401, "x" * 60 + " " + khmer[1] * 40, None)]
    df = spark.createDataFrame(rows, "pos_ord long, khmer string, definition string")
    t = ocr.ScannedText(df)
    assert {(x.pos, x.field_name) for x in t.found().collect()} == {(200, "definition"), (201, "definition"), (202, "definition"), (400, "khmer")}
    fixed = {x.pos: x.repaired for x in t.repaired().collect()}
    assert fixed[400] == khmer[0] + "។" and fixed[200] == "the lateral channel" and fixed[201] == "the lateral channel register"
    keep, ocr.CHEAP = ocr.CHEAP, -1.0  # no candidate of the index is near enough
    try:
        assert {x.pos for x in ocr.ScannedText(df).found().collect()} == {200, 400}
    finally:
        ocr.CHEAP = keep
    keep, ocr.SEND_KEYS = ocr.SEND_KEYS, -1  # the joined path
    try:
        assert {x.pos: x.repaired for x in ocr.ScannedText(df).repaired().collect()} == fixed
    finally:
        ocr.SEND_KEYS = keep
