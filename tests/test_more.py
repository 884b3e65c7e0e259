import hashlib

import pytest
from pyspark.sql import functions as F

from termloom.operators import lexicon, matching, quality, search, similarity
from termloom.streaming import limiter


def test_dense_number_and_first_wins(spark):
    df = spark.createDataFrame([(i * 37 % 1009, i % 7) for i in range(1009)], "pos long, k long")
    got = sorted((r.pos, r.n) for r in lexicon.dense_number(df, "pos", chunk=100).collect())
    assert got == [(i, i + 1) for i in range(1009)]
    want = {}
    for p, k in sorted((r.pos, r.k) for r in df.collect()):
        want.setdefault(k, p)
    assert {r.k: r.pos for r in lexicon.first_wins(df, F.col("k"), "pos").collect()} == want
    ids = {r.pos: r.id for r in lexicon.with_ids(df.limit(3).withColumn("id", F.lit("")), "pos", start=9999).collect()}
    assert sorted(ids.values()) == ["official_lex_10000", "official_lex_10001", "official_lex_9999"]


def test_tidy(spark):
    cols = "raw_id long, english string, khmer string, french string, pos string, definition string, examples string, item string, needs_review string"
    rows = [(1, "Personal\n Area", "៣១- កំ- ណេត", "ភាព", "", "", "", None, None), (2, "", "", "", "", "", "", "", None), (3, "x", None, "", "", "d", "", "7", None)]
    got = {r.raw_id: r for r in lexicon.tidy_extracted(spark.createDataFrame(rows, cols)).collect()}
    assert set(got) == {1, 3}
    assert (got[1].english, got[1].khmer, got[1].french, got[1].item) == ("Personal Area", "កំណេត", "", "៣១")
    assert got[3].needs_review and got[3].item == "7"


def test_recover_and_pending(spark):
    a = spark.createDataFrame([(1, "ក", "One")], "pos long, khmer string, english string")
    b = spark.createDataFrame([(2, " ក", "one "), (3, "ខ", "two"), (4, "ខ", "TWO")], "pos long, khmer string, english string")
    once = lexicon.recover_pages(a, b, "pos")
    assert sorted(r.pos for r in once.collect()) == [1, 3]
    assert lexicon.recover_pages(once, b, "pos").count() == 2
    assert lexicon.pending(b, a.withColumn("pos", F.lit(2)), ["pos"]).count() == 2
    with pytest.raises(ValueError):
        lexicon.shrink_guard(a, 10)


def test_spans_and_edges(spark):
    s = spark.createDataFrame([(1, 0, 4, "match"), (1, 2, 6, "loan"), (1, 6, 8, "dirt")], "doc_id long, start long, end long, kind string")
    assert [r.kind for r in matching.highlight_spans(s).orderBy("start").collect()] == ["match", "dirt"]
    d = spark.createDataFrame([(1, "abxcd"), (2, "")], "doc_id long, text string")
    e = {r.doc_id: (sorted(r.starts), sorted(r.ends)) for r in matching.dictionary_edges(d, spark.createDataFrame([("ab",), ("cd",)], "w string")).collect()}
    assert e == {1: ([0, 3, 5], [0, 2, 5]), 2: ([0], [0])}


def test_files(spark):
    reg = spark.createDataFrame([("a", "a.pdf", hashlib.sha256(b"xy").hexdigest(), 2), ("b", "b.pdf", "00", 2), ("c", "c.pdf", "", 1), ("d", "d.pdf", "", 9)], "source string, file_name string, sha256 string, bytes long")
    files = spark.createDataFrame([("file:/x/a.pdf", 2, bytearray(b"xy")), ("file:/x/b.pdf", 2, bytearray(b"zz")), ("file:/x/d.pdf", 1, bytearray(b"z"))], "path string, length long, content binary")
    assert {r.source: r.verdict for r in quality.verify_files(reg, files).collect()} == {"a": "ok", "b": "hash differs", "c": "missing", "d": "size differs"}


def test_suspects(spark):
    words = spark.createDataFrame([("កម្មករ",), ("ភាសា",)], "word string")
    e = spark.createDataFrame([(1, "កម្មគរ"), (2, "ភាសា"), (3, "ភាស"), (4, None)], "pos_ord long, khmer string")
    c = spark.createDataFrame([("ក", "គ", 9)], "from_char string, to_char string, count int")
    got = {r.pos_ord: (r.word, r.weight) for r in similarity.suspects(e, words, "pos_ord", c).collect()}
    assert got[1] == ("កម្មករ", 9) and 2 not in got


def test_calls_and_misses(spark):
    e = spark.createDataFrame([(i, "code %d" % i, "ក", "", "", "s", "c") for i in range(150)], "pos_ord long, english string, khmer string, french string, definition string, source string, category string")
    assert search.search_call(e, "code", limit=0).count() == 40 and search.search_call(e, "code", limit=500).count() == 100 and search.search_call(e, "code", limit=-5).count() == 1
    with pytest.raises(ValueError):
        search.browse_call(e)
    q = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), ("b",), (None,)], "q string")
    assert [(r.query, r.n) for r in limiter.top_misses(q, "q", 2).collect()] == [("a", 2), ("b", 2)]
