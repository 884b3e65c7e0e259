import itertools
from collections import deque

import pytest
from pyspark.sql import functions as F

from termloom.functions import text as X
from termloom.operators import classify, estimate, lexicon, matching, quality, search, similarity
from termloom.sources import io
from termloom.streaming import limiter

LEX = "pos_ord long, id string, english string, khmer string, french string, pos string, category string, definition string, examples string, source string, author string, version string, year string"


def lex(spark, rows):
    out = [(i, f"official_lex_{i:04d}", e, k, "", "", "c", "", "", s, "a", "1", "2010") for i, (k, e, s) in enumerate(rows, 1)]
    return spark.createDataFrame(out, LEX)


def brute(text, terms):
    return sorted((t, i, i + len(t)) for t in terms for i in range(len(text)) if t and text.startswith(t, i))


def test_occurrences_against_brute_force(spark):
    texts = ["abcabcab", "", None, "zzz", "aab😀ab" * 3]
    terms = ["ab", "abc", "bca", "c", "z", "", "b😀a", "a" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in terms + ["ab"]], "term string")
    got = matching.occurrences(docs, t).collect()
    for i, x in enumerate(texts):
        assert sorted((r.term, r.start, r.end) for r in got if r.doc_id == i) == brute(x or "", set(terms))
    assert matching.automaton_size(t.where("term <> ''")).first()[0] == len({x[:n] for x in terms for n in range(1, len(x) + 1)}) + 1


def test_longest_matches(spark):
    hits = spark.createDataFrame([(1, "ab", 0, 2), (1, "abc", 0, 3), (1, "cdefg", 2, 7), (1, "x", 8, 9), (1, "de", 3, 5)], "doc_id long, term string, start long, end long")
    assert sorted(r.term for r in matching.longest_matches(hits).collect()) == ["cdefg", "x"]


def test_check_keeps_the_count(spark):
    entries = lex(spark, [("កម្មករ", "worker", "s"), ("ការងារ", "work", "s"), ("ភាព", "state", "s")])
    docs = spark.createDataFrame([(1, "កម្មករធ្វើការងារ worker"), (2, "")], "doc_id long, text string")
    c = matching.check_drafts(docs, entries)
    assert {r.term for r in c["matches"].collect()} == {"កម្មករ", "ការងារ"}
    assert c["counters"].where("raw <> matches + rejected + merged or merged < 0").count() == 0
    assert c["loanwords"].count() == 0  # the Khmer term is there
    d2 = spark.createDataFrame([(1, "the worker's Work, homework")], "doc_id long, text string")
    got = matching.loanwords(d2, matching.english_terms(entries)).collect()
    assert sorted((r.term, r.suggest) for r in got) == [("Work", "ការងារ"), ("worker", "កម្មករ")]


def test_search(spark):
    e = lex(spark, [("ទិន្នន័យ", "data", "s"), ("ទិន្នន័យធំ", "big data", "s"), ("ផ្ទះ", "house", "t")])
    assert [r.id[-1] for r in search.search(e, "data").orderBy("rank").collect()] == ["1", "2"]
    assert [r.id[-1] for r in search.search(e, "ទិន្នន័យ").orderBy("rank").collect()] == ["1", "2"]
    assert [r.tier for r in search.search(e, "tinnay").orderBy("rank").collect()][0] == 3
    assert search.search(e, "").count() == 0 and search.search(e, "", "c").count() == 3
    q = spark.createDataFrame([("ផ្ទា",), ("house",)], "query string")
    assert [r.khmer for r in search.did_you_mean(e, q).collect()] == ["ផ្ទះ"]
    with pytest.raises(ValueError):
        search.search_call(e, "", "")


def test_near_forms_against_brute_force(spark):
    words = ["abcd", "abce", "abc", "xbcd", "bcda", "q", "r", "abdc", "qr", "q" * 3, "ក", "ខ", "កខ", "", None]
    df = spark.createDataFrame([(w,) for w in words], "form string")

    def d1(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    want = {(a, b) for a, b in itertools.combinations(sorted(w for w in words if w), 2) if d1(a, b)}
    assert {tuple(r) for r in similarity.near_forms(df).collect()} == want
    got = {(r.a, r.b): r.reason for r in similarity.classify_pairs(similarity.near_forms(df)).collect()}
    assert got[("abcd", "abce")] == "substitution" and got[("abc", "abcd")] == "one character added or dropped"


def test_worklist_and_compounds(spark):
    words = spark.createDataFrame([("បណ្ដឹង",), ("ស្ត្រី",), ("កម្មករ",)], "word string")
    e = spark.createDataFrame([(1, "បណ្តឹងស្ត្រី"), (2, "ស្ត្រី"), (3, "ក្តាម"), (4, "កម្មករកម្មករ"), (5, None)], "pos_ord long, khmer string")
    w = {r.pos_ord: r for r in similarity.subscript_worklist(e, words, "pos_ord").collect()}
    assert (w[1].verdict, w[1].suggested) == ("differs", "បណ្ដឹងស្ត្រី") and w[2].verdict == "ok" and w[3].verdict == "unknown"
    assert [r[0] for r in similarity.compounds(e, words, "pos_ord").collect()] == [4]


def test_merge(spark):
    old = lex(spark, [("ខ្មែរ", "one", "kept"), ("ភាសា", "two", "kept"), ("ចាស់", "stale", "new")])
    cols = "raw_id long, id string, khmer string, english string, french string, pos string, category string, definition string, examples string, source string, author string, version string, year string, page int"
    row = lambda i, k, e, p=1: (i, "", k, e, "", "", "", "", "", "new", "", "", "", p)
    staged = spark.createDataFrame([row(1, "ខ្មែរ", "ONE"), row(2, "៣១- ពាក្យ", "word"), row(3, "ពាក្យ", "word"), row(4, "", ""), row(5, "ទំព័រ", "page", 9)], cols)
    ex = spark.createDataFrame([("new", 9)], "source string, page int")
    out, stats = lexicon.append_merge(old, staged, "raw_id", ex)
    assert {r.status: r.n for r in stats.collect()} == {"added": 1, "duplicate": 2, "skipped": 1, "excluded_page": 1}
    assert [r.id for r in out.where("source = 'new'").collect()] == ["official_lex_0003"]
    again, _ = lexicon.append_merge(out, staged, "raw_id", ex)
    assert sorted(map(tuple, again.select("id", "khmer").collect())) == sorted(map(tuple, out.select("id", "khmer").collect()))


def test_rejection(spark):
    bad = {"abc": "no Khmer", "ក1": "OCR junk characters", "ក" * 31: "definition text in headword", "ក": "single bare consonant", "ក" * 30: None, "": None}
    df = spark.createDataFrame([(k,) for k in bad], "k string").select("k", lexicon.headword_rejection(F.col("k")).alias("r"))
    assert {r.k: r.r for r in df.collect()} == bad


def test_verify_against_pages(spark):
    rows = spark.createDataFrame([(1, "s", 1, "បម្លាស់"), (2, "s", 1, "ម្លាស់"), (3, "s", 1, "ភាសាខ្មែរ")], "raw_id long, source string, page int, khmer string")
    rows = rows.withColumn("needs_review", F.lit(None).cast("string"))
    pages = spark.createDataFrame([("s", 1, "៨០-បម្លាស់\nភាសា-\nខ្មែរ")], "source string, page int, text string")
    got = {r.raw_id: r.needs_review for r in lexicon.verify_against_pages(rows, pages).collect()}
    assert got[1] is None and got[2] and got[3] is None


def test_quality(spark):
    e = lex(spark, [("ក", "", "s"), ("abc", "x", "s"), ("ខ្មែរ", "X", "s"), ("ខ្មែរ", "y", "s"), (None, None, "s")])
    n = {r.check: r.n for r in quality.check_counts(e).collect()}
    assert n["empty khmer"] == 1 and n["empty english"] == 2 and n["no Khmer at all"] == 1 and n["single bare consonant"] == 1
    assert n["duplicate khmer forms"] == 1 and n["duplicate english glosses"] == 1
    base = spark.createDataFrame([("empty khmer", 0), ("no Khmer at all", 5)], "check string, count long")
    v = {r.check: r.verdict for r in quality.ratchet(quality.check_counts(e), base).collect()}
    assert v["empty khmer"] == "regression" and v["no Khmer at all"] == "improvement" and v["empty english"] == "new"
    with pytest.raises(ValueError):
        quality.gate(quality.ratchet(quality.check_counts(e), base))


def test_build_id_and_diff(spark):
    import hashlib
    import json

    a = lex(spark, [("ខ្មែរ", "x", "s"), ("ភាសា", "y", "s"), ("ពាក្យ", "z", "s")])
    idx = quality.build_index(a)
    want = {r.id: hashlib.sha256(r.khmer.encode()).hexdigest()[:8] for r in a.collect()}
    assert {r.id: r.hash for r in idx.collect()} == want
    assert quality.build_id(idx).first()[0] == hashlib.sha256(json.dumps(want, sort_keys=True).encode()).hexdigest()[:12]
    new = idx.where("id <> 'official_lex_0001'").withColumn("hash", F.when(F.col("id").endswith("2"), "x").otherwise(F.col("hash")))
    new = new.union(spark.createDataFrame([("w", "h")], "id string, hash string"))
    assert {r.id[-1]: r.change for r in quality.build_diff(idx, new).collect()} == {"1": "removed", "2": "khmer_changed", "w": "added"}


def test_estimate(spark):
    e = spark.createDataFrame([(i, "a" if i < 1000 else "b") for i in range(1020)], "i long, source string")
    got = estimate.draw(e, 100, "source", "i")
    assert {r.source: r["count"] for r in got.groupBy("source").count().collect()} == {"a": 98, "b": 10}
    assert sorted(r.i for r in got.collect()) == sorted(r.i for r in estimate.draw(e.repartition(3), 100, "source", "i").collect())
    w = lambda x, n: spark.range(1).select(estimate.wilson(F.lit(x), F.lit(n)).alias("w")).first().w
    assert w(0, 50).p == w(0, 50).lo == 0 and 0 < w(0, 50).hi < 0.15 and w(50, 50).hi == 1 and w(5, 100).lo < 0.05 < w(5, 100).hi and w(0, 0).hi == 0
    t = spark.createDataFrame([("a", 0, 98), ("b", 10, 10), ("c", 0, 0)], "stratum string, errors long, checked long")
    s = spark.createDataFrame([("a", 1000), ("b", 20), ("c", 5)], "stratum string, size long")
    r = estimate.weighted_rate(t, s).first()
    assert abs(r.rate - 20 / 1020) < 1e-12 and r.n == 108 and r.covers == 1020
    p = spark.createDataFrame([("s", 1, "Eng. landscape\narchitecture"), ("s", 2, "Eng. architecture")], "source string, page int, text string")
    g = spark.createDataFrame([(1, "s", "architecture"), (2, "s", "landscape architecture")], "i long, source string, english string")
    assert {x.i: x.page for x in estimate.locate_glosses(g, p, "i").collect()} == {1: 2, 2: 1}


def test_classify(spark):
    top = "\n".join(["អនុក្រឹត្យ"] + ["x"] * 3 + ["ព្រះរាជក្រឹត្យ ២០០៥"])
    pages = spark.createDataFrame([("d", 1, top), ("d", 2, "1999 ២០០៧"), ("e", 1, "\n".join(["x"] * 12 + ["LEXICON"])), ("f", 1, None)], "doc string, page int, text string")
    got = {r.doc: r for r in classify.classify_documents(pages).collect()}
    assert (got["d"].kind, got["d"].word, got["d"].year) == ("law-or-decree", "អនុក្រឹត្យ", 2007)
    assert got["e"].kind == "other" and got["f"].kind == "indeterminate"


def test_tbx(spark):
    e = lex(spark, [("ភាសា", "a & b", "s"), ("", "none", "s")]).withColumn("pos", F.lit("f.")).withColumn("definition", F.lit("d"))
    x = io.tbx_concepts(e).collect()
    assert len(x) == 1 and "a &amp; b" in x[0].xml and x[0].xml.count('type="definition"') == 1 and "feminine" in x[0].xml


def test_json_and_csv(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"id": "1", "khmer": " ក ", "x": 1}, {"id": "2"}]')
    assert [(r.id, r.khmer, r.french) for r in io.read_json_array(spark, str(tmp_path / "l.json")).orderBy("id").collect()] == [("1", "ក", ""), ("2", "", "")]
    assert io.optional_csv(spark, str(tmp_path / "none.csv"), "a string").count() == 0
    (tmp_path / "r.json").write_text('{"sources": {"a": {"entries": 3, "bytes": 9}, "b": {}}}')
    assert sorted(r.source for r in io.read_registry(spark, str(tmp_path / "r.json")).collect()) == ["a", "b"]


def reference_limiter(events, limit, window):
    out, seen = {}, {}
    for i, c, t in sorted(events, key=lambda x: (x[2], x[0])):
        q = seen.setdefault(c, deque())
        while q and q[0] < t - window:
            q.popleft()
        out[i] = len(q) < limit
        if out[i]:
            q.append(t)
    return out


def test_rate_limit_batch_and_stream(spark, tmp_path):
    import random

    r = random.Random(1)
    ev = [(i, r.choice("ab"), 1_000_000 + r.randint(0, 600)) for i in range(300)]
    df = spark.createDataFrame(ev, "event_id long, client string, s long").withColumn("ts", F.timestamp_seconds("s"))
    want = reference_limiter(ev, 3, 60)
    assert {x.event_id: x.accepted for x in limiter.rate_limit(df, "client", "ts", "event_id", 3, 60).collect()} == want
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = limiter.rate_limit_stream(stream, "client", "ts", "event_id", 3, 60).writeStream.format("memory").queryName("lim").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert {x.event_id: x.accepted for x in spark.table("lim").collect()} == want


def test_profile(spark):
    from termloom.operators import profile

    rows = [(n, ("Word %d" % i) if (n != 3 or i % 2) else None, "noun") for n in range(1, 6) for i in range(300)]
    df = spark.createDataFrame(rows, "load_no int, english string, pos string")
    got = {(r.load_no, r.column_name): r for r in profile.load_changes(df, "load_no", ["english", "pos"]).collect()}
    assert [k for k, r in got.items() if r.changed] == [(3, "english")]
    p = {(r.load_no, r.column_name): r for r in profile.column_profile(df, "load_no", ["english", "pos"], {"english": "^W"}).collect()}
    assert p[(3, "english")].n_blank == 150 and p[(1, "pos")].most_repeated == 300 and p[(1, "english")].n_violations == 0
    assert profile.load_changes(df.limit(0), "load_no", ["english"]).count() == 0


def test_load_blank_or_repeated_in_all_columns(spark):
    from termloom.operators import profile

    base = [(n, "Word %d" % (i * 7 % 90), "noun" if i % 3 else "verb") for n in range(1, 7) for i in range(200)]
    for one in ((None, None), ("", ""), ("same words here", "conj")):
        rows = [(n, e, p) if n != 4 else (n, *one) for n, e, p in base]
        df = spark.createDataFrame(rows, "load_no int, english string, pos string")
        got = profile.load_changes(df, "load_no", ["english", "pos"]).where("changed").collect()
        assert {(r.load_no, r.column_name) for r in got} == {(4, "english"), (4, "pos")}
    # the classifier decides: without a fit nothing is told apart
    keep, profile.fit_logistic = profile.fit_logistic, lambda *a: {}
    try:
        assert profile.load_changes(df, "load_no", ["english", "pos"]).where("changed").count() == 0
    finally:
        profile.fit_logistic = keep


def test_near_forms_share_a_gloss(spark):
    rows = [("ក", "x"), ("ខ", "X "), ("កខ", "x"), ("គ", "y"), ("ខគ", None), ("ឃ", "")]
    df = spark.createDataFrame(rows, "khmer string, english string")
    assert {tuple(r) for r in similarity.near_forms_with_gloss(df, "khmer", "english").collect()} == {("ក", "ខ"), ("ក", "កខ"), ("ខ", "កខ")} - {("ខ", "កខ")} | {("កខ", "ខ")}


def test_automaton_and_join_agree(spark):
    import random

    r = random.Random(3)
    docs = spark.createDataFrame([(i, "".join(r.choice("ab😀") for _ in range(60))) for i in range(40)] + [(99, None), (98, "")], "doc_id long, text string")
    terms = spark.createDataFrame([("".join(r.choice("ab😀") for _ in range(r.randint(1, 5))),) for _ in range(30)] + [("",), (None,)], "term string")
    a = sorted(map(tuple, matching.occurrences(docs, terms).collect()))
    assert a == sorted(map(tuple, matching.joined_occurrences(docs, terms).collect())) and a
    assert sorted(map(tuple, matching.terms_present(docs, terms).collect())) == sorted(map(tuple, matching.naive_terms(docs, terms).collect()))
    keep, matching.BROADCAST_CHARS = matching.BROADCAST_CHARS, 0
    try:
        assert sorted(map(tuple, matching.occurrences(docs, terms).collect())) == a
    finally:
        matching.BROADCAST_CHARS = keep
    assert matching.occurrences(docs, terms.limit(0)).count() == 0 and matching.best_of(lambda: None) >= 0


def test_contaminants_reasons(spark):
    got = spark.createDataFrame([("កшី̊a1",)], "t string").select(F.explode(X.contaminants(F.col("t"), False)).alias("c")).select("c.*").collect()
    assert [(r["index"], r.name, r.reason, r.suggest) for r in got] == [
        (1, "CYRILLIC SMALL LETTER SHA", "outside Khmer, Latin and shared punctuation", ""), (3, "COMBINING RING ABOVE", "UTS #39 visual confusable", "ំ"),
        (4, "LATIN SMALL LETTER A", "Latin in a Khmer-only field", ""), (5, "DIGIT ONE", "Latin in a Khmer-only field", ""),
    ]
    same = spark.createDataFrame([("\u0940\u093f\u0e34",)], "t string").select(X.contaminants(F.col("t")).alias("c")).first().c
    assert [(c.reason, c.suggest) for c in same] == [("same letter, wrong script", "ី"), ("same letter, wrong script", "ិ"), ("UTS #39 visual confusable", "ិ")]


def test_sql_functions(spark):
    spark.createDataFrame([("១. ភា្ជប់ x",), (None,), ("ទិន្នន័យ",)], "t string").createOrReplaceTempView("sql_texts")
    for name in X.register_sql(spark, "tl_"):
        a = spark.sql(f"SELECT {name}(t) AS y FROM sql_texts").collect()
        assert a == spark.table("sql_texts").select(X.SQL_FUNCTIONS[name[3:]](F.col("t")).alias("y")).collect()
    e = X.nfc_evidence(spark).collect()
    assert all(r.canonical_equal and not r.nfc_equal and r.n_named == 114 and r.n_classed == 2 for r in e)


def test_suggestions_only_without_results(spark):
    e = lex(spark, [("ផ្ទះ", "house", "t")])
    found, more = search.search_with_suggestions(e, "ផ្ទះ")
    assert found.count() == 1 and more.count() == 0
    found, more = search.search_with_suggestions(e, "ផ្ទា")
    assert found.count() == 0 and [r.khmer for r in more.collect()] == ["ផ្ទះ"]
    assert search.year_span(e).first().n_authors == 1 and search.authors(e).first().n == 1


def test_worklist_order_and_planting(spark):
    words = spark.createDataFrame([("បណ្ដឹង",), ("ស្ត្រី",)], "word string")
    e = lex(spark, [("ស្ត្រី", "", "b"), ("ក្តាម", "", "a"), ("បណ្តឹង", "", "z")])
    w = similarity.ordered_worklist(similarity.subscript_worklist(e, words, "pos_ord"), e, "pos_ord").collect()
    assert [(r.verdict, r.source) for r in w] == [("differs", "z"), ("unknown", "a"), ("ok", "b")]
    p = spark.createDataFrame([("ថ្មី", "new", "b"), ("ក្តាម", "x", "b")], "khmer string, english string, source string")
    out, ledger = similarity.plant_rows(e, p, "pos_ord")
    assert [r.khmer for r in out.orderBy("pos_ord", "place").collect()] == ["ស្ត្រី", "ថ្មី", "ក្តាម", "បណ្តឹង"]
    assert [(r.khmer, r.id) for r in ledger.collect()] == [("ថ្មី", "official_lex_0004")]
    assert similarity.plant_rows(out.drop("place"), p, "pos_ord")[1].count() == 0


def test_tbx_file_is_xml(spark, tmp_path):
    import json
    from xml.etree import ElementTree

    e = lex(spark, [("ភាសា", "a & b", "s"), ("ខ", "none", "s")])
    io.write_tbx(e, str(tmp_path / "t"), "pos_ord", "Terms <1>")
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*.txt")))
    root = ElementTree.fromstring(text)
    ns = "{urn:iso:std:iso:30042:ed-2}"
    assert [c.get("id") for c in root.iter(ns + "conceptEntry")] == ["official_lex_0001", "official_lex_0002"] and root.find(f".//{ns}title").text == "Terms <1>"
    io.write_json_array(e, str(tmp_path / "j"), "pos_ord")
    rows = json.loads("".join(p.read_text() for p in sorted((tmp_path / "j").glob("part-*.txt"))))
    assert [r["khmer"] for r in rows] == ["ភាសា", "ខ"]
    counts, found = quality.check_counts(e), quality.examples(quality.findings(e))
    md = [r.text for r in io.markdown_report(counts, found, "Checks").collect()]
    assert md[0].startswith("# Checks: ") and any(x.startswith("## single bare consonant (1)") for x in md)


def test_summary_reports_and_relocation(spark):
    b = spark.createDataFrame([("c", 3)], "check string, count long")
    r = spark.createDataFrame([("s", 1, 4), ("t", 0, 0)], "stratum string, errors long, checked long")
    got = {(x.section, x.name): x.value for x in estimate.metrics_summary(b, r, None).collect()}
    assert got == {("quality", "c"): 3.0, ("error rate", "s"): 0.25, ("error rate", "t"): None}
    ev = spark.createDataFrame([("lexicon_report", 1, "x" * 5000, 1), ("lexicon_report", 2, "", 2), ("zero_result", 3, "q", 3)], "kind string, at long, message string, log_id long")
    assert [len(x.message) for x in limiter.clip_reports(ev.where("kind = 'lexicon_report'")).collect()] == [2000]
    assert [x.log_id for x in limiter.recent_reports(ev, "lexicon_report", "at", "log_id").collect()] == [2, 1]
    s = spark.createDataFrame([(1, "s", "long gloss", 9, "", "", ""), (2, "s", "long gloss", 9, "y", "", "")], "i long, source string, english string, page int, khmer_ok string, english_ok string, notes string")
    p = spark.createDataFrame([("s", 4, "Eng. long gloss")], "source string, page int, text string")
    assert {x.i: x.page for x in estimate.relocate_unjudged(s, p, "i").collect()} == {1: 4, 2: 9}


def test_hashed_terms_are_found_as_by_the_join(spark):
    # term lists too long for the automaton: no row is made of a place without a hit, whatever the parts
    import random

    r = random.Random(8)
    make = lambda n: "".join(r.choice("កខគ្ាំab") for _ in range(n))
    words = sorted({make(r.choice([1, 2, 3, 4, 5, 7, 9, 13, 30, 70])) for _ in range(400)})
    texts = ["".join(r.choice(words) if r.random() < 0.5 else make(3) for _ in range(r.randint(0, 30))) for _ in range(60)] + [None, "", "𐐀" + words[5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = spark.createDataFrame([(w,) for w in words] + [("",), (None,)], "term string")
    want = sorted(map(tuple, matching.joined_occurrences(docs, terms).collect()))
    keep = matching.BROADCAST_CHARS, matching.HASHED_TERMS, matching.CHUNK
    try:
        matching.BROADCAST_CHARS = 0
        for matching.HASHED_TERMS, matching.CHUNK in ((1000, 1 << 18), (150, 50)):
            df = matching.occurrences(docs, terms)
            assert sorted(map(tuple, df.collect())) == want and want
            assert "Join" not in df._jdf.queryExecution().toString()
            assert sorted(map(tuple, matching.terms_present(docs, terms).collect())) == sorted({x[:2] for x in want})
    finally:
        matching.BROADCAST_CHARS, matching.HASHED_TERMS, matching.CHUNK = keep


def test_draft_hits_know_the_clusters(spark):
    # cluster edges go along with the text: no shuffle of texts or of arrays of their places
    texts = ["\x01កា\x01\x01ខ្មែរ", "ខ្មែរកា\x01", "e\u0301ខ្មែរ ក", "\x01", "កា\r\nខ្មែរ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = spark.createDataFrame([(x,) for x in ("កា", "ក", "ខ្មែរ", "ខ្ម", "\x01", "\x01ក", "\x01\x01ខ", "e", "\n")], "term string")
    bounds = docs.select("doc_id", X.cluster_boundaries(F.col("text")).alias("b"))
    want = matching.joined_occurrences(docs, terms).join(bounds, "doc_id").select("doc_id", "term", "start", "end", X.on_boundary(F.col("b"), F.col("start"), F.col("end")))
    got = matching._draft_hits(docs, terms, "doc_id", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.where("whole").count() > 5
    assert "Exchange" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("part", ["matches", "loanwords"])
def test_large_lexicon_makes_no_rows_of_places(spark, part, monkeypatch):
    entries = spark.createDataFrame([(1, "ខ្មែរ", "river bank"), (2, "ភាសាខ្មែរ", "river"), (3, "កាកា", "bank")], "pos_ord long, khmer string, english string")
    docs = spark.createDataFrame([(1, "ភាសាខ្មែរ River bank, bank"), (2, "bank of a river: ខ្មែរ"), (3, "riverbank")], "doc_id long, text string")
    columns = ["doc_id", "term", "start", "end"]
    rows = lambda: sorted(map(tuple, matching.check_drafts(docs, entries)[part].select(*columns).collect()))
    want = rows()
    # a list beyond the automaton's bound used to be joined to every place of every text
    monkeypatch.setattr(matching, "BROADCAST_CHARS", 0)
    monkeypatch.setattr(matching, "joined_occurrences", None)
    assert rows() == want and want


def test_suggestions_meet_as_numbers(spark):
    # what is made of every deletion is two numbers, not the texts and their clusters
    import re

    lex = spark.createDataFrame([(i, k) for i, k in enumerate(["កខគ", "កខ", "កខគឃ", "ងងង", "ខ", None])], "pos_ord long, khmer string")
    df = search.did_you_mean(lex, spark.createDataFrame([("កខគ",), ("ក",), ("ងងក",)], "query string"))
    assert {tuple(r)[:3] for r in df.collect()} == {("កខគ", "កខគ", 0), ("កខគ", "កខ", 1), ("កខគ", "កខគឃ", 1), ("ក", "ខ", 1), ("ក", "កខ", 1), ("ងងក", "ងងង", 1)}
    assert re.search(r"Join Inner, \(key#\d+L = key#\d+L\)", df._jdf.queryExecution().optimizedPlan().toString())
