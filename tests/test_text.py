import random
import unicodedata

import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.functions import chars
from termloom.functions import text as X


def u(codes):
    return "".join(chr(int(c, 16)) for c in codes.split())


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def soup(n, seed=1):
    r = random.Random(seed)
    al = [chr(c) for c in range(0x1780, 0x17DE)] + ["‍", "‌", " ", "a"]
    return ["".join(r.choice(al) for _ in range(r.randint(0, 9))) for _ in range(n)]


def test_cluster_cases(spark):
    size = lambda t: [len(c) for c in one(spark, X.clusters(F.lit(u(t))))]
    assert size("1780 17D2 179A 179F 17BD 1784") == [3, 2, 1]
    assert size("179F 17D2 178F 17D2 179A 17B8") == [6]
    assert size("179F 17C1 1785 1780 17D2 178A 17B8") == [2, 1, 4]
    assert size("1780 17B8 17D2 178F") == [4]


def test_clusters_equal_reference_library(spark):
    s = soup(4000)
    for r in spark.createDataFrame([(x,) for x in s], "t string").select("t", X.clusters(F.col("t")).alias("c")).collect():
        assert r.c == regex.findall(r"\X", r.t)


def test_boundaries(spark):
    b = X.cluster_boundaries(F.lit(u("1780 17D2 179A 179F 17BD 1784")))
    assert one(spark, b) == [0, 3, 5, 6]
    on = lambda x, y: one(spark, X.on_boundary(b, F.lit(x), F.lit(y)))
    assert on(0, 3) and not on(0, 1) and not on(1, 3)


def test_edit_distance(spark):
    r = random.Random(3)
    s = soup(200, 5)
    pairs = [(r.choice(s), r.choice(s)) for _ in range(200)]
    for x in spark.createDataFrame(pairs, "a string, b string").select("a", "b", X.edit_distance(F.col("a"), F.col("b")).alias("d")).collect():
        assert x.d == lev(regex.findall(r"\X", x.a), regex.findall(r"\X", x.b))
    a, b = u("1797 17D2 1787 17B6 1794 17CB"), u("1797 17B6 17D2 1787 1794 17CB")
    assert one(spark, X.edit_distance(F.lit(a), F.lit(b))) == 2
    assert one(spark, X.edit_distance(F.lit("abcdefgh"), F.lit("zyxwvuts"), 1)) == 2


def test_canonical_marks(spark):
    s = soup(2000, 7)
    n = spark.createDataFrame([(x,) for x in s], "t string").select("t", X.canonical_marks(F.col("t")).alias("n")).withColumn("m", X.canonical_marks(F.col("n"))).collect()
    assert all(sorted(r.t) == sorted(r.n) and r.n == r.m for r in n)
    assert one(spark, X.canonical_marks(F.lit(u("1797 17B6 17D2 1787 1794 17CB")))) == u("1797 17D2 1787 17B6 1794 17CB")
    stacked = u("179F 17D2 178F 17D2 179A 17B8")
    assert one(spark, X.canonical_marks(F.lit(stacked))) == stacked
    assert one(spark, X.canonical_marks(F.lit(""))) == "" and one(spark, X.canonical_marks(F.lit(None).cast("string"))) is None


def test_tables():
    assert len(chars.SAME_LETTER) >= 195 and {"\u0940", "\u093f", "\u0941", "\u0942"} <= set(chars.SAME_LETTER) and "\u0e34" not in chars.SAME_LETTER
    assert all(c in chars.SAME_LETTER for c in "ीिुू") and "ิ" not in chars.SAME_LETTER
    assert chars.DRAWN_ALIKE["ิ"] == "ិ"
    named = [c for c in range(0x1780, 0x1800) if unicodedata.name(chr(c), "")]
    assert len(named) == 114 and [c for c in named if unicodedata.combining(chr(c))] == [0x17D2, 0x17DD]


def test_contaminants(spark):
    c = one(spark, X.contaminants(F.lit("ab ш"), False))
    assert [x["char"] for x in c] == ["a", "b", "ш"] and all(x["reason"] for x in c)
    assert one(spark, X.contaminants(F.lit("ភាព (ABC)"))) == []
    assert one(spark, X.repair_script(F.lit("ी"))) == "ី"


def test_cleaning(spark):
    assert one(spark, X.clean_french(F.lit("France"))) == "France"
    assert one(spark, X.clean_french(F.lit("fr. eau"))) == "eau"
    assert one(spark, X.clean_english(F.lit(" Eng. water "))) == "water"
    assert one(spark, X.clean_khmer(F.lit("៣១- កក"))) == "កក"
    assert tuple(one(spark, X.split_item(F.lit("12. កក")))) == ("12", "កក")
    assert one(spark, X.years(F.lit("ឆ្នាំ២០១១ 1949 2049 20111"))) == [2011, 2049]
    assert tuple(one(spark, X.part_of_speech(F.lit("(F.)")))) == ("noun", "feminine")
    assert one(spark, X.part_of_speech(F.lit("zz")))[0] is None
    assert one(spark, X.subscript_ro_last(F.lit("ស្រ្ត"))) == "ស្ត្រ"
    assert one(spark, X.unwrap_hyphens(F.lit("កំ- ណេត"))) == "កំណេត"
    assert one(spark, X.strip_code_fences(F.lit("```json\n[1]\n```"))) == "[1]"


def test_romanize(spark):
    assert one(spark, X.romanize(F.lit("ទិន្នន័យ"))) == "tinay"
    assert one(spark, X.fold_latin(F.lit("Tinnany chchA"))) == "tinanycha"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abតដ ្", max_size=6), min_size=1, max_size=20))
def test_swap_is_an_involution(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(X.swap_subscripts(X.swap_subscripts(F.col("t"))) != F.col("t")).count() == 0


def test_differing_span(spark):
    assert tuple(one(spark, X.differing_span(F.lit("abcd"), F.lit("abxd")))) == ("c", "x")
    assert tuple(one(spark, X.differing_span(F.lit("aa"), F.lit("aaa")))) == ("", "a")
