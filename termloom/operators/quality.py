"""Quality checks, the ratchet, build index and build diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

LONG_CLUSTERS, SHORT_CHARS = 20, 3
# Letters out of use, and a letter pair typed for the vowel it looks like.
OBSOLETE = "ឝឞឣឤ"
VOWEL_LOOK_ALIKE = "ប្ញ"


def _v(c: str) -> Column:
    return X.strip(F.coalesce(F.col(c), F.lit("")))


def findings(entries: DataFrame, row_id: str = "id") -> DataFrame:
    """``check, id, detail``: one row per finding of the checks on single entries, in one pass."""
    k, en = F.col("_k"), F.col("_e")
    e = entries.select(F.col(row_id).cast("string").alias("id"), _v("khmer").alias("_k"), _v("english").alias("_e"))
    some = k != ""
    one = lambda name, cond, detail=None: F.when(cond, F.array(F.struct(F.lit(name).alias("check"), (detail if detail is not None else k).alias("detail"))))
    none = F.array().cast("array<struct<check:string,detail:string>>")
    dirt = F.transform(X.contaminants(k), lambda c: F.struct(F.lit("out-of-range character").alias("check"), c["char"].alias("detail")))
    old = F.transform(F.filter(F.array(*[F.lit(c) for c in OBSOLETE]), lambda c: F.contains(k, c)), lambda c: F.struct(F.lit("obsolete letter").alias("check"), c.alias("detail")))
    length = X.cluster_length(k)
    checks = [
        one("empty khmer", ~some, F.lit("")), one("empty english", en == "", k),
        one("no Khmer at all", some & ~X.has_khmer(k)), one("ASCII digit", k.rlike("[0-9]")),
        one("shorter than three characters", X.has_khmer(k) & (F.length(k) < SHORT_CHARS)),
        one("single bare consonant", k.rlike("^[\\u1780-\\u17A2]$")),
        one("subscript ro first", k.rlike("[\\u1780-\\u17A2]\\u17D2\\u179A\\u17D2[\\u1780-\\u17A2]"), X.subscript_ro_last(k)),
        one("letter pair for a vowel", F.contains(k, F.lit(VOWEL_LOOK_ALIKE))),
        one("marks not in canonical order", X.canonical_marks(k) != k, X.canonical_marks(k)),
        one("longer than 20 clusters", length > LONG_CLUSTERS, length.cast("string")),
    ]
    all_ = F.concat(*[F.coalesce(c, none) for c in checks], F.coalesce(dirt, none), old)
    return e.select("id", F.explode(all_).alias("f")).select("f.check", "id", "f.detail")


def repeated(entries: DataFrame) -> DataFrame:
    """``check, value, n``: headwords, and glosses in lower case, with more than one row."""
    forms = entries.select(F.lit("duplicate khmer forms").alias("check"), _v("khmer").alias("value"))
    gloss = entries.select(F.lit("duplicate english glosses").alias("check"), F.lower(_v("english")).alias("value"))
    return forms.unionByName(gloss).where("value <> ''").groupBy("check", "value").agg(F.count("*").alias("n")).where("n > 1")


def check_counts(entries: DataFrame, row_id: str = "id") -> DataFrame:
    """``check, n`` of all checks that find anything."""
    a = findings(entries, row_id).groupBy("check").agg(F.count("*").alias("n"))
    return a.unionByName(repeated(entries).groupBy("check").agg(F.count("*").alias("n")))


def ratchet(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """``check, n, was, verdict``: against the baseline; a check without one is only noted."""
    b = baseline.select("check", F.col("count").alias("was"))
    j = b.join(counts, "check", "full").withColumn("n", F.coalesce("n", F.lit(0)))
    verdict = F.when(F.col("was").isNull(), "new").when(F.col("n") > F.col("was"), "regression").when(F.col("n") < F.col("was"), "improvement").otherwise("same")
    return j.select("check", "n", "was", verdict.alias("verdict"))


def gate(ratcheted: DataFrame) -> None:
    """Stop if any check found more than the baseline allows."""
    worse = [r["check"] for r in ratcheted.where("verdict = 'regression'").limit(100).collect()]
    if worse:
        raise ValueError(f"regressions: {worse}")


def examples(found: DataFrame, most: int = 25) -> DataFrame:
    """The first findings of each check, for a report."""
    w = Window.partitionBy("check").orderBy("id", "detail")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def build_index(entries: DataFrame, row_id: str = "id") -> DataFrame:
    """``id, hash`` of every entry."""
    return entries.select(F.col(row_id).cast("string").alias("id"), X.content_hash(F.col("khmer")).alias("hash"))


def build_id(index: DataFrame) -> DataFrame:
    """``build_id``: first twelve hex digits of the SHA-256 of the sorted index as JSON.

    The digest is fed in order with chunks of the range-sorted index, which come
    to the driver one at a time; nothing holds the whole text.
    """
    import hashlib

    quote = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    lines = index.select("id", F.concat(quote("id"), F.lit(": "), quote("hash")).alias("p")).orderBy("id", "p").select("p")
    digest, sep = hashlib.sha256(b"{"), ""
    for row in lines.toLocalIterator():
        digest.update((sep + row[0]).encode())
        sep = ", "
    digest.update(b"}")
    return index.sparkSession.createDataFrame([(digest.hexdigest()[:12],)], "build_id string")


def manifest(entries: DataFrame, counts: DataFrame, row_id: str = "id") -> DataFrame:
    """One row: ``build_id, built_at, entries, sources, quality``."""
    s = entries.groupBy("source").agg(F.count("*").alias("n"))
    src = s.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("source", F.lit("")), "n")))).alias("sources"), F.coalesce(F.sum("n"), F.lit(0)).alias("entries"))
    q = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "n")))).alias("quality"))
    b = build_id(build_index(entries, row_id))
    one = lambda d: d.withColumn("_one", F.lit(1))
    return one(b).join(one(src), "_one").join(one(q), "_one").drop("_one").withColumn("built_at", F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())))


def build_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``id, change``: added, removed or khmer_changed between two indexes."""
    j = old.select("id", F.col("hash").alias("a")).join(new.select("id", F.col("hash").alias("b")), "id", "full")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "khmer_changed")
    return j.select("id", change.alias("change")).where("change is not null")


def verify_files(registry: DataFrame, files: DataFrame) -> DataFrame:
    """``source, verdict``: registered files against the bytes found (``path, length, content`` of a binary read)."""
    f = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), "length", F.sha2("content", 256).alias("found"))
    j = registry.join(f, "file_name", "left")
    verdict = F.when(F.col("length").isNull(), "missing").when(F.col("length") != F.col("bytes"), "size differs").when(F.lower("sha256") != F.col("found"), "hash differs").otherwise("ok")
    return j.select("source", verdict.alias("verdict"))
