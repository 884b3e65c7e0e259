"""Searching and browsing a lexicon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from .similarity import deletion_keys

_low = F.lower


def _v(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _has_khmer(s: str) -> bool:
    return any(0x1780 <= ord(c) < 0x1800 for c in s)


def search(lexicon: DataFrame, query: str, category: str = "", limit: int = 60, order: str = "pos_ord") -> DataFrame:
    """Entries by tier (1 equal, 2 contains, 3 loose), with ``tier`` and ``rank``.

    A Khmer query looks at the headword, then the definition; a Latin one at both
    glosses, then at the sound of the headword (within distance 2).  No query and
    no category give nothing; a category alone its entries in file order.
    """
    q = query.strip()
    rows = lexicon.where(F.col("category") == category) if category else lexicon
    if not q:
        w = Window.orderBy(order)
        picked = rows if category else rows.where(F.lit(False))
        return picked.orderBy(order).limit(limit).withColumn("tier", F.lit(0)).withColumn("rank", F.row_number().over(w))
    if _has_khmer(q):
        tier = F.when(_v("khmer") == q, 1).when(F.contains(_v("khmer"), F.lit(q)), 2).when(F.contains(_v("definition"), F.lit(q)), 3)
        near, size3 = F.lit(0), F.length(_v("khmer"))
    else:
        n = q.lower()
        en, fr = _low(_v("english")), _low(_v("french"))
        key = X.romanize(_v("khmer"))
        folded = X.fold_latin(F.lit(n))
        near = F.when(F.contains(key, folded), 0).otherwise(F.levenshtein(folded, key, 2))
        loose = (F.length(folded) >= 3) & (F.length(key) > 0) & (near >= 0)
        tier = F.when((en == n) | (fr == n), 1).when(F.contains(en, F.lit(n)) | F.contains(fr, F.lit(n)), 2).when(loose, 3)
        size3 = F.length(_v("khmer"))
    size2 = F.length(F.when(_v("english") != "", _v("english")).otherwise(_v("khmer")))
    hit = rows.withColumn("tier", tier).where(F.col("tier").isNotNull())
    hit = hit.withColumn("_k1", F.when(F.col("tier") == 3, near).when(F.col("tier") == 2, size2).otherwise(0)).withColumn("_k2", F.when(F.col("tier") == 3, size3).otherwise(0))
    # Only the first ``limit`` rows are numbered: the sort is a top-k, not a sort of all hits.
    top = hit.orderBy("tier", "_k1", "_k2", order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("tier", "_k1", "_k2", order))).drop("_k1", "_k2")


def search_total(lexicon: DataFrame, query: str, category: str = "") -> DataFrame:
    """``total`` of all hits, however many are shown."""
    return search(lexicon, query, category, 2_000_000_000).agg(F.count("*").alias("total"))


def did_you_mean(lexicon: DataFrame, queries: DataFrame, query: str = "query", limit: int = 6, order: str = "pos_ord") -> DataFrame:
    """``query, khmer, distance, rank``: headwords within one cluster of each Khmer query."""
    q = queries.select(F.col(query).alias("query")).where(X.has_khmer(F.col("query"))).distinct()
    q = q.withColumn("_q", X.canonical_marks(X.strip(F.col("query")))).withColumn("hq", F.xxhash64("query"))
    f = lexicon.select(X.strip(_v("khmer")).alias("khmer")).where("khmer <> ''").distinct().withColumn("_f", X.canonical_marks(F.col("khmer"))).withColumn("hf", F.xxhash64("khmer"))
    # keys meet as two numbers each, and only the pairs that share one meet their texts; equal numbers of different texts fail the distance
    keys = lambda c: F.explode(F.transform(deletion_keys(X.clusters(F.col(c))), lambda k: F.xxhash64(k))).alias("key")
    a, b = q.select("hq", keys("_q")), f.select("hf", keys("_f"))
    c = a.join(b, "key").select("hq", "hf").distinct().join(q, "hq").join(f, "hf")
    c = c.withColumn("_q", X.clusters(F.col("_q"))).withColumn("_f", X.clusters(F.col("_f"))).where(F.abs(F.size("_q") - F.size("_f")) <= 1)
    c = c.withColumn("distance", X.array_edit_distance(F.col("_q"), F.col("_f"))).where("distance <= 1")
    w = Window.partitionBy("query").orderBy("distance", F.length("khmer"), "khmer")
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("query", "khmer", "distance", "rank")


def search_with_suggestions(lexicon: DataFrame, query: str, category: str = "", limit: int = 60, order: str = "pos_ord") -> tuple[DataFrame, DataFrame]:
    """The results, and suggestions (``khmer, distance, rank``) which there are only if nothing was found.

    Both stay one plan: the suggestions are joined to the count of the results.
    """
    found = search(lexicon, query, category, limit, order)
    total = found.agg(F.count("*").alias("_n")).where("_n = 0").select(F.lit(query).alias("query"))
    asked = lexicon.sparkSession.range(1).select(F.lit(query).alias("query"))
    return found, did_you_mean(lexicon, asked, "query", order=order).join(total, "query", "left_semi").drop("query")


def senses(lexicon: DataFrame, khmer: str, order: str = "pos_ord") -> DataFrame:
    return lexicon.where(F.col("khmer") == khmer).orderBy(order)


def categories(lexicon: DataFrame, order: str = "pos_ord") -> DataFrame:
    """``category, n, first_pos``: most first, ties in order of first sight."""
    g = lexicon.where(_v("category") != "").groupBy("category").agg(F.count("*").alias("n"), F.min(order).alias("first_pos"))
    return g.orderBy(F.desc("n"), "first_pos")


def sources(lexicon: DataFrame, order: str = "pos_ord") -> DataFrame:
    """``source, n, author, year``; author and year are those of the first entry."""
    g = lexicon.where(_v("source") != "").groupBy("source")
    return g.agg(F.count("*").alias("n"), F.min_by(_v("author"), order).alias("author"), F.min_by(_v("year"), order).alias("year")).orderBy(F.desc("n"), "source")


def letters(lexicon: DataFrame) -> DataFrame:
    """``letter, n``: distinct headwords by first letter, if it is Khmer."""
    f = lexicon.select(X.strip(_v("khmer")).alias("k")).where("k <> ''").distinct().select(F.substring("k", 1, 1).alias("letter"))
    return f.where(X.has_khmer(F.col("letter"))).groupBy("letter").agg(F.count("*").alias("n")).orderBy("letter")


def by_source(lexicon: DataFrame, source: str, limit: int = 200, order: str = "pos_ord") -> DataFrame:
    return lexicon.where(F.col("source") == source).orderBy(order).limit(limit)


def by_letter(lexicon: DataFrame, letter: str, limit: int = 200, order: str = "pos_ord") -> DataFrame:
    return lexicon.where(F.startswith(_v("khmer"), F.lit(letter))).orderBy("khmer", order).limit(limit)


def field_coverage(lexicon: DataFrame, fields: tuple[str, ...] = ("english", "khmer", "french", "pos", "definition", "examples")) -> DataFrame:
    """``field, filled, share``: how many rows have the field at all."""
    counts = lexicon.agg(F.count("*").alias("n"), *[F.count_if(X.strip(_v(f)) != "").alias(f) for f in fields])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])).alias("x")
    return counts.select("n", each).select("x.field", "x.filled", (F.col("x.filled") / F.greatest("n", F.lit(1))).alias("share"))


def year_span(lexicon: DataFrame) -> DataFrame:
    """``first_year, last_year`` of the years that are all digits, 0 where there is none, and ``n_authors``."""
    y = F.when(_v("year").rlike("^[0-9]+$"), F.col("year").try_cast("int"))
    return lexicon.agg(
        F.coalesce(F.min(y), F.lit(0)).alias("first_year"), F.coalesce(F.max(y), F.lit(0)).alias("last_year"),
        F.count_distinct(F.nullif(X.strip(_v("author")), F.lit(""))).alias("n_authors"),
    )


def authors(lexicon: DataFrame) -> DataFrame:
    """``author, n``: most entries first."""
    return lexicon.where(X.strip(_v("author")) != "").groupBy(X.strip(F.col("author")).alias("author")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "author")


def registry_report(lexicon: DataFrame, registry: DataFrame, order: str = "pos_ord") -> DataFrame:
    """Sources with what the registry holds on them; the link is the first that is not empty."""
    link = F.coalesce(*[F.nullif(_v(c), F.lit("")) for c in ("official_page", "official_url", "archived_url") if c in registry.columns])
    r = registry.select("source", "title", link.alias("link"), F.coalesce(F.nullif(_v("url_status"), F.lit("")), F.lit("unknown")).alias("url_status"))
    s = sources(lexicon, order).join(F.broadcast(r) if r.count() <= 100_000 else r, "source", "left")
    return s.withColumn("url_status", F.coalesce("url_status", F.lit("unknown"))).withColumn("archived_only", F.col("url_status") == "archived-only")


def whole_word(lexicon: DataFrame, words: list[str], order: str = "pos_ord") -> DataFrame:
    """``word, english, khmer, source``: distinct entries whose gloss has the word as a whole word."""
    each = F.explode(F.array(*[F.lit(w) for w in words])).alias("word")
    e = lexicon.select(each, F.col("english"), F.col("khmer"), F.col("source"))
    pattern = F.concat(F.lit("(?U)\\b\\Q"), F.col("word"), F.lit("\\E\\b"))
    return e.where(F.regexp_like(F.lower(_v("english")), pattern)).distinct()


def contexts(docs: DataFrame, term: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, at, context``: spans up to a full stop that hold the term, never across a line."""
    pattern = "(?i)([^.\\n]*?\\Q" + term + "\\E[^.\\n]*?\\.)"
    return docs.select(doc_id, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("at", "c")).select(doc_id, "at", X.strip(F.col("c")).alias("context"))


def lookups(lexicon: DataFrame, order: str = "pos_ord") -> tuple[DataFrame, DataFrame]:
    """English to Khmer and Khmer to English; the first entry with both wins."""
    e = lexicon.where((X.strip(_v("english")) != "") & (X.strip(_v("khmer")) != ""))
    ek = e.groupBy(F.lower("english").alias("english_key")).agg(F.min_by("khmer", order).alias("khmer"), F.min(order).alias("pos"))
    ke = e.groupBy(F.col("khmer").alias("khmer_key")).agg(F.min_by("english", order).alias("english"), F.min(order).alias("pos"))
    return ek, ke


def search_call(lexicon: DataFrame, query: str | None, category: str | None = None, limit: int | None = None) -> DataFrame:
    """The service call: a query or a category is needed; the limit is 40, and from 1 to 100."""
    if not (query or "").strip() and not (category or "").strip():
        raise ValueError("a query or a category is needed")
    return search(lexicon, query or "", category or "", min(max(limit or 40, 1), 100))


def browse_call(lexicon: DataFrame, source: str | None = None, letter: str | None = None) -> DataFrame:
    """The service call: a source goes before a letter."""
    if source:
        return by_source(lexicon, source)
    if letter:
        return by_letter(lexicon, letter)
    raise ValueError("a source or a letter is needed")
