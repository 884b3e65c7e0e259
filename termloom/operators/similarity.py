"""Similarity joins over headwords and checks against a reference word list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

PUNCTUATION = "^[\\s\\p{P}\\u200B-\\u200D]*$"
REASONS = ("whitespace", "punctuation", "confusion", "one character added or dropped", "substitution", "multi-character")


def deletion_keys(pieces: Column) -> Column:
    """The pieces joined, whole and with each one left out: texts within one edit share a key."""
    sep = "\u0001"
    n = F.size(pieces)
    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    less = F.transform(steps, lambda i: F.array_join(F.concat(F.slice(pieces, F.lit(1), i - 1), F.slice(pieces, i + 1, n - i)), sep))
    return F.array_distinct(F.concat(F.array(F.array_join(pieces, sep)), less))


def near_forms(forms: DataFrame, form: str = "form", unit: str = "cluster", within: str | None = None) -> DataFrame:
    """``a, b`` with ``a < b``: distinct forms exactly one edit apart, by clusters or characters.

    ``within`` names a column whose value both must share (a gloss, say), which
    also splits every key.  Forms of one piece all share the empty key: each two
    of them are one edit apart by definition, so all their pairs are in the result.
    """
    cols = [F.col(form).alias("f"), (F.col(within) if within else F.lit("")).alias("w")]
    f = forms.select(*cols).where((F.length("f") > 0) & F.col("w").isNotNull()).distinct()
    pieces = X.clusters(F.col("f")) if unit == "cluster" else F.split("f", "")
    k = f.withColumn("p", pieces).select("f", "w", "p", F.explode(deletion_keys(F.col("p"))).alias("key"))
    x, y = k.select("key", "w", F.col("f").alias("a"), F.col("p").alias("pa")), k.select("key", "w", F.col("f").alias("b"), F.col("p").alias("pb"))
    c = x.join(y, ["key", "w"]).where("a < b").dropDuplicates(["a", "b"])
    # one piece against another is an edit; so is a piece more or less that leaves the key
    size = F.abs(F.size("pa") - F.size("pb"))
    return c.where((size <= 1) & (X.array_edit_distance(F.col("pa"), F.col("pb")) == 1)).select("a", "b")


def near_forms_with_gloss(entries: DataFrame, form: str, gloss: str, unit: str = "cluster") -> DataFrame:
    """Forms one edit apart that have a gloss in common (lower case, trimmed)."""
    g = F.lower(X.strip(F.col(gloss).cast("string")))
    return near_forms(entries.select(F.col(form).alias("form"), g.alias("g")).where("g <> ''"), "form", unit, "g")


def shared_gloss(pairs: DataFrame, entries: DataFrame, form: str, gloss: str) -> DataFrame:
    """The pairs whose forms have a gloss in common, lower case and trimmed."""
    g = entries.select(F.col(form).alias("f"), F.lower(X.strip(F.coalesce(F.col(gloss).cast("string"), F.lit("")))).alias("g")).where("g <> ''").distinct()
    a, b = g.select(F.col("f").alias("a"), "g"), g.select(F.col("f").alias("b"), "g")
    return pairs.join(a, "a").join(b, ["b", "g"]).select("a", "b").distinct()


def duplicate_forms(entries: DataFrame, form: str) -> DataFrame:
    """``form, n`` of forms with more than one row."""
    return entries.where(F.length(F.col(form)) > 0).groupBy(F.col(form).alias("form")).agg(F.count("*").alias("n")).where("n > 1")


def classify_pairs(pairs: DataFrame, confusions: DataFrame | None = None) -> DataFrame:
    """``a, b, reason, weight``: how two forms differ, and how often the difference is a known confusion."""
    p = pairs.withColumn("s", X.differing_span(F.col("a"), F.col("b"))).select("a", "b", F.col("s.left").alias("l"), F.col("s.right").alias("r"))
    if confusions is None:
        p = p.withColumn("weight", F.lit(0).cast("long"))
    else:
        c = confusions.groupBy("from_char", "to_char").agg(F.max("count").cast("long").alias("w"))
        c1, c2 = c.toDF("l", "r", "w1"), c.toDF("r", "l", "w2")
        p = p.join(c1, ["l", "r"], "left").join(c2, ["l", "r"], "left").withColumn("weight", F.coalesce("w1", "w2", F.lit(0)))
    both = F.concat("l", "r")
    reason = (
        F.when(both.rlike("^\\s*$"), REASONS[0]).when(both.rlike(PUNCTUATION), REASONS[1])
        .when((F.length("l") == 1) & (F.length("r") == 1), F.when(F.col("weight") > 0, REASONS[2]).otherwise(REASONS[4]))
        .when((F.col("l") == "") | (F.col("r") == ""), REASONS[3]).otherwise(REASONS[5])
    )
    return p.select("a", "b", reason.alias("reason"), "weight")


def pair_report(classified: DataFrame, entries: DataFrame, form: str, row_id: str) -> DataFrame:
    """Classified pairs with the ids and latest year of both forms, ranked within their reason."""
    info = entries.groupBy(F.col(form).alias("f")).agg(F.array_sort(F.collect_list(row_id)).alias("ids"), F.max("year").alias("latest"))
    j = classified.join(info.toDF("a", "ids_a", "latest_a"), "a", "left").join(info.toDF("b", "ids_b", "latest_b"), "b", "left")
    place = F.array_position(F.array(*[F.lit(r) for r in REASONS]), F.col("reason"))
    return j.withColumn("reason_order", place).withColumn("rank", F.row_number().over(Window.partitionBy("reason").orderBy(F.desc("weight"), F.desc("a"), F.desc("b"))))


def headwords(reference: DataFrame, columns: tuple[str, ...] = ("t_main", "t_subword")) -> DataFrame:
    """``word``: the distinct words of the columns, marks in canonical order."""
    w = reference.select(F.explode(F.array(*columns)).alias("w")).select(X.canonical_marks(X.strip(F.col("w"))).alias("word"))
    return w.where("word <> ''").distinct()


def single_words(entries: DataFrame, khmer: str = "khmer") -> DataFrame:
    """Entries whose headword is one Khmer word."""
    k = X.strip(F.coalesce(F.col(khmer), F.lit("")))
    return entries.where(X.has_khmer(k) & ~k.rlike("[ /()]"))


def _folded(c: Column) -> Column:
    return X.fold_subscripts(X.canonical_marks(X.strip(c)))


def known_words(entries: DataFrame, words: DataFrame, khmer: str = "khmer", known: bool = True) -> DataFrame:
    """Entries whose headword the word list has (or, ``known=False``, has not); the two look-alike subscripts are one."""
    w = words.select(X.fold_subscripts(F.col("word")).alias("_f")).distinct()
    return entries.withColumn("_f", _folded(F.col(khmer))).join(w, "_f", "left_semi" if known else "left_anti").drop("_f")


def compounds(entries: DataFrame, words: DataFrame, row_id: str, khmer: str = "khmer") -> DataFrame:
    """``row_id`` of entries of four clusters or more that split into list words of two clusters or more."""
    e = entries.select(F.col(row_id).alias("id"), X.clusters(X.canonical_marks(X.strip(F.col(khmer)))).alias("p")).where(F.size("p") >= 4)
    n = F.size("p")
    starts = e.select("id", "p", F.explode(F.sequence(F.lit(0), n - 2)).alias("i"))
    spans = starts.select("id", "i", F.explode(F.sequence(F.col("i") + 2, F.size("p"))).alias("j"), "p")
    spans = spans.select("id", "i", "j", F.array_join(F.slice("p", F.col("i") + 1, F.col("j") - F.col("i")), "").alias("word"))
    hit = spans.join(words, "word", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("j", "i"))).alias("s"))
    # spans by their end: a position can be reached if some span ends there whose start can
    zero = F.array(F.lit(0))
    reach = F.aggregate("s", zero, lambda acc, x: F.when(F.array_contains(acc, x["i"]), F.array_union(acc, F.array(x["j"]))).otherwise(acc))
    j = hit.join(e.select("id", n.alias("n")), "id")
    return j.where(F.array_contains(reach, F.col("n"))).select(F.col("id").alias(row_id))


def one_substitution(entries: DataFrame, words: DataFrame, row_id: str, khmer: str = "khmer") -> DataFrame:
    """``row_id, word, mine, theirs``: list words that differ from the headword in exactly one cluster."""
    a = entries.select(F.col(row_id).alias("id"), X.clusters(X.canonical_marks(X.strip(F.col(khmer)))).alias("p")).where(F.size("p") > 0)
    b = words.select("word", X.clusters(F.col("word")).alias("q"))
    ka, kb = a.select("id", "p", F.explode(deletion_keys(F.col("p"))).alias("key")), b.select("word", "q", F.explode(deletion_keys(F.col("q"))).alias("key"))
    c = ka.join(kb, "key").where(F.size("p") == F.size("q")).dropDuplicates(["id", "word"])
    diff = F.filter(F.zip_with("p", "q", lambda x, y: F.struct(x.alias("mine"), y.alias("theirs"))), lambda d: d["mine"] != d["theirs"])
    c = c.withColumn("d", diff).where(F.size("d") == 1)
    return c.select(F.col("id").alias(row_id), "word", F.col("d")[0]["mine"].alias("mine"), F.col("d")[0]["theirs"].alias("theirs"))


def suspects(entries: DataFrame, words: DataFrame, row_id: str, confusions: DataFrame | None = None, khmer: str = "khmer") -> DataFrame:
    """``row_id, word, mine, theirs, weight``: for headwords the list lacks and that are no compound, the best plausible list word."""
    e = known_words(single_words(entries, khmer), words, khmer, known=False)
    e = e.join(compounds(e, words, row_id, khmer), row_id, "left_anti")
    c = one_substitution(e, words, row_id, khmer)
    only = lambda x, y: F.filter(F.split(x, ""), lambda ch: ~F.contains(F.col(y), ch))
    c = c.withColumn("om", only("mine", "theirs")).withColumn("ot", only("theirs", "mine"))
    one = (F.size("om") == 1) & (F.size("ot") == 1)
    c = c.withColumn("l", F.when(one, F.col("om")[0])).withColumn("r", F.when(one, F.col("ot")[0]))
    if confusions is None:
        c = c.withColumn("weight", F.lit(0).cast("long"))
    else:
        t = confusions.groupBy("from_char", "to_char").agg(F.max("count").cast("long").alias("w"))
        c = c.join(t.toDF("l", "r", "w1"), ["l", "r"], "left").join(t.toDF("r", "l", "w2"), ["l", "r"], "left").withColumn("weight", F.coalesce("w1", "w2", F.lit(0)))
    plausible = (F.col("weight") > 0) | (F.substring("mine", 1, 1) == F.substring("theirs", 1, 1))
    best = c.withColumn("plausible", plausible).groupBy(row_id).agg(F.max(F.struct("plausible", "weight", "word", "mine", "theirs")).alias("b"))
    return best.where("b.plausible").select(row_id, "b.word", "b.mine", "b.theirs", "b.weight")


def subscript_worklist(entries: DataFrame, words: DataFrame, row_id: str, khmer: str = "khmer") -> DataFrame:
    """``row_id, verdict, suggested, inconsistent`` for headwords with either look-alike subscript.

    Pieces the word list has, as they stand or with the subscripts swapped, are
    taken longest first, from the left, without overlap.
    """
    ta, da = "្ត", "្ដ"
    e = entries.select(F.col(row_id).alias("id"), X.canonical_marks(F.coalesce(F.col(khmer), F.lit(""))).alias("t")).where(F.contains("t", F.lit(ta)) | F.contains("t", F.lit(da)))
    twin = e.withColumn("k", F.least("t", X.swap_subscripts(F.col("t")))).groupBy("k").agg(F.count_distinct("t").alias("n")).where("n > 1").select("k")
    spans = e.select("id", "t", F.explode(F.sequence(F.lit(1), F.length("t"))).alias("i")).select("id", "t", "i", F.explode(F.sequence(F.lit(1), F.length("t") - F.col("i") + 1)).alias("n"))
    spans = spans.select("id", "i", "n", F.substring("t", F.col("i"), F.col("n")).alias("piece")).where(F.contains("piece", F.lit(ta)) | F.contains("piece", F.lit(da)))
    both = spans.select("id", "i", "n", F.posexplode(F.array_distinct(F.array("piece", X.swap_subscripts(F.col("piece"))))).alias("o", "word"))
    hit = both.join(words, "word", "left_semi")
    per = hit.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "i", "o", "word"))).alias("s"))
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["i"] < x["i"] - x["m"]) & (x["i"] < y["i"] - y["m"]))
    taken = F.aggregate("s", F.filter("s", lambda x: F.lit(False)), lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(x))).otherwise(acc))
    j = e.join(per, "id", "left").withColumn("taken", F.coalesce(F.array_sort(taken, lambda p, q: p["i"] - q["i"]), F.array().cast("array<struct<m:int,i:int,o:int,word:string>>")))
    fixed = F.aggregate("taken", F.col("t"), lambda acc, x: F.overlay(acc, x["word"], x["i"]))
    j = j.withColumn("fixed", fixed).withColumn("k", F.least("t", X.swap_subscripts(F.col("t"))))
    verdict = F.when(F.size("taken") == 0, "unknown").when(F.col("fixed") == F.col("t"), "ok").otherwise("differs")
    j = j.join(twin.withColumn("twin", F.lit(True)), "k", "left")
    return j.select(F.col("id").alias(row_id), verdict.alias("verdict"), F.when(verdict == "differs", F.col("fixed")).otherwise("").alias("suggested"), F.coalesce("twin", F.lit(False)).alias("inconsistent"))


def ordered_worklist(worklist: DataFrame, entries: DataFrame, row_id: str, source: str = "source") -> DataFrame:
    """The worklist as it is handed out: verdicts differs, unknown, ok, then by source and row, with blank columns for a decision."""
    place = F.array_position(F.array(*[F.lit(v) for v in ("differs", "unknown", "ok")]), F.col("verdict"))
    w = worklist.join(entries.select(row_id, F.col(source).alias("source")), row_id)
    out = w.select(row_id, "source", "verdict", "suggested", F.when(F.col("inconsistent"), "yes").otherwise("").alias("inconsistent"), F.lit("").alias("decision"), F.lit("").alias("notes"))
    return out.orderBy(place, "source", row_id)


def plant_rows(entries: DataFrame, planted: DataFrame, order: str, prefix: str = "official_lex_") -> tuple[DataFrame, DataFrame]:
    """The entries with rows planted behind the last one of the same source, and the ledger (``khmer, id, planted_on``).

    Planted headwords that the lexicon has already are left out.  ``place`` (and
    the order column for the old rows) gives the new file order: a planted row
    has the order of the row it follows, and a higher ``place``.
    """
    from .lexicon import with_ids

    last = entries.agg(F.max(F.regexp_extract("id", "([0-9]+)$", 1).try_cast("long")), F.max(order)).first()
    have = entries.select(X.strip(F.col("khmer")).alias("_k")).where("_k <> ''").distinct()
    new = planted.withColumn("_k", X.strip(F.col("khmer"))).join(have, "_k", "left_anti").drop("_k")
    numbered = new.withColumn("_at", F.row_number().over(Window.orderBy("khmer")))  # a handful of rows
    numbered = with_ids(numbered, "_at", prefix, (last[0] or 0) + 1)
    after = entries.groupBy("source").agg(F.max(order).alias("_after"))
    placed = numbered.join(after, "source", "left").withColumn(order, F.coalesce("_after", F.lit(last[1]))).withColumn("place", F.col("_at")).drop("_after", "_at")
    ledger = placed.select("khmer", "id", F.current_date().alias("planted_on"))
    return entries.withColumn("place", F.lit(0)).unionByName(placed.select(*[c for c in [*entries.columns, "place"] if c in placed.columns]), allowMissingColumns=True), ledger


def planted_terms(texts: DataFrame, planted: DataFrame, text: str = "text", term: str = "term") -> DataFrame:
    """``term, found``: which planted terms stand in a body of text (an audit for copied data)."""
    from .matching import occurrences

    p = planted.select(F.col(term).alias("term")).where(F.length("term") > 0).distinct()
    t = texts.select(F.xxhash64(text).alias("doc_id"), text).dropDuplicates(["doc_id"])
    seen = occurrences(t, p, "doc_id", text).select("term").distinct().withColumn("found", F.lit(True))
    return p.join(seen, "term", "left").select("term", F.coalesce("found", F.lit(False)).alias("found"))
