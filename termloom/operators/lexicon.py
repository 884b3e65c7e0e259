"""Cleaning, merging and numbering lexicon entries.

Order is data: every operator takes the column that holds the file order, and
"first wins" always means the smallest value of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as X

FIELDS = ("id", "english", "khmer", "french", "pos", "category", "definition", "examples", "source", "author", "version", "year")
ENTRY = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
# Words of page headers that were read as entries.
HEADER_WORDS = ("រាជបណ្ឌិត្យសភាកម្ពុជា", "សូមថ្លែងអំណរគុណ", "CONCH")
MAX_CLUSTERS = 30


def _v(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def clean_entries(entries: DataFrame) -> DataFrame:
    """Entries with all text fields cleaned; those without headword and gloss, and page headers, left out."""
    e = entries.withColumns({
        "khmer": X.clean_khmer(F.col("khmer")), "english": X.clean_english(F.col("english")), "french": X.clean_french(F.col("french")),
        "pos": X.clean_pos(F.col("pos")), "definition": X.strip(_v("definition")), "examples": X.strip(_v("examples")),
    })
    header = F.lit(False)
    for w in HEADER_WORDS:
        header = header | F.contains("khmer", F.lit(w))
    return e.where(((F.col("khmer") != "") | (F.col("english") != "")) & ~header)


def pair_key(english: str = "english", khmer: str = "khmer") -> Column:
    return F.concat(F.lower(_v(english)), F.lit("|"), F.lower(_v(khmer)))


def first_wins(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key.  The minimum is an aggregate; no group is sorted or collected."""
    keyed = df.withColumn("_key", key)
    first = keyed.groupBy("_key").agg(F.min(order).alias(order))
    return keyed.join(first, ["_key", order], "left_semi").drop("_key")


def dense_number(df: DataFrame, order: str, into: str = "n", start: int = 1, chunk: int = 65_536) -> DataFrame:
    """Consecutive numbers in the given order, without sorting all rows in one task.

    Rows are counted by ranges of the order column first; each range then only
    adds what stands before it.
    """
    c = df.withColumn("_c", F.floor(F.col(order) / chunk))
    counts = c.groupBy("_c").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return c.join(before, "_c").withColumn(into, F.row_number().over(Window.partitionBy("_c").orderBy(order)) + F.col("_b") + (start - 1)).drop("_c", "_b")


def with_ids(df: DataFrame, order: str, prefix: str = "official_lex_", start: int = 1) -> DataFrame:
    """Sequential ids in file order: at least four digits."""
    n = dense_number(df, order, "_no", start)
    return n.withColumn("id", F.concat(F.lit(prefix), F.when(F.col("_no") < 10_000, F.lpad(F.col("_no").cast("string"), 4, "0")).otherwise(F.col("_no").cast("string")))).drop("_no")


def build(entries: DataFrame, order: str) -> DataFrame:
    """Clean, keep the first of each gloss and headword, number."""
    return with_ids(first_wins(clean_entries(entries), pair_key(), order), order)


def shrink_guard(new: DataFrame, previous: int, least: float = 0.9) -> DataFrame:
    """``new``, unless it lost more than a tenth of the previous rows."""
    n = new.count()
    if n < least * previous:
        raise ValueError(f"{n} rows where there were {previous}")
    return new


def with_default_source(df: DataFrame, default: str) -> DataFrame:
    return df.withColumn("source", F.coalesce(F.nullif(X.strip(_v("source")), F.lit("")), F.lit(default)))


def concat_sources(parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """All parts under one another, each with its default source, nothing removed."""
    out = None
    for df, default in parts:
        d = with_default_source(df, default)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    if out is None:
        raise ValueError("no parts")
    return out


def headword_rejection(khmer: Column) -> Column:
    """Why a cleaned headword is no headword; null for a usable or an empty one."""
    k = F.coalesce(khmer, F.lit(""))
    return (
        F.when(k == "", F.lit(None)).when(~X.has_khmer(k), "no Khmer").when(k.rlike("[0-9]") | (F.size(X.contaminants(k)) > 0), "OCR junk characters")
        .when(X.cluster_length(k) > MAX_CLUSTERS, "definition text in headword").when(k.rlike("^[\\u1780-\\u17A2]$"), "single bare consonant")
    )


def append_merge(kept: DataFrame, staged: DataFrame, order: str, excluded: DataFrame | None = None, prefix: str = "official_lex_") -> tuple[DataFrame, DataFrame]:
    """Staged sources appended to a lexicon, and ``status, n`` of what became of the staged rows.

    Earlier rows of the staged sources are dropped first, so a second run gives
    the same.  ``excluded`` lists pages (``source, page``) to leave out.  New ids
    follow the largest kept one.
    """
    sources = staged.select("source").distinct()
    old = kept.join(sources, "source", "left_anti")
    s = staged.withColumn("khmer", X.subscript_ro_last(X.clean_khmer(F.col("khmer")))).withColumn("english", X.clean_english(F.col("english")))
    if excluded is not None:
        s = s.join(excluded.select("source", "page", F.lit(True).alias("_ex")), ["source", "page"], "left")
    else:
        s = s.withColumn("_ex", F.lit(None).cast("boolean"))
    empty = (F.col("khmer") == "") & (F.col("english") == "")
    bad = headword_rejection(F.col("khmer")).isNotNull()
    header = F.lit(False)
    for w in HEADER_WORDS:
        header = header | F.contains("khmer", F.lit(w))
    s = s.withColumn("_status", F.when(F.col("_ex"), "excluded_page").when(empty | bad | header, "skipped")).withColumn("_key", pair_key())
    have = old.select(pair_key().alias("_key")).distinct().withColumn("_old", F.lit(True))
    first = s.where(F.col("_status").isNull()).groupBy("_key").agg(F.min(order).alias("_first"))
    s = s.join(have, "_key", "left").join(first, "_key", "left")
    s = s.withColumn("_status", F.coalesce("_status", F.when(F.col("_old") | (F.col("_first") < F.col(order)), "duplicate"), F.lit("added")))
    stats = s.groupBy(F.col("_status").alias("status")).agg(F.count("*").alias("n"))
    last = old.agg(F.max(F.regexp_extract("id", "([0-9]+)$", 1).try_cast("long"))).first()[0] or 0
    added = with_ids(s.where("_status = 'added'"), order, prefix, last + 1).drop("_status", "_key", "_ex", "_old", "_first")
    return old.unionByName(added.select(*[c for c in old.columns if c in added.columns]), allowMissingColumns=True), stats


def require_complete(staged_states: DataFrame, rows: DataFrame, floor: int) -> None:
    """Stop unless every staged source is complete and there are enough rows."""
    open_ = [r[0] for r in staged_states.where("not complete").select("source").limit(20).collect()]
    if open_:
        raise ValueError(f"incomplete: {open_}")
    if rows.count() < floor:
        raise ValueError("too few rows: the wrong file was read")


def staged_pages(states: DataFrame) -> DataFrame:
    """``source, page, at, entry``: the entries of staged page maps in page and entry order."""
    p = states.select("source", F.explode("pages").alias("page", "entries"))
    return p.select("source", F.col("page").cast("int").alias("page"), F.posexplode("entries").alias("at", "entry"))


def recover_pages(staged: DataFrame, recovered: DataFrame, order: str) -> DataFrame:
    """Recovered rows appended that the staging lacks, the first of equals; running it twice adds nothing."""
    key = F.concat(X.strip(_v("khmer")), F.lit("|"), F.lower(X.strip(_v("english"))))
    new = first_wins(recovered, key, order)
    return staged.unionByName(new.withColumn("_k", key).join(staged.select(key.alias("_k")).distinct(), "_k", "left_anti").drop("_k"), allowMissingColumns=True)


def first_by_gloss(entries: DataFrame, order: str) -> DataFrame:
    """First entry of each gloss, sorted by gloss."""
    e = entries.withColumn("_g", F.lower(X.strip(_v("english")))).where("_g <> ''")
    return first_wins(e, F.col("_g"), order).orderBy("_g").drop("_g")


def standard_columns(df: DataFrame, english: str = "en", khmer: str = "kh") -> DataFrame:
    """The full set of entry columns, blank where there is nothing."""
    have = {"english": F.col(english), "khmer": F.col(khmer)}
    return df.select(*[F.coalesce(have[f] if f in have else (F.col(f) if f in df.columns else F.lit("")), F.lit("")).alias(f) for f in FIELDS])


def tidy_extracted(rows: DataFrame) -> DataFrame:
    """Extracted rows with layout taken out, item numbers in ``item`` and unread headwords marked; empty rows left out."""
    text = ("english", "khmer", "french", "pos", "definition", "examples")
    d = rows.withColumns({c: X.collapse_space(_v(c)) for c in text})
    d = d.withColumn("khmer", X.unwrap_hyphens(F.col("khmer")))
    only = lambda c: X.has_khmer(F.col(c)) & ~F.col(c).rlike("[A-Za-z]")
    d = d.withColumns({c: F.when(only(c), "").otherwise(F.col(c)) for c in ("english", "french")})
    d = d.withColumn("_i", X.split_item(F.col("khmer")))
    d = d.withColumn("item", F.coalesce(F.nullif(X.strip(_v("item")), F.lit("")), F.col("_i.item"))).withColumn("khmer", F.col("_i.rest")).drop("_i")
    some = F.lit(False)
    for c in text:
        some = some | (F.col(c) != "")
    review = F.when(F.col("khmer") == "", "headword not read by OCR").otherwise(F.col("needs_review") if "needs_review" in rows.columns else F.lit(None))
    return d.where(some).withColumn("needs_review", review)


def verify_against_pages(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows with ``needs_review`` set where the headword opens no line of its page; a reason that is there stays.

    ``pages`` has ``source, page, text``.  Each line is taken with the two after
    it, without its item number, spaces and wrap hyphens.
    """
    item = "^\\s*\\(?[\\u17E0-\\u17E90-9]{1,3}\\)?\\s*[-\\u2013\\u2014.:|\\u2192]?\\s*"
    raw = F.filter(F.split("text", "\\R"), lambda x: F.length(F.trim(x)) > 0)
    p = pages.select("source", "page", raw.alias("raw"))
    bare = F.transform("raw", lambda x: F.regexp_replace(F.regexp_replace(x, item, ""), "^[-\\u2013\\u2014 ]+", ""))
    p = p.withColumn("bare", bare)
    windows = F.transform("bare", lambda x, i: X.tight(F.array_join(F.slice(F.col("bare"), i + 1, F.lit(3)), "")))
    p = p.select("source", "page", windows.alias("_w"), X.tight(F.array_join("raw", "")).alias("_p"))
    forms = F.transform(F.filter(F.split(_v("khmer"), "/"), lambda x: F.length(F.trim(x)) > 0), X.tight)
    j = rows.withColumn("_f", forms).join(p, ["source", "page"], "left")
    opens = F.exists("_w", lambda w: F.startswith(w, F.col("_f")[0]))
    present = F.forall("_f", lambda f: F.contains(F.col("_p"), f))
    wrong = F.col("_w").isNotNull() & (F.size("_f") > 0) & ~(opens & present)
    review = F.col("needs_review") if "needs_review" in rows.columns else F.lit(None).cast("string")
    return j.withColumn("needs_review", F.coalesce(review, F.when(wrong, "headword does not match the page OCR"))).drop("_f", "_w", "_p")


def redo_failed(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """New values where there are any, else the old ones."""
    return old.join(new.withColumnRenamed(value, "_new"), key, "left").withColumn(value, F.coalesce("_new", value)).drop("_new")


def pending(work: DataFrame, done: DataFrame, key: list[str], ok: Column | None = None) -> DataFrame:
    """Work whose key is not done (or done without success)."""
    d = done.where(ok) if ok is not None else done
    return work.join(d.select(*key).distinct(), key, "left_anti")
