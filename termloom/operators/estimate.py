"""Stratified samples and error rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

LEAST_PER_STRATUM, SEED = 10, 20260907
GLOSS_MARK = "^\\s*(?:អ\\.|eng\\.|h\\.|-)\\s*"
GLOSS_END = "\\s+(?:បារ\\.|fr\\.).*$"


def allocation(entries: DataFrame, n: int, stratum: str) -> DataFrame:
    """``stratum, size, take``: in proportion, at least ten, at most all; halves are rounded to even."""
    s = entries.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("size"))
    total = F.sum("size").over(Window.partitionBy(F.lit(0)))  # a row for each stratum
    want = F.greatest(F.lit(LEAST_PER_STRATUM), F.bround(F.lit(n) * F.col("size") / total).cast("long"))
    return s.withColumn("take", F.least(want, "size"))


def draw(entries: DataFrame, n: int, stratum: str, row_id: str, seed: int = SEED) -> DataFrame:
    """The same rows at every run: those of least seeded hash in their stratum.

    The hash is uniform, so the rows taken lie below the share of a stratum that
    is wanted, give or take a few standard deviations; rows beyond ten of them
    are dropped before anything is ranked, so no large stratum is sorted.
    """
    a = allocation(entries, n, stratum).withColumnRenamed("stratum", "_s")
    h = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string")), 256)
    e = entries.withColumn("_h", h)
    # as many rows of a stratum have a hash below share * 2^60 as expected, give or take a few standard deviations
    share = F.least(F.lit(1.0), (F.col("take") + 10 * F.sqrt("take") + 30) / F.col("size"))
    j = e.join(a.withColumn("_below", (share * float(2**60)).cast("long")), F.col(stratum).eqNullSafe(F.col("_s")))
    j = j.where(F.conv(F.substring("_h", 1, 15), 16, 10).cast("long") <= F.col("_below"))
    w = Window.partitionBy("_s").orderBy("_h", row_id)
    return j.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("take")).drop("_h", "_s", "_r", "size", "take", "_below")


def metrics_summary(baseline: DataFrame | None, rates: DataFrame | None, pairs: DataFrame | None) -> DataFrame:
    """``section, name, value`` of the reports that exist: quality counts, error rates, near-duplicate pairs; a missing one gives no rows."""
    parts = []
    if baseline is not None:
        parts.append(baseline.select(F.lit("quality").alias("section"), F.col("check").alias("name"), F.col("count").cast("double").alias("value")))
    if rates is not None:
        parts.append(rates.select(F.lit("error rate").alias("section"), F.col("stratum").alias("name"), (F.col("errors") / F.nullif("checked", F.lit(0))).alias("value")))
    if pairs is not None:
        parts.append(pairs.groupBy(F.lit("near duplicates").alias("section"), F.col("reason").alias("name")).agg(F.count("*").cast("double").alias("value")))
    if not parts:
        raise ValueError("no report at all")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tally(judged: DataFrame, verdict: str, stratum: str) -> DataFrame:
    """``stratum, errors, checked``: only y and n count."""
    v = F.lower(F.trim(F.col(verdict)))
    return judged.where(v.isin("y", "n")).groupBy(F.col(stratum).alias("stratum")).agg(F.count_if(v == "n").alias("errors"), F.count("*").alias("checked"))


def wilson(errors: Column, n: Column, z: float = 1.96) -> Column:
    """Wilson score interval: ``struct<p, lo, hi>``, all 0 for no observations."""
    e, m = errors.cast("double"), n.cast("double")
    p = e / F.nullif(m, F.lit(0.0))
    d = 1 + z * z / F.nullif(m, F.lit(0.0))
    mid = (p + z * z / (2 * F.nullif(m, F.lit(0.0)))) / d
    half = z * F.sqrt(p * (1 - p) / F.nullif(m, F.lit(0.0)) + z * z / (4 * F.nullif(m * m, F.lit(0.0)))) / d
    zero = F.lit(0.0)
    some = m > 0
    return F.struct(
        F.when(some, p).otherwise(zero).alias("p"),
        F.when(some, F.greatest(zero, mid - half)).otherwise(zero).alias("lo"),
        F.when(some, F.least(F.lit(1.0), mid + half)).otherwise(zero).alias("hi"),
    )


def weighted_rate(tallied: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rate, n, covers, lo, hi``: strata by their size; those without a judged row are left out, and no judged row gives null."""
    j = sizes.select("stratum", F.col("size").cast("double").alias("size")).join(tallied.where("checked > 0"), "stratum")
    s = j.agg(F.sum("size").alias("covers"), F.sum("checked").alias("n"), F.sum(F.col("size") * F.col("errors") / F.col("checked")).alias("w"))
    r = s.select((F.col("w") / F.col("covers")).alias("rate"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("covers", F.lit(0.0)).cast("long").alias("covers"))
    ci = wilson(F.bround(F.col("rate") * F.col("n")), F.col("n"))
    return r.withColumn("_c", ci).select("rate", "n", "covers", F.when(F.col("rate").isNotNull(), F.col("_c.lo")).alias("lo"), F.when(F.col("rate").isNotNull(), F.col("_c.hi")).alias("hi"))


def _gloss(line: Column) -> Column:
    return X.collapse_space(F.regexp_replace(F.regexp_replace(F.lower(X.strip(line)), GLOSS_MARK, ""), GLOSS_END, ""))


def locate_glosses(entries: DataFrame, pages: DataFrame, row_id: str, gloss: str = "english", source: str = "source") -> DataFrame:
    """``row_id, page``: the first page of the source with a line that is the gloss, alone or with the line after it.

    Only lines that open with a gloss marker count; glosses of up to three characters are not looked for.
    """
    raw = F.filter(F.split("text", "\\R"), lambda x: F.length(F.trim(x)) > 0)
    p = pages.select(F.col(source).alias("_s"), "page", raw.alias("_l"))
    lines = p.select("_s", "page", F.posexplode("_l").alias("i", "line"), "_l")
    lines = lines.withColumn("nxt", F.get("_l", F.col("i") + 1)).drop("_l").where(F.lower("line").rlike(GLOSS_MARK))
    own = lines.select("_s", "page", _gloss(F.col("line")).alias("g"))
    two = lines.where(F.col("nxt").isNotNull() & ~F.lower("nxt").rlike(GLOSS_MARK)).select("_s", "page", _gloss(F.concat_ws(" ", "line", "nxt")).alias("g"))
    first = own.unionByName(two).groupBy("_s", "g").agg(F.min("page").alias("page"))
    e = entries.select(row_id, F.col(source).alias("_s"), X.collapse_space(F.lower(F.coalesce(F.col(gloss), F.lit("")))).alias("g")).where(F.length("g") > 3)
    return e.join(first, ["_s", "g"]).select(row_id, "page")


def relocate_unjudged(sample: DataFrame, pages: DataFrame, row_id: str, verdicts: tuple[str, ...] = ("khmer_ok", "english_ok", "notes")) -> DataFrame:
    """The sample with pages found anew for rows that nobody has judged yet."""
    blank = F.lit(True)
    for v in verdicts:
        blank = blank & (F.trim(F.coalesce(F.col(v), F.lit(""))) == "")
    found = locate_glosses(sample.where(blank), pages, row_id).withColumnRenamed("page", "_p")
    return sample.join(found, row_id, "left").withColumn("page", F.coalesce(F.col("_p"), F.col("page"))).drop("_p")


def anchor_box(paragraphs: Column, item: Column, gloss: Column) -> Column:
    """Box of the paragraph for an entry: by item number, else by its gloss, else by the gloss's first three letters."""
    g = F.lower(F.coalesce(gloss, F.lit("")))
    by_item = F.filter(paragraphs, lambda p: (F.length(F.coalesce(item, F.lit(""))) > 0) & F.startswith(F.trim(p["text"]), item))
    by_gloss = F.filter(paragraphs, lambda p: (F.length(g) > 0) & F.contains(F.lower(p["text"]), g))
    by_stem = F.filter(paragraphs, lambda p: (F.length(g) >= 3) & F.contains(F.lower(p["text"]), F.substring(g, 1, 3)))
    return F.coalesce(F.get(by_item, F.lit(0))["box"], F.get(by_gloss, F.lit(0))["box"], F.get(by_stem, F.lit(0))["box"])
