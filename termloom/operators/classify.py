"""Kind and year of scanned documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Words that name a kind of document.
KIND_WORDS = (
    ("ព្រះរាជក្រឹត្យ", "law-or-decree"), ("ព្រះរាជក្រម", "law-or-decree"), ("អនុក្រឹត្យ", "law-or-decree"), ("សេចក្តីសម្រេច", "law-or-decree"),
    ("ប្រកាស", "law-or-decree"), ("សារាចរ", "law-or-decree"), ("ព្រឹត្តិបត្រ", "bulletin"), ("BULLETIN", "bulletin"),
    ("សទ្ទានុក្រម", "terminology-glossary"), ("LEXICON", "terminology-glossary"), ("វចនានុក្រម", "dictionary"), ("វេយ្យាករណ៍", "grammar"), ("របាយការណ៍", "report"),
)
TITLE_LINES = 12


def title_lines(text: Column) -> Column:
    """The first lines that are not blank."""
    return F.slice(F.filter(F.split(F.coalesce(text, F.lit("")), "\\R"), lambda x: F.length(F.trim(x)) > 0), 1, TITLE_LINES)


def document_kind(lines: Column, words: tuple[tuple[str, str], ...] = KIND_WORDS) -> Column:
    """``struct<kind, word>``: by the word printed earliest; ``other`` without one, ``indeterminate`` without text."""
    text = X.fold_subscripts(F.array_join(lines, " "))
    upper = F.upper(text)
    hits = F.array(*[
        F.struct(F.instr(upper, F.upper(X.fold_subscripts(F.lit(w)))).alias("at"), F.lit(w).alias("word"), F.lit(k).alias("kind")) for w, k in words
    ])
    first = F.array_min(F.filter(hits, lambda h: h["at"] > 0))
    kind = F.coalesce(first["kind"], F.when(F.length(X.strip(text)) > 0, "other").otherwise("indeterminate"))
    return F.struct(kind.alias("kind"), first["word"].alias("word"))


def classify_documents(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """``doc, kind, word, title_area, year`` from page texts: the year is the latest on the last page, else on the first."""
    g = pages.groupBy(doc).agg(F.min_by(text, page).alias("_f"), F.max_by(text, page).alias("_l"))
    top = title_lines(F.col("_f"))
    k = document_kind(top)
    last, first = X.years(F.col("_l")), X.years(F.col("_f"))
    return g.select(
        doc, k["kind"].alias("kind"), k["word"].alias("word"), F.nullif(F.array_join(top, " / "), F.lit("")).alias("title_area"),
        F.coalesce(F.array_max(last), F.array_max(first)).alias("year"),
    )
