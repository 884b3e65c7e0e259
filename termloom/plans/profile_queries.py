"""Queries of the column profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..session import table

#: Columns, and the usual form of their values: glosses without other scripts, short labels without digits.
COLUMNS = ("english", "french", "pos")
USUAL = {"english": "^[\\x00-\\x7f]*$", "french": "^[\\x00-\\u024f]*$", "pos": "^[^0-9]{1,12}$"}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_changes(spark, sf_dir).where("changed").select("load_no", "column_name")


def p6_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discrimination and ablation of every load and column."""
    return profile.load_changes(table(spark, sf_dir, "unified_lexicon"), "load_no", COLUMNS, F.col("pos_ord"))


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact profile of every load and column."""
    return profile.column_profile(table(spark, sf_dir, "unified_lexicon"), "load_no", COLUMNS, USUAL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p6_found": p6_found, "p6_changes": p6_changes, "p6_profile": p6_profile}
ORACLE_SQL = {
    "p6_profile": """
WITH long AS (
  SELECT load_no, 'english' AS column_name, english AS v, NOT regexp_matches(english, '^[\\x00-\\x7F]*$') AS off FROM unified_lexicon
  UNION ALL SELECT load_no, 'french', french, NOT regexp_matches(french, '^[\\x00-\\x{24F}]*$') FROM unified_lexicon
  UNION ALL SELECT load_no, 'pos', pos, NOT regexp_matches(pos, '^[^0-9]{1,12}$') FROM unified_lexicon
), c AS (SELECT load_no, column_name, CASE WHEN trim(coalesce(v, '')) <> '' THEN v END AS v, off FROM long
), g AS (SELECT load_no, column_name, v, count(*) AS n, count(*) FILTER (v IS NOT NULL AND off) AS off FROM c GROUP BY ALL)
SELECT load_no, column_name, CAST(sum(n) AS BIGINT) AS n_rows,
  CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS n_blank, count(v) AS n_distinct,
  min(v) AS least, max(v) AS greatest, min(length(v)) AS shortest, max(length(v)) AS longest,
  max(n) FILTER (v IS NOT NULL) AS most_repeated, CAST(sum(off) AS BIGINT) AS n_violations
FROM g GROUP BY load_no, column_name""",
}
