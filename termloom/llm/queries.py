"""Queries of the training-data operators, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import canon, fusion, incremental, leak, mixing, neardup, ocr, residue, truncation


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.CutValues(table(spark, sf_dir, "unified_lexicon")).cut_rows().withColumnRenamed("pos", "pos_ord")


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's share of cut values, and its field limit if it has one."""
    return truncation.CutValues(table(spark, sf_dir, "unified_lexicon")).by_source()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.TermGroups(table(spark, sf_dir, "unified_lexicon")).row_pairs()


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of a group, with its class id: the form that does not grow with the square of a group."""
    return neardup.TermGroups(table(spark, sf_dir, "unified_lexicon")).membership()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_batches(spark, sf_dir).select("raw_id")


def p3_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated staged rows batch by batch, with the row they repeat (a negative number: a row of the lexicon)."""
    lex, staged = table(spark, sf_dir, "unified_lexicon"), table(spark, sf_dir, "staged_entries")
    return incremental.repeated_batches(lex, staged, "pos_ord", "raw_id", "batch_no").withColumnRenamed("id", "raw_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.ScannedText(table(spark, sf_dir, "unified_lexicon")).found().withColumnRenamed("pos", "pos_ord")


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged values as continuous text."""
    return ocr.ScannedText(table(spark, sf_dir, "unified_lexicon")).repaired().withColumnRenamed("pos", "pos_ord")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.same_looking_pairs(table(spark, sf_dir, "unified_lexicon"), "pos_ord", "khmer")


def p5_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = table(spark, sf_dir, "unified_lexicon")
    return lex.select("pos_ord", canon.canonical_form(F.col("khmer")).alias("khmer"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_survivors(spark, sf_dir).drop("posterior")


def p7_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving row of each field of each group, with the value's posterior."""
    lex = table(spark, sf_dir, "unified_lexicon")
    groups = neardup.TermGroups(lex).membership()
    return fusion.survivors(lex, groups, table(spark, sf_dir, "source_registry"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).drop("cover")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items with the share of the item that the document holds."""
    return leak.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blend: one row per use of a document, in slot order."""
    return mixing.Blend(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).rows


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    return mixing.Blend(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).shares()


def p9_whole_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached shares of a blend as large as the sources allow: those that run out fall short."""
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    return mixing.Blend(docs, targets, total_tokens=2**62).shares()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.Residue(table(spark, sf_dir, "documents")).found()


def p10_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay."""
    docs = table(spark, sf_dir, "documents")
    return docs.join(residue.Residue(docs).found(), "doc_id", "left_anti").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_sources": p1_sources,
    "p2_found": p2_found,
    "p2_classes": p2_classes,
    "p3_found": p3_found,
    "p3_batches": p3_batches,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p5_found": p5_found,
    "p5_canonical": p5_canonical,
    "p7_found": p7_found,
    "p7_survivors": p7_survivors,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p9_blend": p9_blend,
    "p9_shares": p9_shares,
    "p9_whole_shares": p9_whole_shares,
    "p10_found": p10_found,
    "p10_kept": p10_kept,
}
ORACLE_SQL: dict[str, str] = {}
