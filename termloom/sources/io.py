"""Reading and writing lexicon data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.lexicon import ENTRY, FIELDS

REGISTRY = "map<string, struct<issuing_body:string,year:string,entries:int,file:string,sha256:string,bytes:bigint,official_url:string,official_page:string,archived_url:string,url_status:string,note:string,title:string>>"
STAGED = "struct<pages: map<string, array<struct<khmer:string,english:string,french:string,pos:string,definition:string,examples:string,item:string,page:int,needs_review:string>>>, complete: boolean, failed_pages: array<int>>"


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = ENTRY) -> DataFrame:
    """A JSON array of entries; missing fields become ``''`` and white space at the ends is dropped."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.select(*[X.strip(F.coalesce(F.col(f.name), F.lit(""))).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema])


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``source`` and its fields from a JSON object with a map ``sources``."""
    df = spark.read.option("wholetext", True).text(path)
    m = F.from_json(F.get_json_object("value", "$.sources"), REGISTRY)
    return df.select(F.explode(m).alias("source", "r")).select("source", "r.*")


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """``source, pages, complete, failed_pages`` of staged source files, named by file."""
    df = spark.read.option("wholetext", True).text(path).withColumn("source", F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)\\.json$", 1))
    return df.select("source", F.from_json("value", STAGED).alias("s")).select("source", "s.*")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def optional_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV that may be missing: then an empty table of the same schema."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return read_csv(spark, path, schema)
    return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``source, page, text`` of text files named ``.../source/page.txt``."""
    df = spark.read.option("wholetext", True).text(path, recursiveFileLookup=True)
    at = F.col("_metadata.file_path")
    return df.select(F.regexp_extract(at, "([^/]+)/[^/]+$", 1).alias("source"), F.regexp_extract(at, "([0-9]+)[^/]*$", 1).try_cast("int").alias("page"), F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, content`` of files, for verification."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "content")


def read_with_fallback(spark: SparkSession, paths: list[str], least_rows: int = 1000) -> DataFrame:
    """The first of several lexicon files that can be read and is not too small."""
    for p in paths:
        try:
            df = read_json_array(spark, p)
            if df.count() >= least_rows:
                return df
        except Exception:  # noqa: BLE001 - any failure means the next path
            continue
    raise FileNotFoundError(", ".join(paths))


def read_event_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Logged events, JSON by line, as a table or a stream."""
    schema = "kind string, time timestamp, client string, query string, category string, had_suggestions boolean, khmer string, entry_id string, source string, message string, contact string"
    return (spark.readStream if streaming else spark.read).schema(schema).json(path)


def parse_model_rows(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Rows from a column with a model's JSON answer; an answer that cannot be parsed gives no rows."""
    row = "array<struct<khmer:string,english:string,french:string,pos:string,definition:string,examples:string,item:string>>"
    parsed = F.from_json(X.strip_code_fences(F.col(answer)), row)
    return df.select(*[c for c in df.columns if c != answer], F.explode(parsed).alias("r")).select(*[c for c in df.columns if c != answer], "r.*")


def confusable_table(spark: SparkSession) -> DataFrame:
    """``char, khmer, reason``: the wrong-script table."""
    from ..functions import chars

    rows = [(k, v, X.WRONG_SCRIPT) for k, v in chars.SAME_LETTER.items()] + [(k, v, X.LOOKS_ALIKE) for k, v in chars.DRAWN_ALIKE.items()]
    return spark.createDataFrame(rows, "char string, khmer string, reason string")


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")


def tbx_concepts(entries: DataFrame, *keep: str) -> DataFrame:
    """``id, xml``: one TBX concept for each entry with a headword; ``keep`` names columns to keep."""
    v = {f: X.strip(F.coalesce(F.col(f), F.lit(""))) if f in entries.columns else F.lit("") for f in FIELDS}
    tag = lambda name, value, attr="": F.when(value != "", F.concat(F.lit(f"<{name}{attr}>"), _xml(value), F.lit(f"</{name}>"))).otherwise("")
    pos = X.part_of_speech(v["pos"])
    empty = F.lit("")
    note = F.concat(tag("termNote", F.coalesce(pos["pos"], empty), ' type="partOfSpeech"'), tag("termNote", F.coalesce(pos["gender"], empty), ' type="grammaticalGender"'))
    use = tag("descrip", v["examples"], ' type="context"')

    def section(lang: str, term: Column, notes: Column, more: Column) -> Column:
        body = F.concat(F.lit(f'<langSec xml:lang="{lang}"><termSec><term>'), _xml(term), F.lit("</term>"), notes, use, F.lit("</termSec>"), more, F.lit("</langSec>"))
        return F.when(term != "", body).otherwise("")

    origin = F.array_join(F.filter(F.array(v["source"], v["author"], v["year"]), lambda x: x != ""), ", ")
    xml = F.concat(
        F.lit('<conceptEntry id="'), _xml(v["id"]), F.lit('">'), tag("descrip", v["category"], ' type="subjectField"'), tag("admin", origin, ' type="source"'),
        section("km", v["khmer"], empty, tag("descrip", v["definition"], ' type="definition"')), section("en", v["english"], note, empty), section("fr", v["french"], note, empty),
        F.lit("</conceptEntry>"),
    )
    return entries.where(v["khmer"] != "").select(*keep, v["id"].alias("id"), xml.alias("xml"))


def tbx_document(entries: DataFrame, order: str, title: str) -> DataFrame:
    """``part, n, xml``: the lines of one TBX file in order: a header, the concepts in file order, a footer."""
    head = (
        '<?xml version="1.0" encoding="UTF-8"?>\n<tbx type="TBX-Basic" style="dca" xml:lang="km" xmlns="urn:iso:std:iso:30042:ed-2">'
        "<tbxHeader><fileDesc><titleStmt><title>{}</title></titleStmt><sourceDesc><p>{}</p></sourceDesc></fileDesc></tbxHeader><text><body>"
    )
    spark = entries.sparkSession
    one = spark.range(1)
    safe = _xml(F.lit(title))
    top = one.select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("n"), F.replace(F.lit(head), F.lit("{}"), safe).alias("xml"))
    body = tbx_concepts(entries, order).select(F.lit(1).alias("part"), F.col(order).cast("long").alias("n"), "xml")
    end = one.select(F.lit(2).alias("part"), F.lit(0).cast("long").alias("n"), F.lit("</body></text></tbx>").alias("xml"))
    return top.unionByName(body).unionByName(end)


def write_tbx(entries: DataFrame, path: str, order: str, title: str) -> None:
    """A TBX document as text files: their lines, in the order of the files' names, are one valid XML document.

    The lines are range-partitioned by file order, so no task holds all of them.
    """
    tbx_document(entries, order, title).orderBy("part", "n").select("xml").write.mode("overwrite").text(path)


def write_json_array(df: DataFrame, path: str, order: str) -> None:
    """Entries as a JSON array over text files, in the order of the files' names: brackets and commas stand where they should."""
    row = F.to_json(F.struct(*[c for c in df.columns if c != order]), {"ignoreNullFields": "false"})
    first = df.agg(F.min(order)).first()[0]
    body = df.select(F.lit(1).alias("part"), F.col(order).alias("n"), F.concat(F.when(F.col(order) > F.lit(first), ",").otherwise(""), row).alias("value"))
    edge = lambda part, c: df.sparkSession.range(1).select(F.lit(part).alias("part"), F.lit(None).cast(dict(df.dtypes)[order]).alias("n"), F.lit(c).alias("value"))
    edge(0, "[").unionByName(body).unionByName(edge(2, "]")).orderBy("part", "n").select("value").write.mode("overwrite").text(path)


def markdown_report(counts: DataFrame, examples: DataFrame, title: str) -> DataFrame:
    """``section, line, text``: a report of checks with their counts and first examples, as Markdown lines."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("/"))
    top = counts.agg(F.lit("").alias("section"), F.lit(0).alias("line"), F.concat(F.lit(f"# {title}: "), F.coalesce(F.sum("n"), F.lit(0)).cast("string")).alias("text"))
    heads = counts.select(F.col("check").alias("section"), F.lit(0).alias("line"), F.concat(F.lit("## "), "check", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("text"))
    rows = examples.select(F.col("check").alias("section"), F.col("rank").alias("line"), F.concat(F.lit("| "), cell("id"), F.lit(" | "), cell("detail"), F.lit(" |")).alias("text"))
    return top.unionByName(heads).unionByName(rows).orderBy("section", "line")
