"""Script-aware string functions, Column to Column, without Python on the executors.

Null stays null unless a docstring says otherwise.  Offsets are zero-based code
points, half-open.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chars

#: One user-perceived character: a Khmer syllable with all its subscripts and marks, else an extended grapheme cluster.
CLUSTER = "([\\u1780-\\u17B3](?:[\\p{Mn}\\u200D]*\\u17D2[\\p{Mn}\\u200D]*[\\u1780-\\u17B3])*[\\p{M}\\u200C\\u200D]*|\\X)"
#: A base with the marks that canonical order may move; other text one character at a time.
_SYLLABLE = "([\\u1780-\\u17B3](?:\\u17D2[\\u1780-\\u17B3]?|[\\u17B6-\\u17D1\\u17DD])*|(?s:.))"
_PIECE = "(\\u17D2[\\u1780-\\u17B3]|(?s:.))"
_MARK_CLASSES = ("^\\u17CC", "^\\u17D2", "^[\\u17C9\\u17CA]", "^[\\u17B6-\\u17C5]", "^[\\u17C6-\\u17C8\\u17CB\\u17CD-\\u17D1\\u17DD]")


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, "(?U)^\\s+|\\s+$", "")


def collapse_space(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(text, "(?U)\\s+", " "))


def clusters(text: Column) -> Column:
    """User-perceived characters as an array."""
    return F.regexp_extract_all(text, F.lit(CLUSTER), F.lit(1))


def cluster_length(text: Column) -> Column:
    """Number of user-perceived characters."""
    return F.size(clusters(text)).cast("long")


def cluster_boundaries(text: Column) -> Column:
    """Code point offsets at which clusters begin, and the end of the text."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(clusters(text), zero, lambda a, c: F.concat(a, F.array(F.element_at(a, -1) + F.length(c))))


def on_boundary(bounds: Column, start: Column, end: Column) -> Column:
    """Whether a span begins and ends between clusters."""
    return F.array_contains(bounds, start.cast("long")) & F.array_contains(bounds, end.cast("long"))


def array_edit_distance(a: Column, b: Column) -> Column:
    """Unit-cost Levenshtein distance of two arrays; one row of the table is folded into the next."""
    first = F.when(F.size(b) > 0, F.transform(F.sequence(F.lit(0), F.size(b)), lambda x: x.cast("int"))).otherwise(F.array(F.lit(0)))

    def row(prev: Column, x: Column) -> Column:
        start = F.array(F.element_at(prev, 1) + 1)

        def cell(acc: Column, t: Column) -> Column:
            j = t["i"]
            cost = F.when(t["v"] == x, 0).otherwise(1)
            best = F.least(F.element_at(acc, -1) + 1, F.element_at(prev, j + 1) + 1, F.element_at(prev, j) + cost)
            return F.concat(acc, F.array(best))

        return F.aggregate(F.transform(b, lambda v, i: F.struct(v.alias("v"), (i + 1).alias("i"))), start, cell)

    return F.element_at(F.aggregate(a, first, row), -1)


def edit_distance(a: Column, b: Column, cutoff: int | None = None) -> Column:
    """Edit distance in clusters; with ``cutoff``, any greater distance is ``cutoff + 1``."""
    ca, cb = clusters(a), clusters(b)
    d = array_edit_distance(ca, cb)
    if cutoff is None:
        return d
    return F.when(F.abs(F.size(ca) - F.size(cb)) > cutoff, F.lit(cutoff + 1)).otherwise(F.least(d, F.lit(cutoff + 1)))


def _of_class(pattern: str):
    return lambda piece: piece.rlike(pattern)


def canonical_marks(text: Column) -> Column:
    """Marks of every syllable in canonical order: robat, subscripts, shifter, vowel, sign; otherwise as they stand."""

    def ordered(syllable: Column) -> Column:
        rest = F.regexp_extract_all(F.substring(syllable, 2, 1 << 30), F.lit(_PIECE), F.lit(1))
        parts = F.flatten(F.array(*[F.filter(rest, _of_class(c)) for c in _MARK_CLASSES]))
        return F.concat(F.substring(syllable, 1, 1), F.array_join(parts, ""))

    whole = F.array_join(
        F.transform(F.regexp_extract_all(text, F.lit(_SYLLABLE), F.lit(1)), lambda s: F.call_function("if", s.rlike("(?s)^.{3}"), ordered(s), s)), ""
    )
    return F.call_function("if", text.rlike("[\\u17B6-\\u17D2\\u17DD]{2}"), whole, text)


def has_khmer(text: Column) -> Column:
    return text.rlike("[\\u1780-\\u17FF]")


def repair_script(text: Column, table: dict[str, str] | None = None) -> Column:
    """Known wrong-script characters replaced by their Khmer counterparts."""
    t = chars.repair_table() if table is None else table
    return F.translate(text, "".join(t), "".join(t.values()))


# Why a character does not belong.
WRONG_SCRIPT, LOOKS_ALIKE, ELSEWHERE, LATIN = (
    "same letter, wrong script", "UTS #39 visual confusable", "outside Khmer, Latin and shared punctuation", "Latin in a Khmer-only field",
)


def character_name(char: Column) -> Column:
    """Unicode name of a character; its code point where it has none."""
    code = F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(char)), 4, "0"))
    return F.coalesce(F.java_method(F.lit("java.lang.Character"), F.lit("getName"), F.ascii(char)), code)


def contaminants(text: Column, allow_latin: bool = True) -> Column:
    """Characters that do not belong in Khmer text: ``array<struct<index, char, name, reason, suggest>>``.

    ``allow_latin=False`` also reports ASCII letters and digits.  ``suggest`` is
    ``''`` where nothing is known.
    """
    shared = "\\u1780-\\u17FF" + chars.SHARED_PUNCTUATION
    wrong = f"[^\\x00-\\x7F{shared}]" if allow_latin else f"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F{shared}]"
    pairs = F.create_map(*[F.lit(x) for kv in chars.repair_table().items() for x in kv])

    def describe(x: Column) -> Column:
        c = x["char"]
        reason = (
            F.when(c.rlike("^[\\x00-\\x7F]$"), LATIN).when(c.isin(list(chars.SAME_LETTER)), WRONG_SCRIPT)
            .when(c.isin(list(chars.DRAWN_ALIKE)), LOOKS_ALIKE).otherwise(ELSEWHERE)
        )
        return F.struct(x["index"].alias("index"), c.alias("char"), character_name(c).alias("name"), reason.alias("reason"), F.coalesce(pairs[c], F.lit("")).alias("suggest"))

    # the characters in question first; most texts have none
    placed = F.transform(F.split(text, ""), lambda c, i: F.struct(i.cast("long").alias("index"), c.alias("char")))
    found = F.transform(F.filter(placed, lambda x: x["char"].rlike(wrong)), describe)
    none = F.lit(None).cast("array<struct<index:bigint,char:string,name:string,reason:string,suggest:string>>")
    return F.when(text.rlike(wrong), found).when(text.isNotNull(), F.coalesce(none, F.array().cast("array<struct<index:bigint,char:string,name:string,reason:string,suggest:string>>")))


def fold_latin(text: Column) -> Column:
    """Search key of Latin text: lower-case letters and digits, doubled pairs and then doubled letters once."""
    t = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")
    t = F.regexp_replace(t, "([a-z]{2})\\1+", "$1")
    return F.regexp_replace(t, "(.)\\1+", "$1")


def romanize(text: Column) -> Column:
    """Latin search key of Khmer text, by sound; not a transcription."""
    table = F.create_map(*[F.lit(x) for kv in chars.SEARCH_LATIN.items() for x in kv])
    digits = F.translate(text, chars.KHMER_DIGITS, "0123456789")
    latin = F.transform(F.split(digits, ""), lambda c: F.coalesce(table[c], F.when(c.rlike("^[A-Za-z0-9]$"), F.lower(c)), F.lit("")))
    return fold_latin(F.array_join(latin, ""))


def fold_subscripts(text: Column) -> Column:
    """The two look-alike subscripts (ta, da) as one."""
    return F.replace(text, F.lit("្ដ"), F.lit("្ត"))


def swap_subscripts(text: Column) -> Column:
    """Each of the two look-alike subscripts for the other."""
    ta, da, mark = F.lit("្ត"), F.lit("្ដ"), F.lit("\u0000")
    return F.replace(F.replace(F.replace(text, ta, mark), da, ta), mark, da)


def subscript_ro_last(text: Column) -> Column:
    """Subscript ro, typed before another subscript, after it."""
    return F.regexp_replace(text, "([\\u1780-\\u17A2])\\u17D2\\u179A\\u17D2([\\u1780-\\u17A2])", "$1្$2្រ")


def clean_khmer(text: Column) -> Column:
    """A headword without its leading number, with known misreadings and wrong-script letters repaired, marks in order."""
    t = strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "^[\\u17E0-\\u17E90-9]+[\\s\\->.)}]*", ""))
    # Misreadings seen in the sources.
    for wrong, right in (("កតិកាសញ្ញដ", "កតិកាសញ្ញា"), ("ដមារ", "ខ្មែរ"), ("ដមរា", "ខ្មែរ")):
        t = F.replace(t, F.lit(wrong), F.lit(right))
    return strip(canonical_marks(repair_script(t)))


def clean_english(text: Column) -> Column:
    """A gloss without its language marker."""
    return strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "^(?iu:Eng\\.|H\\.|អ\\.|អង់\\.)\\s*", ""))


def clean_french(text: Column) -> Column:
    """A gloss without its language marker; a word that only begins with Fr is left whole."""
    return strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "^(?iu:Fr\\.|បារ\\.|Fr\\b(?!\\p{L}))\\s*", ""))


def clean_pos(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def unwrap_hyphens(text: Column) -> Column:
    """Without hyphens between Khmer letters that only mark a line's end."""
    return F.regexp_replace(text, "(?<=[\\u1780-\\u17DD])-\\s+(?=[\\u1780-\\u17DD])", "")


def tight(text: Column) -> Column:
    """For comparison with page text: no spaces, no hyphens between Khmer letters."""
    return F.regexp_replace(F.regexp_replace(text, "(?<=[\\u1780-\\u17DD])-\\s*(?=[\\u1780-\\u17DD])", ""), " ", "")


def split_item(text: Column) -> Column:
    """Leading item number and the rest: ``struct<item, rest>``."""
    pat = "^\\s*([\\u17E0-\\u17E90-9]+)\\s*[-\\u2013\\u2014.]\\s*"
    return F.struct(F.regexp_extract(text, pat, 1).alias("item"), strip(F.regexp_replace(text, pat, "")).alias("rest"))


#: Years that a text can mean.
FIRST_YEAR, LAST_YEAR = 1950, 2049


def years(text: Column) -> Column:
    """Years from 1950 to 2049 that stand alone, in Latin or Khmer digits."""
    t = F.translate(F.coalesce(text, F.lit("")), chars.KHMER_DIGITS, "0123456789")
    four = F.transform(F.regexp_extract_all(t, F.lit("(?<!\\d)(\\d{4})(?!\\d)"), F.lit(1)), lambda y: y.cast("int"))
    return F.filter(four, lambda y: y.between(FIRST_YEAR, LAST_YEAR))


def differing_span(a: Column, b: Column) -> Column:
    """What is left of two texts without their common beginning and end: ``struct<left, right>``."""
    n = F.least(F.length(a), F.length(b))

    def common(x: Column, y: Column, most: Column) -> Column:
        steps = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
        return F.size(F.filter(steps, lambda k: F.substring(x, F.lit(1), k) == F.substring(y, F.lit(1), k)))

    head = common(a, b, n)
    tail = common(F.reverse(a), F.reverse(b), n - head)

    def cut(t: Column) -> Column:
        return F.substring(t, head + 1, F.length(t) - head - tail)

    return F.struct(cut(a).alias("left"), cut(b).alias("right"))


# Parts of speech as the sources write them.
PARTS_OF_SPEECH = {
    "ន.": "noun", "ន": "noun", "noun": "noun", "n.": "noun", "n": "noun", "កិ.": "verb", "កិ": "verb", "verb": "verb", "v.": "verb", "v": "verb",
    "គុ.": "adjective", "adj.": "adjective", "adj": "adjective", "adjective": "adjective",
    "កិ.វិ.": "adverb", "adv.": "adverb", "adv": "adverb", "adverb": "adverb",
    "proper noun": "properNoun", "country": "properNoun", "capital": "properNoun", "city": "properNoun",
    "proper noun (country)": "properNoun", "proper noun (capital)": "properNoun",
}
GENDERS = {"m": "masculine", "m.": "masculine", "(m.)": "masculine", "f": "feminine", "f.": "feminine", "(f.)": "feminine"}


def part_of_speech(text: Column) -> Column:
    """``struct<pos, gender>``: a gender marker means a noun; anything unknown is null."""
    key = F.lower(strip(F.coalesce(text, F.lit(""))))
    pos = F.create_map(*[F.lit(x) for kv in PARTS_OF_SPEECH.items() for x in kv])
    gender = F.create_map(*[F.lit(x) for kv in GENDERS.items() for x in kv])
    return F.struct(F.when(gender[key].isNotNull(), F.lit("noun")).otherwise(pos[key]).alias("pos"), gender[key].alias("gender"))


def gloss_note(english: Column) -> Column:
    """A fixed note where a gloss is missing."""
    return F.when(strip(F.coalesce(english, F.lit(""))) == "", F.lit("no English gloss in the source"))


def content_hash(khmer: Column) -> Column:
    """First eight hex digits of the SHA-256 of the canonical form."""
    return F.substring(F.sha2(canonical_marks(F.coalesce(khmer, F.lit(""))), 256), 1, 8)


def strip_code_fences(text: Column) -> Column:
    """Without the Markdown fence around a model's answer."""
    return strip(F.regexp_replace(strip(text), "^```[A-Za-z]*\\s*|\\s*```$", ""))


def nfc_evidence(spark: SparkSession) -> DataFrame:
    """``typed, other, nfc_equal, nfd_equal, canonical_equal``: why Unicode normalization cannot order Khmer marks.

    Only two characters of the block have a combining class (``n_classed`` of
    ``n_named``), so normalization leaves every other order as it is.
    """
    names = [chr(c) for c in chars.KHMER_BLOCK if unicodedata.name(chr(c), "").startswith("KHMER")]
    pairs = [("ភ្ជាប់", "ភា្ជប់"), ("ក្តី", "កី្ត")]
    same = lambda form, a, b: unicodedata.normalize(form, a) == unicodedata.normalize(form, b)
    rows = [(a, b, same("NFC", a, b), same("NFD", a, b), len(names), sum(bool(unicodedata.combining(c)) for c in names)) for a, b in pairs]
    df = spark.createDataFrame(rows, "typed string, other string, nfc_equal boolean, nfd_equal boolean, n_named int, n_classed int")
    return df.withColumn("canonical_equal", canonical_marks(F.col("typed")) == canonical_marks(F.col("other")))


#: Functions of one text, by the name they get in SQL: result type and Column function.
SQL_FUNCTIONS = {
    "cluster_length": cluster_length, "canonical_marks": canonical_marks, "has_khmer": has_khmer, "repair_script": repair_script, "fold_latin": fold_latin,
    "romanize": romanize, "fold_subscripts": fold_subscripts, "swap_subscripts": swap_subscripts, "clean_khmer": clean_khmer, "clean_english": clean_english,
    "clean_french": clean_french, "content_hash": content_hash,
}


def register_sql(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions callable in ``spark.sql`` as temporary SQL functions, which Catalyst inlines; returns their names."""
    for name, f in SQL_FUNCTIONS.items():
        kind = spark.range(0).select(f(F.lit("x")).alias("y")).dtypes[0][1]
        body = f(F.col("t"))._jc.node().sql()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(t STRING) RETURNS {kind} RETURN {body}")
    return [prefix + n for n in SQL_FUNCTIONS]
