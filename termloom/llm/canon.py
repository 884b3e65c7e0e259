"""One consistent form for text that looks the same (problem 5).

Method: a quick-check pattern finds the places where a text can differ from its
canonical form.  For Unicode normalization it is made of the quick-check
properties themselves, derived from the Unicode database: characters that are not
normalized, that can compose with the one before, or that have a combining class,
and those whose compatibility decomposition only changes width, font, joining
shape or ligature and so shows the same.  To these come the script's own rules
(order of marks, two-part vowels), spaces, invisible characters and look-alikes.
Each such place is widened to the next boundary on either side (a character
that never combines with what stands before it), only this segment is
normalized, and the result is spliced into the otherwise untouched text.  Most
values have no unstable place and cost one pattern search.

Cases: null stays null; an empty or wholly invisible value becomes ``''``;
long texts are handled segment by segment, never cut; the result is a fixed
point (``canonical(canonical(x)) == canonical(x)``).
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Characters without a visible mark (format controls, Khmer inherent vowels).
INVISIBLE = (
    "\\u00ad\\u034f\\u061c\\u115f\\u1160\\u17b4\\u17b5\\u180b-\\u180e\\u200b-\\u200f"
    "\\u202a-\\u202e\\u2060-\\u2064\\u2066-\\u206f\\ufe00-\\ufe0f\\ufeff"
)
# Spaces of any width other than the plain one.
SPACES = "\\t\\u000b\\u000c\\u00a0\\u1680\\u2000-\\u200a\\u202f\\u205f\\u3000"
# Look-alike letters and signs, from public Unicode confusable data.
LOOK_ALIKE = {
    # Thai and Lao vowel signs drawn like the Khmer ones, the ring above, an old letter, hyphens
    "ิ": "ិ", "ี": "ី", "ึ": "ឹ", "ื": "ឺ", "ํ": "ំ",
    "ິ": "ិ", "ີ": "ី", "ຶ": "ឹ", "ື": "ឺ", "ໍ": "ំ",
    "̊": "ំ", "ឣ": "អ", "‐": "-", "‑": "-",
    # Greek capitals
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o",
    # Cyrillic letters
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
}

_BASE = "\\u1780-\\u17b3"
_COENG = "្"
_VOWEL = "\\u17b6-\\u17c5"
_SIGN = "\\u17c6-\\u17c8\\u17cb\\u17cd-\\u17d1\\u17dd"
_SHIFT = "\\u17c9\\u17ca"
_ROBAT = "៌"
#: Compatibility decompositions that show the same: not raised, lowered, encircled or fractions.
SAME_LOOK = ("wide", "narrow", "font", "compat", "noBreak", "initial", "medial", "final", "isolated")


def _unicode_sets() -> tuple[set[int], set[int], dict[int, str]]:
    """Code points that normalization changes, that may belong to the character before, and compatibility forms with what they show."""
    changed, joining, shown = set(), set(), {}
    # without the large blocks of ideographs, syllables and private use, which have no decompositions of their own
    for p in (*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20)):
        c = chr(p)
        d = unicodedata.decomposition(c)
        if unicodedata.combining(c):
            joining.add(p)
        if not d:
            continue
        if d[0] != "<":
            parts = [int(x, 16) for x in d.split()]
            if parts[0] in shown or not unicodedata.is_normalized("NFC", c):
                changed.add(p)
            joining.update(parts[1:])
        elif d[1 : d.index(">")] in SAME_LOOK:
            to = unicodedata.normalize("NFKC", c)
            if not to.startswith(" "):  # a spacing accent is no accent on a space
                shown[p] = to
    # Hangul vowels and final consonants compose by rule
    joining.update(range(0x1161, 0x1176), range(0x11A8, 0x11C3))
    return changed, joining - set(range(0x1780, 0x1800)), shown


_CHANGED, _JOINING, _SHOWN = _unicode_sets()


def _class(points: set[int]) -> str:
    """The points as ranges of a character class."""
    out, run = [], []
    for p in sorted(points):
        if run and p == run[-1] + 1:
            run.append(p)
        else:
            run = [p]
            out.append(run)
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in out)


# Characters that belong to the segment of the base before them.
_JOINS = f"\\u17b4-\\u17d3\\u17dd\\u0e34-\\u0e37\\u0eb4-\\u0eb7{INVISIBLE}{_class(_JOINING)}"

#: Quick check: where this finds nothing the text is canonical already.
UNSTABLE = re.compile(
    f"[{INVISIBLE}{SPACES}\\r{''.join(LOOK_ALIKE)}{_class({p for p in _CHANGED | _JOINING | set(_SHOWN) if p < 0x10000})}\U00010000-\U0010ffff]"
    f"|  +|^ | $| \\n|\\n "
    f"|[{_VOWEL}{_SIGN}{_SHIFT}]{_COENG}"  # a mark before a subscript
    f"|[{_SIGN}][{_VOWEL}{_SHIFT}]|[{_VOWEL}][{_SHIFT}]|[{_SIGN}{_VOWEL}{_SHIFT}]{_ROBAT}"
    f"|\\u17c1[\\u17b6\\u17b8]"  # a two-part vowel
    f"|{_COENG}\\u178a"  # subscript da, drawn like subscript ta
    f"|{_COENG}\\u179a{_COENG}"  # subscript ro before another subscript
    f"|([{_VOWEL}{_SIGN}])\\1"  # a mark typed twice over itself
)
_JOIN_RE = re.compile(f"[{_JOINS}]")
_INVISIBLE_RE = re.compile(f"[{INVISIBLE}]")
_SPACE_RE = re.compile(f"[ {SPACES}]+")
_ODD_SPACE = re.compile(f"[{SPACES}\\r]|  | \\n|\\n |^ | $")
_OWN_RE = re.compile("[\\x00-\\x7f\\u1780-\\u17ff]*")
_TABLE = str.maketrans(LOOK_ALIKE)
_SYLLABLE = re.compile(f"[{_BASE}](?:{_COENG}[{_BASE}]?|[\\u17b6-\\u17d1\\u17dd])+")
_PIECE = re.compile(f"{_COENG}[{_BASE}]?|.")


def _rank(piece: str) -> int:
    c = piece[0]
    if c == _ROBAT:
        return 0
    if c == _COENG:
        return 2 if piece[1:] == "រ" else 1
    if c in "៉៊":
        return 3
    return 4 if "ា" <= c <= "ៅ" else 5


def _syllable(m: re.Match) -> str:
    t = m.group(0)
    pieces = _PIECE.findall(t[1:])
    pieces.sort(key=_rank)
    out = t[0]
    last = ""
    for p in pieces:
        if p == "្ដ":
            p = "្ត"
        if p == last and _rank(p) >= 4:
            continue
        out += p
        last = p
    return out.replace("េា", "ោ").replace("េី", "ើ")


def _segment(t: str) -> str:
    """Canonical form of a segment that starts and ends at boundaries."""
    t = _INVISIBLE_RE.sub("", t)
    if not t.isascii():
        if not t.isascii() and not _OWN_RE.fullmatch(t):
            t = unicodedata.normalize("NFD", t).translate(_SHOWN)
        if not unicodedata.is_normalized("NFC", t):
            t = unicodedata.normalize("NFC", t)
        t = t.translate(_TABLE)  # after NFC: a ring above a Latin letter composes, one above Khmer stays
        t = _SYLLABLE.sub(_syllable, t)
    return t


def canonical(text: str | None) -> str | None:
    """The one form shared by all values that show the same to a reader."""
    if text is None:
        return None
    m = UNSTABLE.search(text)
    if m is None:
        return text
    out: list[str] = []
    done, n = 0, len(text)
    while m is not None:
        a, b = m.start(), m.end()
        # widen to the boundaries: back to the base, forward over all that joins it
        while a > done and (_JOIN_RE.match(text, a) or text[a - 1] == _COENG or _JOIN_RE.match(text, a - 1)):
            a -= 1
        while b < n and (_JOIN_RE.match(text, b) or text[b - 1] == _COENG):
            b += 1
        out.append(text[done:a])
        out.append(_segment(text[a:b]))
        done = b
        m = UNSTABLE.search(text, done) if done < n else None
    out.append(text[done:])
    t = "".join(out)
    if _ODD_SPACE.search(t):
        t = _SPACE_RE.sub(" ", t.replace("\r\n", "\n").replace("\r", "\n"))
        t = t.replace(" \n", "\n").replace("\n ", "\n").strip(" ")
    # Removing an invisible character can bring two stable segments together.
    return t if t == text or UNSTABLE.search(t) is None else canonical(t)


@F.pandas_udf(T.StringType())
def canonical_udf(s: pd.Series) -> pd.Series:
    """``canonical`` over Arrow batches."""
    return pd.Series([canonical(x) if isinstance(x, str) else None for x in s], dtype="object")


def canonical_form(text: Column) -> Column:
    """Canonical form of a column."""
    return canonical_udf(text)


def add_canonical(df: DataFrame, column: str, into: str = "canonical") -> DataFrame:
    """``df`` with the canonical form of ``column`` in ``into``."""
    return df.withColumn(into, canonical_form(F.col(column)))


def same_looking_pairs(df: DataFrame, row_id: str, column: str) -> DataFrame:
    """Pairs of rows whose values differ as code points but show the same.

    Returns ``pos_a < pos_b``.  Null and blank values (also wholly invisible
    ones) are left out, rows with equal code points give no pair, an empty table
    gives none.  Only hashes (128 bits of the canonical form, 64 of the raw one)
    are shuffled.  Written forms are paired first and rows only put in their
    place, so rows with equal values are never joined with one another; classes
    with a single written form are dropped before.
    """
    canon = F.col("_c")
    keyed = (
        df.select(F.col(row_id).cast("long").alias("pos"), F.col(column).alias("_v"))
        .where(F.col("_v").isNotNull() & (F.length("_v") > 0))
        .withColumn("_c", canonical_form(F.col("_v")))
        .where(F.length(canon) > 0)
        .where(~canon.rlike(r"^\s+$"))
        .select("pos", F.xxhash64(canon).alias("k1"), F.xxhash64(canon, F.lit(1)).alias("k2"), F.xxhash64("_v").alias("raw"))
    )
    keyed = materialize(keyed, "looks")
    # written forms of each class; rows that are equal are one form until the end
    forms = keyed.select("k1", "k2", "raw").distinct()
    mixed = forms.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    forms = materialize(forms.join(mixed, ["k1", "k2"], "left_semi"), "looks-forms")
    f, g = forms.withColumnRenamed("raw", "f"), forms.withColumnRenamed("raw", "g")
    two = f.join(g, ["k1", "k2"]).where("f < g")
    rows = keyed.join(forms, ["k1", "k2", "raw"], "left_semi")
    p = two.join(rows.select("k1", "k2", F.col("raw").alias("f"), F.col("pos").alias("p")), ["k1", "k2", "f"])
    p = p.join(rows.select("k1", "k2", F.col("raw").alias("g"), F.col("pos").alias("q")), ["k1", "k2", "g"])
    return p.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b"))
