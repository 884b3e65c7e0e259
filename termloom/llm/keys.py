"""Comparison keys of a lexicon row and the test whether two rows record one term.

Two rows record the same term when the Khmer letters agree in about seven
tenths or more, whatever the spacing, word order or look-alike characters, and
the glosses agree just as closely or one of them is blank.  The Khmer side is
the canonical form reduced to its letters and marks; the gloss side is
lower-cased, without markers, plural endings, punctuation and small words, its
words sorted.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

from .canon import canonical

_KHMER = re.compile("[\\u1780-\\u17d3\\u17dd]+")
_LETTER = re.compile("[\\u1780-\\u17b3]")
_ITEM = re.compile("^\\s*[(\\[]?[0-9\\u17e0-\\u17e9]+[\\s.)\\]\\-\\u2013\\u17d4:>/]*")
_HEADER = re.compile("^.*[12\\u17e1\\u17e2][0-9\\u17e0-\\u17e9]{3}(?:\\s*-\\s*[A-Z]+)?(?:[\\s.|\\u2026]+[0-9\\u17e0-\\u17e9]+)?\\s*$")
_FOLIO = re.compile("^\\W*(?:p\\.|page|\\u1791\\u17c6\\u1796\\u17d0\\u179a)?\\W*[0-9\\u17e0-\\u17e9]+(?:/[0-9\\u17e0-\\u17e9]+)?\\W*$")
_WORD = re.compile("[a-z]+")
# Gloss markers and small words that carry no meaning of their own.
_MARKER = re.compile(r"^\W*(?:(?:en|eng|english|e|h|n|v|adj|adv)\s*[.:)\]]\s*)+")
_TAIL = re.compile(r"\((?:term|n|v|adj|noun|verb|pl|sing|eng?)\.?\)\s*$")
_SMALL = frozenset("a an the to of de du des le la les en eng english term".split())


def khmer_letters(text: str | None, item_prefix: bool = False) -> str:
    """Letters and marks of the canonical form; lines that are page furniture are left out.

    ``item_prefix`` also drops a leading item number.  Fewer than two Khmer
    letters give ``''``.
    """
    if not text:
        return ""
    t = canonical(text)
    if item_prefix:
        t = _ITEM.sub("", t)
    if "\n" in t:
        lines = [x for x in t.split("\n") if x and not _FOLIO.match(x) and not _HEADER.match(x)]
        t = "".join(lines) if lines else t
    out = "".join(_KHMER.findall(t))
    return out if len(out) > 1 and len(_LETTER.findall(out)) > 1 else ""


def gloss_words(text: str | None) -> str:
    """Sorted words of a gloss, without markers, number and small words."""
    if not text:
        return ""
    t = text
    if not t.isascii():
        t = unicodedata.normalize("NFKD", canonical(t) or "")
        t = "".join(c for c in t if not unicodedata.combining(c))
    t = t.lower().strip()
    if "." in t or ":" in t or ")" in t or "]" in t:
        t = _TAIL.sub("", _MARKER.sub("", t))
    words = [w[:-1] if len(w) > 4 and w[-1] == "s" and w[-2] != "s" and w[-3:] != "ics" else w for w in _WORD.findall(t) if len(w) > 1 and w not in _SMALL]
    words.sort()
    return " ".join(words)


def shared(a: str, b: str) -> float:
    """Share of the longer text's characters that the other also has, in any order."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    if min(len(a), len(b)) < 0.6 * n:
        return min(len(a), len(b)) / n
    ca, cb = Counter(a), Counter(b)
    return sum((ca & cb).values()) / n


def _grams(t: str) -> Counter:
    return Counter(t[i : i + 2] for i in range(len(t) - 1))


def gram_dice(a: str, b: str) -> float:
    """Dice coefficient of character pairs: order within words counts, order of words hardly."""
    if a == b:
        return 1.0
    ga, gb = _grams(a), _grams(b)
    n = sum(ga.values()) + sum(gb.values())
    return 2 * sum((ga & gb).values()) / n if n else 0.0


#: Least share of common characters and least agreement of character pairs, by field.
#: Where a gloss is blank the Khmer alone decides, so its pairs must agree better.
KHMER_AGREE, KHMER_ORDER, KHMER_ORDER_ALONE, GLOSS_AGREE, GLOSS_ORDER = 0.7, 0.55, 0.65, 0.75, 0.6


def same_term(ka: str, ga: str, kb: str, gb: str) -> bool:
    """Whether two rows, given by ``khmer_letters`` and ``gloss_words``, record one term."""
    if not ka or not kb:
        return False
    if ka != kb:
        if shared(ka, kb) < KHMER_AGREE:
            return False
        if gram_dice(ka, kb) < (KHMER_ORDER if ga and gb else KHMER_ORDER_ALONE):
            return False
    if not ga or not gb or ga == gb:
        return True
    x, y = ga.replace(" ", ""), gb.replace(" ", "")
    return shared(x, y) >= GLOSS_AGREE and gram_dice(x, y) >= GLOSS_ORDER
