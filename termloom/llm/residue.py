"""Template residue, filler and error-page texts (problem 10).

Method: placeholder detectors look at the whole text.  For responses that carry
no content the terms of the body are compared with those of the host's address
slug and with the terms that documents with content use: a text of low
information whose terms hardly occur in such documents, that repeats itself, or
whose wording recurs over documents of a host while its slug and title do not
match it, is residue.  Texts that only write about such things use the
collection's own terms for the rest and have enough of them to show it.

Evidence (natural-log odds, summed, decided at 0), of every text of any length:

* share of the text's character 5-grams that content documents use: a gram is
  known if a fixed share of their distinct wordings has it, whatever the size of
  the table, and response pages do not count among them,
* how little it says: letters of known wording, and distinct letters groups among all,
* status codes, navigation lines, version marks and other page chrome,
* message words (errors, maintenance, sessions, scripts, cookies),
* the same wording, numbers aside, in other documents, by host,
* a slug or title term in the body (against).

Cases: null, empty and blank texts hold neither residue nor content and are no
case; a null source is a host of its own; repeated texts are judged alike; very
long texts are searched whole for placeholders; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .canon import canonical
from .sketch import char_shingles

#: A text with at least so many characters has room for content and joins the vocabulary.
CONTENT_LETTERS = 400
#: The letters of a longer text are not counted one by one.
LONG = 1200
#: A longer text whose words are so often the same is no content.
REPEATING = 0.25
GRAM = 5
#: A gram is known if so large a share of the content documents has it, and one besides the text itself.  There are at
#: most (grams of a document) / KNOWN_RATE of them, about 10 MB, at any size of the table.
KNOWN_RATE = 0.0005
#: A text that shares less of its grams is strange, where nearly all content documents share about four tenths more.
USUAL_SHARE = 0.62
#: A text with a message word in every so many letters is a response page and lends no grams.
MESSAGE_EVERY = 150

# The common shapes of unfilled template places.
PLACEHOLDER = re.compile(
    r"\{\{\{?[^{}\n]{1,60}\}\}"
    r"|\$\{[^{}\n]{1,60}\}"
    r"|\{%[^{}\n]{1,60}%\}"
    r"|<%=?[^<>\n]{1,60}%>"
    r"|##[A-Za-z][A-Za-z0-9_. ]{1,40}##"
    r"|__[A-Za-z][A-Za-z0-9_.]{1,40}__"
    r"|%%[A-Za-z][A-Za-z0-9_. ]{1,40}%%|%[A-Z][A-Z0-9_.]{2,40}%|%\([A-Za-z_.]{2,40}\)[sd]"
    r"|@@[A-Za-z][A-Za-z0-9_.]{1,40}@@"
    r"|\[\[[A-Za-z][A-Za-z0-9_. :]{1,40}\]\]"
    r"|\[(?:insert|your|enter|add|put|todo|tbd|tbc)\b[^\[\]\n]{0,50}\]"
    r"|<(?:insert|your|enter|add|put|todo)\b[^<>\n]{0,50}>"
    r"|\[[^\[\]\n]{1,50}\b(?:here|ici|à (?:compl[ée]ter|remplir|ins[ée]rer))\]"
    r"|\[(?:បញ្ចូល|បំពេញ)[^\[\]\n]{0,60}\]"
    r"|\{[a-z]+(?:[_.][a-z]+)+\}|\{[a-z]{3,40}\}",
    re.IGNORECASE,
)
#: What every placeholder contains; most texts have none of it.
_OPENS = re.compile(r"[{$%<\[]|##|__|@@")
# Words of error, maintenance, session and script messages.
MESSAGE = re.compile(
    r"\berror\b|\berreur\b|not found|introuvable|timed? ?out|expir|denied|forbidden|refus|unavailable|indisponible|maintenance|offline"
    r"|javascript|\bscripts?\b|noscript|cookies?|browser|navigateur|try again|r[ée]essay|sign in|log ?in|reconnect|session|too many|rate limit|gateway|upstream"
    r"|requested|activer|enable|turn(?:ed)? on|switched off|server|serveur|status \d{3}|http \d{3}|compiled|fatal|redirect|captcha|blocked"
    r"|សូមបើក|កំហុស|ថែទាំ|សូមព្យាយាម|មិនដំណើរការ|រកមិនឃើញ|សំណើ|អាសយដ្ឋាន|ម៉ាស៊ីន",
    re.IGNORECASE,
)
#: What every message holds in lower case; most texts have none of it.
_MESSAGE_KEYS = (
    "error", "erreur", "not found", "introuvable", "timeout", "time out", "timedout", "timed out", "expir", "denied", "forbidden", "refus", "unavailable", "indisponible",
    "maintenance", "offline", "script", "cookie", "browser", "navigateur", "try again", "essay", "sign in", "login", "log in", "reconnect", "session", "too many", "rate limit",
    "gateway", "upstream", "requested", "activer", "enable", "turn on", "turned on", "switched off", "server", "serveur", "status ", "http ", "compiled", "fatal", "redirect",
    "captcha", "blocked", "សូមបើក", "កំហុស", "ថែទាំ", "សូមព្យាយាម", "មិនដំណើរការ", "រកមិនឃើញ", "សំណើ", "អាសយដ្ឋាន", "ម៉ាស៊ីន",
)
_FILLER_KEYS = ("lorem", "todo", "tbd", "tbc", "n/a", "xxxx", "coming soon", " text")
#: Letters that match others in patterns without case and are not told by ``lower``.
_FOLDS = re.compile("[ſıİK]")
FILLER = re.compile(r"\blorem ipsum\b|\b(?:todo|tbd|tbc|n/a|xxxx|coming soon|sample text|dummy text|placeholder text)\b", re.IGNORECASE)
_FILLER_LINE = re.compile(rf"^\s*(?:{FILLER.pattern})", re.IGNORECASE | re.MULTILINE)
CHROME = re.compile(
    r"^\s*(?:(?:http\s*)?[1-5]\d\d\b.{0,4}$|v?\d+(?:\.\d+)+\s*$|\(ref\.?.{0,40}\)?\s*$|[←<>|«»\-_=.\s]+$|(?:[^\s|]+\s*\|\s*)+[^\s|]+\s*$|(?:error|erreur|http)\s*\d{3}\b)",
    re.IGNORECASE | re.MULTILINE,
)
_LETTERS = re.compile(r"[^\W\d_ក-៓]+|[ក-៓]+")
_NUMBER = re.compile("[0-9\\u17e0-\\u17e9]+")
_SPACE = re.compile(r"\s+")


def plain(text: str) -> str:
    """Lower case, numbers alike, one kind of space."""
    return _SPACE.sub(" ", _NUMBER.sub("#", (canonical(text) or "").lower())).strip()


def body(text: str) -> str:
    """The wording without page chrome, numbers aside: equal for copies of one message."""
    return plain(CHROME.sub(" ", text))


def letters_of(text: str) -> int:
    return sum(map(len, _LETTERS.findall(text)))


def may_have(keys: tuple[str, ...], *texts: str) -> bool:
    """Whether a text of ``texts``, in lower case, holds one of ``keys`` or letters that ``lower`` leaves."""
    return any(k in t for t in texts for k in keys) or any(_FOLDS.search(t) for t in texts if not t.isascii())


def variety(text: str) -> float:
    """Distinct share of the words, or of character 6-grams where there are few words."""
    w = text.split()
    if len(w) >= 8:
        return len(set(w)) / len(w)
    g = [text[i : i + 6] for i in range(max(len(text) - 5, 1))]
    return len(set(g)) / len(g)


def _slug_terms(source: str | None) -> list[str]:
    return [t for t in re.split(r"[^a-z]+", (source or "").lower()) if len(t) > 3]


def _chunks(texts: list[str], letters: int = 500_000) -> Iterator[list[str]]:
    """The texts in runs of about so many letters."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= letters:
            yield run
            run, n = [], 0
    if run:
        yield run


class Residue:
    """Judgement of every document; ``judged`` has ``doc_id, placeholder, score, residue``."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"):
        read = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"), F.col(text).alias("t")).where(F.length(F.trim("t")) > 0)

        def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from xxhash import xxh64_intdigest

            for b in batches:
                out = []
                for i, s, t in zip(b["id"], b["source"], b["t"]):
                    p = plain(t)
                    letters = len(t) if len(t) > LONG else letters_of(t)
                    low = t.lower()
                    said, fill = may_have(_MESSAGE_KEYS, low, p), may_have(_FILLER_KEYS, low)
                    words = [m.group(0).lower() for m in MESSAGE.finditer(t)] if said else []
                    chrome = len(CHROME.findall(t))
                    w, v = body(t) if chrome else p, variety(p)
                    title = plain(t.strip().split("\n", 1)[0]) if said else ""
                    content = len(t) >= CONTENT_LETTERS and v >= REPEATING and not (fill and _FILLER_LINE.search(t)) and len(words) * MESSAGE_EVERY < letters
                    out.append(
                        (i, s, letters, bool(_OPENS.search(t)) and bool(PLACEHOLDER.search(t)), xxh64_intdigest(w) - 2**63, v, len(set(words)), fill and bool(FILLER.search(t)),
                         chrome, any(k in p for k in _slug_terms(s)), bool(MESSAGE.search(title) or CHROME.match(t)), content, p)
                    )
                yield pd.DataFrame(out, columns=[x.split()[0] for x in columns.split(", ")])

        columns = (
            "id long, source string, letters int, placeholder boolean, wording long, variety double, messages int, filler boolean, "
            "chrome int, slug_match boolean, title_message boolean, content boolean, p string"
        )
        seen = materialize(read.mapInPandas(first, columns), "residue-first")

        def vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for t in _chunks(b["p"].tolist()):
                    r, h = char_shingles(t, GRAM, seed=21)
                    # a gram counts once for each document
                    each = [np.unique(x) for x in np.split(h.view(np.int64), np.flatnonzero(np.diff(r)) + 1)]
                    g, n = np.unique(np.concatenate(each), return_counts=True)
                    yield pd.DataFrame({"g": g, "n": n})

        content = seen.where("content")
        # copies of a text count once
        leader = content.groupBy("wording").agg(F.min("id").alias("leader"), F.count("*").alias("copies"))
        n_content = leader.count()
        again = content.join(leader.where("copies > 1").select("wording", "leader"), "wording").where("id <> leader").select("id")
        counts = content.join(again, "id", "left_anti").select("p").mapInPandas(vocabulary, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
        known = np.sort(counts.where(F.col("n") >= max(2.0, KNOWN_RATE * n_content)).select("g").toPandas()["g"].to_numpy(np.int64))

        def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                share = []
                for t in _chunks(b["p"].tolist()):
                    r, h = char_shingles(t, GRAM, seed=21)
                    g = h.view(np.int64)
                    at = np.searchsorted(known, g)
                    hit = known[np.minimum(at, len(known) - 1)] == g if len(known) else np.zeros(len(g), bool)
                    share.append(np.bincount(r, hit, len(t)) / np.maximum(np.bincount(r, minlength=len(t)), 1))
                yield b.drop(columns="p").assign(known_share=np.concatenate(share) if share else np.zeros(0))

        of_text = seen.drop("placeholder")
        ev = of_text.mapInPandas(shares, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in of_text.schema if f.name != "p") + ", known_share double")
        ev = materialize(ev, "residue-evidence")
        # what content documents of this table share with one another: less in a small one
        low = ev.where("content").agg(F.percentile_approx("known_share", 0.05)).first()[0]
        usual = USUAL_SHARE if low is None else max(0.01, min(USUAL_SHARE, 0.7 * low))
        # the same wording over all documents, and over one host
        same = ev.groupBy("wording").agg(F.count("*").alias("copies"))
        host = ev.groupBy("source").agg(F.avg((F.coalesce("known_share", F.lit(0.0)) < 0.5).cast("double")).alias("host_odd"))
        ev = ev.join(same, "wording").join(host, ev.source.eqNullSafe(host.source)).drop(host.source)
        known_share = F.coalesce("known_share", F.lit(0.0))
        self.scores = ev.withColumn(
            "score",
            (usual - known_share) * 12
            + F.when(F.col("variety") < 0.35, 5.0).when(F.col("variety") < 0.5, 2.0).otherwise(0.0)
            + F.least(F.col("messages"), F.lit(3)) * F.least(F.lit(1.0), 180 / F.greatest(F.col("letters"), F.lit(1)))
            + F.when(F.col("filler"), 2.5).otherwise(0.0)
            + F.least(F.col("chrome"), F.lit(3)) * 0.7
            + F.when(F.col("title_message"), 1.0).otherwise(0.0)
            + F.when((F.col("copies") > 1) & (known_share < 0.8), 1.0).otherwise(0.0)
            + F.col("host_odd") * 0.5
            - F.when(F.col("slug_match"), 1.0).otherwise(0.0)
            - F.when((F.col("variety") < REPEATING) | F.col("filler"), 0.0).otherwise(
                F.greatest(F.col("letters") * F.least(F.lit(1.0), 0.7 * known_share / usual) - 250, F.lit(0)) / 60.0)
            - 1.5,
        )
        flagged = self.scores.select("id", "score")
        j = seen.select("id", "placeholder").join(flagged, "id", "left")
        self.judged = j.select(
            F.col("id").alias("doc_id"), "placeholder", "score", (F.col("placeholder") | (F.coalesce("score", F.lit(-9.0)) > 0)).alias("residue")
        )

    def found(self) -> DataFrame:
        return self.judged.where("residue").select("doc_id")
