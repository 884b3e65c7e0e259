"""Traces of page layout and misreading in scanned text, and their repair (problem 4).

Method: page furniture (running headers, page numbers) and words broken over
lines are taken out by line rules.  What may be misread is looked up in a
symmetric-delete index over the corpus, of two kinds.  Latin words, with odd
characters or rare ones, meet a lexicon word when deleting up to ``DELETES``
characters from each can make them equal.  Khmer is written without spaces, so
there the index is over windows: an odd character and what stands in its place
elsewhere meet when the three characters on either side are equal, whatever the
length of the word.  A weighted edit distance, in which known confusion pairs are
cheap, the frequency of the candidate and its bigrams with the neighbouring words
over the whole corpus (the window itself, for Khmer) choose the repair.

The index also decides what is misread.  A rare Latin word is a case if a word
far more frequent is one cheap confusion away and fits the neighbouring words at
least as well.  A word or window with odd characters is none if the corpus
attests it: it is common and more frequent than any repair.  All thresholds are
rates and ratios, so they mean the same at any size of the table.

Cases: null and blank values are neither damaged nor repaired; a break between
two finished sentences, a bracketed Latin word and ordinary numerals are left
alone; very long texts are read whole; equal texts are repaired alike; an empty
table gives an empty result.  Words of over 40 letters are matched with one
deletion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sketch import char_shingles, combine

# Characters that scanners put in place of one another.
CONFUSIONS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("|", "l"), ("|", "i"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("$", "s"),
    ("c", "e"), ("e", "c"), ("rn", "m"), ("m", "rn"), ("c1", "d"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("ii", "u"), ("l", "i"), ("i", "l"), ("h", "b"), ("n", "u"), ("u", "n"), ("f", "t"), ("li", "h"),
]
DELETES = 2
#: Least share of the corpus' Latin words that a word needs to repair an odd one, and to make a rare look-alike a case:
#: there are at most 1 / rate such words, which bounds what is sent to the tasks.
REPAIR_RATE, CERTAIN_RATE = 2e-6, 1e-4
#: A word is a misreading of one so many times as frequent, if that is one cheap confusion away; what a repair may cost at most.
RARE_RATIO, CHEAP, DEAR = 10, 0.45, 1.0
#: A word or window with odd characters is attested from this share of all words on, seen five times at least.
ATTESTED_RATE, ATTESTED_LEAST = 2e-5, 5
#: Characters on either side of a window; weight of a candidate's bigrams and of its frequency, in units of cost.
CONTEXT, BIGRAM_WEIGHT, FREQUENCY_WEIGHT = 3, 0.35, 0.1
#: Up to so many window keys (16 MB) are sent to the tasks that scan the corpus; more are joined.
SEND_KEYS = 2_000_000

_KM = "\\u1780-\\u17d3\\u17dd"
_ODD = "0-9A-Za-z\\u00a2-\\u00a9\\u00ac\\u00ae-\\u00b6\\u2022{}^~|*+=<>@#$%&_\\\\\\u00a6"
_BRACKETED = re.compile("\\([^()\\n]{0,40}\\)?")
_ODD_KHMER = re.compile(f"[{_KM}][{_ODD}]|[{_ODD}][{_KM}]")
_ODD_LATIN = re.compile(r"[A-Za-z][0-9!|$]+[A-Za-z]|(?<![A-Za-z0-9])[0-9!|$]+[a-z]{2}|[a-z]{2}[0-9|$]+(?![A-Za-z0-9])|[a-z]{2}!(?=[a-z])")
_BROKEN = re.compile(f"[{_KM}A-Za-z][0-9!]? ?[-\\u2010\\u2011\\u00ad][ \\t]*\\r?\\n|[{_KM}]-[ \\u00a0](?=[{_KM}])|[a-z]- (?=[a-z])|[{_KM}a-z]\\u00ad\\s")
_FOLIO = re.compile("^[\\W_]*(?:p\\.?|pp\\.?|page|\\u1791\\u17c6\\u1796\\u17d0\\u179a)?[\\W_]*[0-9\\u17e0-\\u17e9]{1,4}(?:\\s*/\\s*[0-9\\u17e0-\\u17e9]{1,4})?[\\W_]*$", re.I)
_HEADER = re.compile("^(?:\\u1791\\u17c6\\u1796\\u17d0\\u179a\\s.*|[^\\u17d4.!?]*\\s[12\\u17e1\\u17e2][0-9\\u17e0-\\u17e9]{3}(?:\\s*-\\s*[A-Z]{2,6})?(?:[\\s.|\\u2026]+[0-9\\u17e0-\\u17e9]{1,4})?)\\s*$")
_ENDED = re.compile("[\\u17d4\\u17d5\\u17d6.!?:;)\\]\"\\u00bb]\\s*$")
_BREAK_TAIL = re.compile(" ?[-\\u2010\\u2011\\u00ad][ \\t]*$")
_LATIN = re.compile("!?[A-Za-z0-9|$\\u00c0-\\u024f]+(?:![A-Za-z0-9|$\\u00c0-\\u024f]+)*")
_ODD_RUN = re.compile(f"(?<=[{_KM}])[{_ODD}]+|[{_ODD}]+(?=[{_KM}])")
#: What every damaged value has; most Khmer values have none of it and are not looked at by Python.
_QUICK = f"[\\n\\r!\\-\\u2010\\u2011\\u00ad]|[{_ODD}]"


def furniture(line: str) -> bool:
    """Whether a line of a longer text is a running header or a page number."""
    return bool(_FOLIO.match(line) or _HEADER.match(line))


def layout_damage(text: str) -> bool:
    """Words broken over lines, running headers or page numbers."""
    if _BROKEN.search(text):
        return True
    if "\n" not in text and "\r" not in text:
        return False
    lines = [x for x in re.split("[\\r\\n]+", text) if x.strip()]
    if len(lines) < 2:
        return False
    if any(furniture(x) for x in lines):
        return True
    # a line that stops inside a sentence
    return any(not _ENDED.search(x) for x in lines[:-1])


def misread(text: str) -> bool:
    """Characters inside words that do not belong there."""
    t = _BRACKETED.sub(" ", text) if "(" in text else text
    return bool(_ODD_KHMER.search(t) or _ODD_LATIN.search(t))


def rejoin(text: str) -> str:
    """Readable paragraphs: furniture out, broken words together; a break between finished sentences stays, unless a page ended there."""
    lines = re.split("\\r?\\n|\\r", text)
    lines = [x for x in lines if x.strip()] if len(lines) > 1 else lines
    out, page = "", False
    for x in lines:
        if len(lines) > 1 and furniture(x):
            page = True  # the text goes on behind it
            continue
        page, turned = False, page
        if not out:
            out = x
        elif _BREAK_TAIL.search(out):
            out = _BREAK_TAIL.sub("", out) + x.lstrip()
        elif _ENDED.search(out):
            out = out.rstrip() + (" " if turned else "\n") + x.lstrip()
        elif out[-1:].isspace() or x[:1].isspace() or out[-1:].isascii() and x[:1].isascii() and x[:1].isupper():
            out = out.rstrip() + " " + x.lstrip()
        else:
            out += x
    out = re.sub(f"(?<=[{_KM}])-[ \\u00a0](?=[{_KM}])|(?<=[a-z])- (?=[a-z])|\\u00ad\\s*", "", out)
    return re.sub("[ \\t]+", " ", out).strip()


def _weights() -> dict[tuple[str, str], float]:
    return {(a, b): 0.2 for a, b in CONFUSIONS}


_W = _weights()


def weighted_distance(seen: str, word: str) -> float:
    """Edit distance from what was read to a word; confusion pairs cost 0.2, an odd character in place of any 0.4."""
    n, m = len(seen), len(word)
    d = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        d[i][0] = float(i)
    for j in range(1, m + 1):
        d[0][j] = float(j)
    odd = re.compile(f"[{_ODD}]") if not word.isascii() else re.compile("[0-9!|$]")
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            a, b = seen[i - 1], word[j - 1]
            sub = 0.0 if a == b else _W.get((a, b), 0.4 if odd.match(a) else 1.0)
            best = min(d[i - 1][j - 1] + sub, d[i - 1][j] + 1, d[i][j - 1] + 1)
            if i > 1:
                best = min(best, d[i - 2][j - 1] + _W.get((seen[i - 2 : i], b), 9.0))
            if j > 1:
                best = min(best, d[i - 1][j - 2] + _W.get((a, word[j - 2 : j]), 9.0))
            d[i][j] = best
    return d[n][m]


def deletions(word: str, k: int = DELETES) -> set[str]:
    """The word and all that remains after deleting up to ``k`` characters (one in words of under six or over 40)."""
    out = {word}
    last = {word}
    for _ in range(k if 5 < len(word) <= 40 else 1):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


def _values(df: DataFrame, row_id: str, fields: tuple[str, ...]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])).alias("v")
    return df.select(F.col(row_id).cast("long").alias("pos"), each).select("pos", "v.*").where(F.length("text") > 0)


def delete_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Position of the word and hashed key, for every deletion of every word."""
    from xxhash import xxh64_intdigest

    at, keys = [], []
    for i, w in enumerate(words):
        d = deletions(w)
        at.extend([i] * len(d))
        keys.extend(map(xxh64_intdigest, d))
    return np.array(at, dtype=np.int64), np.array(keys, dtype=np.uint64).view(np.int64)


def windows(texts: list[str], middle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, offset and key of every stretch of ``middle`` characters, told by the characters on either side of it."""
    edge = "\x02" * CONTEXT
    rows, h = char_shingles([edge + t + edge for t in texts], CONTEXT, seed=31)
    far = CONTEXT + middle
    if len(rows) <= far:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    j = np.flatnonzero(rows[:-far] == rows[far:])
    first = np.searchsorted(rows, np.arange(len(texts)))
    return rows[j], j - first[rows[j]], combine(h[j], h[j + far]).view(np.int64)


def odd_latin(text: str) -> list[str]:
    """Latin words with odd characters in them, lower case, brackets left out."""
    t = _BRACKETED.sub(" ", text) if "(" in text else text
    return [w for w in map(str.lower, _LATIN.findall(t)) if _ODD_LATIN.search(w)] if _ODD_LATIN.search(t) else []


def odd_windows(texts: list[str]) -> list[tuple[int, int, str, int]]:
    """Text, offset, characters and window key of every run of odd characters next to Khmer letters."""
    found: dict[int, list[tuple[int, int, str]]] = {}
    for i, t in enumerate(texts):
        bracket = [m.span() for m in _BRACKETED.finditer(t)] if "(" in t else []
        for m in _ODD_RUN.finditer(t):
            if not any(a <= m.start() < b for a, b in bracket):
                found.setdefault(len(m.group()), []).append((i, m.start(), m.group()))
    out = []
    for n, runs in found.items():
        some = sorted({i for i, _, _ in runs})
        place = {i: k for k, i in enumerate(some)}
        rows, at, key = windows([texts[i] for i in some], n)
        known = dict(zip(zip(rows.tolist(), at.tolist()), key.tolist()))
        out += [(i, a, m, known[place[i], a]) for i, a, m in runs]
    return out


class ScannedText:
    """Damage and repair of the given fields."""

    def __init__(self, df: DataFrame, row_id: str = "pos_ord", fields: tuple[str, ...] = ("khmer", "definition")):
        self.values = _values(df, row_id, fields)
        self.spark = df.sparkSession
        self._parts: dict[str, DataFrame] = {}

    def _once(self, name: str, make) -> DataFrame:
        if name not in self._parts:
            self._parts[name] = materialize(make(), f"ocr-{name}")
        return self._parts[name]

    def lexicon(self) -> DataFrame:
        """``word, freq`` of all Latin words of the corpus."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from collections import Counter

            for b in batches:
                c: Counter = Counter()
                for t in b["text"]:
                    c.update(w for w in _LATIN.findall(t.lower()) if len(w) > 1)
                yield pd.DataFrame({"word": list(c.keys()), "freq": list(c.values())}).astype({"word": str, "freq": "int64"})

        words = self.values.where(F.col("text").rlike("[A-Za-z]")).select("text").mapInPandas(run, "word string, freq long")
        return self._once("lexicon", lambda: words.groupBy("word").agg(F.sum("freq").alias("freq")))

    def n_words(self) -> int:
        """Latin words of the corpus, one number."""
        return self.lexicon().agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0]

    def suspects(self) -> DataFrame:
        """``pos, field_name, text, layout, odd``: values that look damaged, by their lines or by characters inside their words."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = b.assign(layout=[layout_damage(t) for t in b["text"]], odd=[misread(t) for t in b["text"]])
                yield x[x["layout"] | x["odd"]]

        some = self.values.where(F.col("text").rlike(_QUICK))
        return self._once("suspects", lambda: some.mapInPandas(run, "pos long, field_name string, text string, layout boolean, odd boolean"))

    # --- Latin words ---------------------------------------------------------------------------

    def corrections(self) -> DataFrame:
        """``seen, seen_freq, repair, cost, freq``: for each odd or rare word its symmetric-delete neighbours among frequent words."""
        lex, n = self.lexicon(), max(self.n_words(), 1)
        word, plain = F.col("word"), F.col("word").rlike("^[a-z]{3,}$")
        good = lex.where(plain & (F.col("freq") >= REPAIR_RATE * n))
        # At most 1 / CERTAIN_RATE words.
        certain = [r[0] for r in good.where(F.col("freq") >= CERTAIN_RATE * n).select("word").collect()]
        _, keys = delete_keys(certain)
        sent = self.spark.sparkContext.broadcast(np.unique(keys))
        top = good.agg(F.coalesce(F.max("freq"), F.lit(0))).first()[0]
        odd = word.rlike("[a-z]") & word.rlike("[0-9!|$]")
        rare = word.rlike("^[a-z]{4,}$") & (F.col("freq") * RARE_RATIO <= top)

        def spread(only_certain: bool):
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for b in batches:
                    at, keys = delete_keys(b["word"].tolist())
                    if only_certain:
                        known = sent.value
                        hit = known[np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))] == keys if len(known) else np.zeros(len(keys), bool)
                        at, keys = at[hit], keys[hit]
                    yield pd.DataFrame({"key": keys, "word": b["word"].to_numpy()[at], "freq": b["freq"].to_numpy()[at]})

            return run

        schema = "key long, word string, freq long"
        a = lex.where(odd).mapInPandas(spread(False), schema).withColumn("kind", F.lit("odd"))
        a = a.unionByName(lex.where(rare).mapInPandas(spread(True), schema).withColumn("kind", F.lit("rare"))).toDF("key", "seen", "seen_freq", "kind")
        b = good.mapInPandas(spread(False), schema)
        fits = F.when(F.col("kind") == "odd", F.col("freq") > F.col("seen_freq")).otherwise(
            (F.col("freq") >= F.col("seen_freq") * RARE_RATIO) & (F.col("freq") >= CERTAIN_RATE * n)
        )
        # the planner takes the keys for as small as the words: not to be sent to every task
        meet = a.hint("merge").join(b, "key").where(fits).select("seen", "seen_freq", "kind", "word", "freq").distinct()

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in batches:
                cost = np.array([weighted_distance(s, w) for s, w in zip(x["seen"], x["word"])], dtype=float)
                yield x.assign(cost=cost)[cost <= np.where(x["kind"] == "odd", DEAR, CHEAP)]

        scored = meet.mapInPandas(score, "seen string, seen_freq long, kind string, word string, freq long, cost double")
        return self._once("corrections", lambda: scored.withColumnRenamed("word", "repair"))

    def bigrams(self, wanted: DataFrame) -> DataFrame:
        """``w1, w2, n`` over the whole corpus, for the wanted pairs."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from collections import Counter

            for b in batches:
                c: Counter = Counter()
                for t in b["text"]:
                    w = _LATIN.findall(t.lower())
                    c.update(zip(w, w[1:]))
                yield pd.DataFrame([(x, y, n) for (x, y), n in c.items()], columns=["w1", "w2", "n"]).astype({"w1": str, "w2": str, "n": "int64"})

        pairs = self.values.where(F.col("text").rlike("[A-Za-z]")).select("text").mapInPandas(run, "w1 string, w2 string, n long")
        return pairs.groupBy("w1", "w2").agg(F.sum("n").alias("n")).join(wanted.distinct(), ["w1", "w2"], "left_semi").groupBy("w1", "w2").agg(F.sum("n").alias("n"))

    def choices(self, words: DataFrame) -> DataFrame:
        """The given occurrences (``seen, prev, next`` and others) with the best repair: ``repair, cost, own, support``."""
        keys = [c for c in words.columns if c not in ("prev", "next")]
        c = materialize(words.join(self.corrections().select("seen", "repair", "cost", "freq", "kind"), "seen"), "ocr-choices")
        pair = lambda a, b: c.select(F.col(a).alias("w1"), F.col(b).alias("w2")).where("w1 is not null and w2 is not null")
        wanted = pair("prev", "repair").unionByName(pair("repair", "next")).unionByName(pair("prev", "seen")).unionByName(pair("seen", "next"))
        n = materialize(self.bigrams(wanted), "ocr-bigrams")
        for a, b, name in (("prev", "repair", "n1"), ("repair", "next", "n2"), ("prev", "seen", "n3"), ("seen", "next", "n4")):
            c = c.join(n.toDF(a, b, name), [a, b], "left")
        zero = F.lit(0)
        c = c.withColumn("support", F.coalesce("n1", zero) + F.coalesce("n2", zero)).withColumn("own", F.coalesce("n3", zero) + F.coalesce("n4", zero))
        value = -F.col("cost") + BIGRAM_WEIGHT * F.log1p("support") + FREQUENCY_WEIGHT * F.log1p("freq")
        best = c.groupBy(*keys).agg(F.max(F.struct(value.alias("value"), "repair", "cost", "freq", "kind", "own", "support")).alias("b"))
        return best.select(*keys, "b.repair", "b.cost", "b.freq", "b.kind", "b.own", "b.support")

    @staticmethod
    def _words(texts: DataFrame, column: str) -> DataFrame:
        """``pos, field_name, at, len, seen, prev, next`` of every Latin word of four letters or with odd characters."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for p, f, t in zip(b["pos"], b["field_name"], b[column]):
                    m = list(_LATIN.finditer(t))
                    low = [x.group().lower() for x in m]
                    for i, x in enumerate(m):
                        if len(low[i]) > 3 or _ODD_LATIN.search(low[i]):
                            out.append((p, f, x.start(), len(low[i]), low[i], low[i - 1] if i else None, low[i + 1] if i + 1 < len(m) else None))
                yield pd.DataFrame(out, columns=["pos", "field_name", "at", "len", "seen", "prev", "next"])

        return texts.where(F.col(column).rlike("[A-Za-z]")).select("pos", "field_name", column).mapInPandas(
            run, "pos long, field_name string, at int, len int, seen string, prev string, next string"
        )

    # --- Khmer windows -------------------------------------------------------------------------

    def odd_runs(self) -> DataFrame:
        """``pos, field_name, at, len, odd, key`` of the odd characters in the suspects' joined text."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = odd_windows(b["joined"].tolist())
                i = [x[0] for x in found]
                yield pd.DataFrame({
                    "pos": b["pos"].to_numpy()[i], "field_name": b["field_name"].to_numpy()[i], "at": [x[1] for x in found],
                    "len": [len(x[2]) for x in found], "odd": [x[2] for x in found], "key": [x[3] for x in found],
                }).astype({"at": "int32", "len": "int32", "odd": str, "key": "int64"}) if found else pd.DataFrame(columns=["pos", "field_name", "at", "len", "odd", "key"])

        return self._once("odd", lambda: self.joined().mapInPandas(run, "pos long, field_name string, at int, len int, odd string, key long"))

    def joined(self) -> DataFrame:
        """``pos, field_name, joined`` of the suspects, line by line put together."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"pos": b["pos"], "field_name": b["field_name"], "joined": [rejoin(t) for t in b["text"]]})

        return self.suspects().mapInPandas(run, "pos long, field_name string, joined string")

    def window_repairs(self) -> DataFrame:
        """``key, odd, seen_freq, repair, freq``: what stands in the place of odd characters between the same neighbours elsewhere."""
        runs = self.odd_runs()
        seen = runs.groupBy("key", "odd").agg(F.count("*").alias("seen_freq"))
        keys = runs.select("key").distinct()
        sent = None
        if keys.count() <= SEND_KEYS:
            sent = self.spark.sparkContext.broadcast(np.sort(keys.toPandas()["key"].to_numpy(np.int64)))
        clean = re.compile(f"^[{_KM}\\u200b ]*$")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts, out = b["text"].tolist(), []
                for middle in range(3):
                    rows, at, key = windows(texts, middle)
                    if sent is not None:
                        known = sent.value
                        hit = known[np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))] == key if len(known) else np.zeros(len(key), bool)
                        rows, at, key = rows[hit], at[hit], key[hit]
                    what = [texts[r][a : a + middle] for r, a in zip(rows, at)]
                    x = pd.DataFrame({"key": key, "repair": what})
                    x = x[np.array([bool(clean.match(w)) for w in what], dtype=bool)]
                    out.append(x.groupby(["key", "repair"]).size().reset_index(name="n"))
                yield pd.concat(out).astype({"key": "int64", "repair": str, "n": "int64"})

        found = self.values.where(F.col("text").rlike("[\\u1780-\\u17d3]")).select("text").mapInPandas(run, "key long, repair string, n long")
        if sent is None:
            found = found.join(keys, "key", "left_semi")
        found = found.groupBy("key", "repair").agg(F.sum("n").alias("freq"))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in batches:
                # an odd character in place of a Khmer one costs 0.4, one more or less a full unit
                n = np.array([[len(o), len(r)] for o, r in zip(x["odd"], x["repair"])], dtype=float).reshape(-1, 2)
                yield x.assign(cost=0.4 * n.min(axis=1) + np.abs(n[:, 0] - n[:, 1]))

        c = seen.join(found, "key").mapInPandas(score, "key long, odd string, seen_freq long, repair string, freq long, cost double")
        value = -F.col("cost") + BIGRAM_WEIGHT * F.log1p("freq")
        best = c.where(F.col("cost") <= 1.4).groupBy("key", "odd").agg(F.max(F.struct(value.alias("value"), "repair", "freq")).alias("b"))
        return self._once("windows", lambda: seen.join(best, ["key", "odd"], "left").select("key", "odd", "seen_freq", "b.repair", "b.freq"))

    # --- judgement -----------------------------------------------------------------------------

    def judged(self) -> DataFrame:
        """``pos, field_name, layout, odd, confused``: every value that is damaged in some way."""
        n, zero = max(self.n_words(), 1), F.lit(0)
        common = lambda c: (F.col(c) >= ATTESTED_LEAST) & (F.col(c) >= ATTESTED_RATE * n)
        # odd words and windows that the corpus does not attest
        best = self.corrections().where("kind = 'odd'").groupBy("seen").agg(F.max("freq").alias("best"))
        attested = self.lexicon().where(common("freq")).join(best, F.col("word") == F.col("seen"), "left").where(F.col("freq") > F.coalesce("best", zero)).select("word")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                each = [odd_latin(t) for t in b["text"]]
                i = np.repeat(np.arange(len(b)), [len(x) for x in each])
                yield pd.DataFrame({"pos": b["pos"].to_numpy()[i], "field_name": b["field_name"].to_numpy()[i], "word": [w for x in each for w in x]}).astype({"word": str})

        odd = self.suspects().where("odd")
        latin = odd.where(F.col("text").rlike("[a-z]")).select("pos", "field_name", "text").mapInPandas(run, "pos long, field_name string, word string")
        latin = latin.join(attested, "word", "left_anti").select("pos", "field_name")
        own = self.window_repairs().where(common("seen_freq") & (F.col("seen_freq") > F.coalesce("freq", zero))).select("key", "odd")
        khmer = self.odd_runs().join(own, ["key", "odd"], "left_anti").select("pos", "field_name")
        wrong = latin.unionByName(khmer).distinct().withColumn("misread", F.lit(True))
        s = self.suspects().join(wrong, ["pos", "field_name"], "left")
        s = s.select("pos", "field_name", "text", "layout", (F.col("odd") & F.coalesce("misread", F.lit(False))).alias("odd"), F.lit(False).alias("confused"))
        s = materialize(s.where("layout or odd"), "ocr-damaged")
        # a rare word that is one cheap confusion away from a frequent one, in a place where that fits as well
        fix = self.corrections().where("kind = 'rare'").select("seen").distinct()
        plain = self.values.where(F.col("text").rlike("[a-z]{4}"))
        c = self.choices(self._words(plain, "text").join(fix, "seen", "left_semi")).where("kind = 'rare' and support >= own")
        hit = c.select("pos", "field_name").distinct().join(s.select("pos", "field_name"), ["pos", "field_name"], "left_anti")
        more = self.values.join(hit, ["pos", "field_name"]).select("pos", "field_name", "text", F.lit(False).alias("layout"), F.lit(False).alias("odd"), F.lit(True).alias("confused"))
        return s.unionByName(more)

    def found(self) -> DataFrame:
        return self.judged().select("pos", "field_name")

    def repaired(self) -> DataFrame:
        """``pos, field_name, repaired``: damaged values as continuous text."""
        judged = materialize(self.judged(), "ocr-judged")

        def rejoined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"pos": b["pos"], "field_name": b["field_name"], "joined": [rejoin(t) for t in b["text"]]})

        joined = materialize(judged.mapInPandas(rejoined, "pos long, field_name string, joined string"), "ocr-joined")
        words = self._words(joined, "joined").join(self.corrections().select("seen").distinct(), "seen", "left_semi")
        latin = self.choices(words).where("kind = 'odd' or support >= own").select("pos", "field_name", "at", "len", "repair")
        known = self.window_repairs().where((F.col("freq") > 0) & (F.col("freq") >= F.col("seen_freq"))).select("key", "odd", "repair")
        khmer = self.odd_runs().join(known, ["key", "odd"]).select("pos", "field_name", "at", "len", "repair")
        # the repairs of one text, of which there are no more than it has words
        each = latin.unionByName(khmer).groupBy("pos", "field_name").agg(F.array_sort(F.collect_list(F.struct("at", "len", "repair"))).alias("fix"))

        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for t, fix in zip(b["joined"], b["fix"]):
                    done, parts = 0, []
                    for x in fix if fix is not None else ():
                        if x["at"] >= done:
                            was, new = t[x["at"] : x["at"] + x["len"]], x["repair"]
                            parts += [t[done : x["at"]], new.capitalize() if was[:1].isupper() else new]
                            done = x["at"] + x["len"]
                    out.append("".join(parts) + t[done:])
                yield pd.DataFrame({"pos": b["pos"], "field_name": b["field_name"], "repaired": out})

        return joined.join(each, ["pos", "field_name"], "left").mapInPandas(apply, "pos long, field_name string, repaired string")
