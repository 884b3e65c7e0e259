"""Values cut off by a field limit or in transfer (problem 1).

Method: for every source a mixture of two log-normal length distributions is
fitted by maximum likelihood, once without and once with right-censoring at each
candidate limit (in characters and in bytes); the limit of the greatest
likelihood gain is kept.  A value that stands at its source's limit gets the
censoring posterior P(X > L) / (P(X > L) + P(X = L)); any other value the rate
of cuts in transfer.  These odds are combined with the ending evidence: a
replacement character, a dangling subscript sign, an open bracket, a trailing
space, the shape of the last syllable (how often words end so, against how often
a random position looks so) and whether the source closes its long values with a
full stop.

Cases: null and blank values are never cut; a null source is a source of its
own; exact repeats are judged alike; a short, long or unpunctuated value is no
case by itself; an empty table gives an empty result.  Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .canon import _INVISIBLE_RE
from .keys import _FOLIO, _HEADER
from .sketch import code_points

KINDS = ("open", "stop", "close", "plain")
#: Rate of cuts in transfer before any evidence, and of values longer than their source's limit.
CUT_RATE, OVER_LIMIT = 0.01, 0.01
#: Gain in log-likelihood that a limit must bring, and values that must stand at it.
LIMIT_GAIN, LIMIT_VALUES = 15.0, 4
#: Weight, in values, of the pooled distribution in the fit of one source.
POOLED_WEIGHT = 20.0
DECIDE = 0.5

_STOP = re.compile("[\\u17d4-\\u17d6.!?\\u2026:;,]$")
_CLOSE = re.compile("[)\\]}\\u00bb\"]$")
_TAIL_CHARS = 4
_CLASSES = 8


def _class_table() -> np.ndarray:
    """Class of a code point below 0x1800: 0 other, 1 space, 2 consonant, 3 subscript sign, 4 vowel, 5 sign, 6 Latin, 7 digit."""
    t = np.zeros(0x1801, dtype=np.int64)
    t[[0x20, 0x0A, 0x0D, 0xA0]] = 1
    t[0x1780:0x17B4] = 2
    t[0x17D2] = 3
    t[0x17B6:0x17C6] = 4
    t[0x17C6:0x17D2] = 5
    t[0x17DD] = 5
    t[0x41:0x5B] = 6
    t[0x61:0x7B] = 6
    t[0xC0:0x250] = 6
    t[0x30:0x3A] = 7
    t[0x17E0:0x17EA] = 7
    return t


_CLASS = _class_table()


def _classes(flat: np.ndarray) -> np.ndarray:
    return _CLASS[np.minimum(flat, 0x1800).astype(np.int64)]


def visible(text: str) -> str:
    """Without invisible characters and without page furniture after the text."""
    t = _INVISIBLE_RE.sub("", text)
    if "\n" in t or "\r" in t:
        lines = re.split("[\\r\\n]+", t)
        while len(lines) > 1 and (not lines[-1].strip() or _FOLIO.match(lines[-1]) or _HEADER.match(lines[-1])):
            lines.pop()
        t = "\n".join(lines)
    return t


def ending(text: str) -> tuple[str, int]:
    """Kind and shape of a value's ending."""
    t = visible(text)
    if not t.strip():
        return "close", 0
    if t.endswith("�") or t.endswith("្") or t.count("(") > t.count(")") or t[-1] == " ":
        return "open", 0
    shape = 0
    for c in t[-_TAIL_CHARS:]:
        shape = shape * _CLASSES + int(_CLASS[min(ord(c), 0x1800)])
    if _STOP.search(t):
        return "stop", shape
    if _CLOSE.search(t):
        return "close", shape
    return "plain", shape


def features(df: DataFrame, row_id: str, source: str, text: str) -> DataFrame:
    """``pos, source, chars, bytes, kind, shape`` of every value that is not blank."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = b["_v"].tolist()
            e = [ending(x) for x in v]
            yield pd.DataFrame(
                {
                    "pos": b["pos"],
                    "source": b["source"],
                    "chars": [len(x) for x in v],
                    "bytes": [len(x.rstrip("�").encode("utf-8", "surrogatepass")) for x in v],
                    "kind": [k for k, _ in e],
                    "shape": [s for _, s in e],
                }
            )

    read = df.select(F.col(row_id).cast("long").alias("pos"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.col(text).alias("_v"))
    return read.where(F.length(F.trim("_v")) > 0).mapInPandas(run, "pos long, source string, chars int, bytes int, kind string, shape int")


def shape_counts(df: DataFrame, text: str) -> DataFrame:
    """``shape, ends, anywhere``: how often the last characters before a space, or before any position, have a shape."""
    size = _CLASSES**_TAIL_CHARS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends, anywhere = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            texts = [_INVISIBLE_RE.sub("", x) for x in b["_v"]]
            flat, at = code_points(texts)
            c = _classes(flat)
            if len(c) < _TAIL_CHARS + 1:
                continue
            s = np.zeros(len(c) - _TAIL_CHARS, np.int64)
            for k in range(_TAIL_CHARS):
                s = s * _CLASSES + c[k : len(c) - _TAIL_CHARS + k]
            nxt = np.arange(_TAIL_CHARS, len(c))
            row = np.repeat(np.arange(len(texts)), np.diff(at))
            inside = row[nxt] == row[nxt - _TAIL_CHARS]
            anywhere += np.bincount(s[inside], minlength=size)
            ends += np.bincount(s[inside & (c[nxt] == 1)], minlength=size)
        some = np.flatnonzero(anywhere)
        yield pd.DataFrame({"shape": some, "ends": ends[some], "anywhere": anywhere[some]})

    read = df.select(F.col(text).alias("_v")).where(F.length("_v") > _TAIL_CHARS)
    parts = read.mapInPandas(run, "shape int, ends long, anywhere long")
    return parts.groupBy("shape").agg(F.sum("ends").alias("ends"), F.sum("anywhere").alias("anywhere"))


# --- length distributions -----------------------------------------------------------------------

_erfc = np.vectorize(math.erfc, otypes=[float])


def _log_normal(x: np.ndarray, mu: float, sd: float) -> np.ndarray:
    z = (np.log(x) - mu) / sd
    return np.exp(-0.5 * z * z) / (x * sd * math.sqrt(2 * math.pi))


def _survival(x: np.ndarray, mu: float, sd: float) -> np.ndarray:
    """P(X > x), with half-unit continuity."""
    return 0.5 * _erfc((np.log(x + 0.5) - mu) / (sd * math.sqrt(2)))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, limit: float | None = None, start: list | None = None, rounds: int = 40) -> list:
    """Maximum-likelihood mixture ``[(weight, mu, sd), ...]`` by expectation-maximization.

    Values of ``limit`` or more count as right-censored there.  ``start`` are the
    pooled components, which enter with the weight of ``POOLED_WEIGHT`` values: a
    component that lies wholly beyond a limit would otherwise be undetermined.
    """
    x = np.asarray(lengths, float)
    n = np.asarray(counts, float)
    if limit is not None:
        cens = n[x >= limit].sum()
        x, n = x[x < limit], n[x < limit]
    else:
        cens = 0.0
    if start is None:
        lx = np.log(np.maximum(x, 1))
        m = np.average(lx, weights=n) if n.sum() else 3.0
        comps = [(0.8, m - 0.3, 0.4), (0.2, m + 0.8, 0.3)]
    else:
        comps = list(start)
    prior = comps if start is not None else None
    for _ in range(rounds):
        dens = np.array([w * _log_normal(np.maximum(x, 1), mu, sd) for w, mu, sd in comps]) + 1e-300
        resp = dens / dens.sum(axis=0)
        new = []
        tails = [w * float(_survival(np.array([limit - 1.0]), mu, sd)[0]) for w, mu, sd in comps] if cens else [0.0] * len(comps)
        total_tail = sum(tails) or 1.0
        for k, (w, mu, sd) in enumerate(comps):
            r = resp[k] * n
            s0, s1 = r.sum(), (r * np.log(np.maximum(x, 1))).sum()
            s2 = (r * np.log(np.maximum(x, 1)) ** 2).sum()
            if cens:
                c = cens * tails[k] / total_tail
                # moments of the normal above the limit
                z = (math.log(max(limit - 0.5, 1)) - mu) / sd
                sf = max(0.5 * math.erfc(z / math.sqrt(2)), 1e-12)
                h = math.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) / sf
                e1 = mu + sd * h
                e2 = mu * mu + 2 * mu * sd * h + sd * sd * (1 + z * h)
                s0, s1, s2 = s0 + c, s1 + c * e1, s2 + c * max(e2, e1 * e1)
            if prior is not None:
                pw, pm, ps = prior[k]
                c = POOLED_WEIGHT * pw
                s0, s1, s2 = s0 + c, s1 + c * pm, s2 + c * (pm * pm + ps * ps)
            s0 = max(s0, 1e-9)
            m = s1 / s0
            new.append((s0, m, max(math.sqrt(max(s2 / s0 - m * m, 0)), 0.05)))
        total = sum(w for w, _, _ in new)
        comps = [(w / total, m, s) for w, m, s in new]
    return comps


def _mass(comps: list, x: np.ndarray) -> np.ndarray:
    return sum(w * (_survival(x - 1, mu, sd) - _survival(x, mu, sd)) for w, mu, sd in comps) + 1e-12


def _beyond(comps: list, x: np.ndarray) -> np.ndarray:
    return sum(w * _survival(x, mu, sd) for w, mu, sd in comps) + 1e-12


def find_limit(lengths: np.ndarray, counts: np.ndarray, pooled: list, width: int) -> tuple[int, float, float]:
    """Limit (0 for none), log-likelihood gain, and censoring posterior at the limit.

    ``width`` is how far below the limit a cut value may end: 1 for characters, 3
    for bytes, since a divided character is dropped.
    """
    x, n = np.asarray(lengths, int), np.asarray(counts, float)
    order = np.argsort(x)
    x, n = x[order], n[order]
    top = n[::-1].cumsum()[::-1]
    free = fit_lengths(x, n, None, pooled)
    log_free = np.log(_mass(free, x.astype(float)))
    best = (0, 0.0, 0.0)
    for i in range(len(x)):
        at = (x > x[i] - width) & (x <= x[i])
        n_at, n_over = n[at].sum(), top[i] - n[i]
        if n_at < LIMIT_VALUES or n_over > 0.25 * n_at or n_at < 3 * n[(x <= x[i] - width) & (x > x[i] - 3 * width - 3)].sum() / 3:
            continue
        comps = fit_lengths(x, n, x[i] - width + 1, pooled)
        below = x <= x[i] - width
        log_limit = np.log(_mass(comps, x.astype(float)))
        gain = (n[below] * (log_limit[below] - log_free[below])).sum()
        gain += n_at * (math.log(_beyond(comps, np.array([float(x[i] - width)]))[0] / width * (1 - OVER_LIMIT))) - (n[at] * log_free[at]).sum()
        over = x > x[i]
        gain += (n[over] * (math.log(OVER_LIMIT) + log_limit[over] - log_free[over])).sum()
        if gain > max(LIMIT_GAIN, best[1]):
            s, f = _beyond(comps, np.array([float(x[i])]))[0], _mass(comps, np.array([float(x[i])]))[0] * width
            best = (int(x[i]), float(gain), float(s / (s + f)))
    return best


def _source_table(pooled_chars: list, pooled_bytes: list):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        source = pdf["source"].iloc[0]
        found = []
        for unit, pooled, width in (("chars", pooled_chars, 1), ("bytes", pooled_bytes, 3)):
            h = pdf[pdf["unit"] == unit].groupby("length")["n"].sum()
            found.append((*find_limit(h.index.to_numpy(), h.to_numpy(), pooled, width), unit))
        limit, gain, post, unit = max(found, key=lambda t: (t[1], t[3]))
        # does the source close its long values?
        c = pdf[pdf["unit"] == "chars"].sort_values("length")
        stops = c[c["kind"] == "stop"]
        long_from, habit = 0, 0.0
        if stops["n"].sum() >= 5:
            cum = stops["n"].cumsum() / stops["n"].sum()
            long_from = int(stops.loc[cum >= 0.2, "length"].iloc[0])
            above = c[c["length"] >= long_from]
            habit = float(above.loc[above["kind"] == "stop", "n"].sum() / above["n"].sum())
        return pd.DataFrame(
            {"source": [source], "lim": [limit if gain else 0], "unit": [unit], "gain": [gain], "at_limit": [post], "long_from": [long_from], "habit": [habit]}
        )

    return run


class CutValues:
    """Judgement of every value; ``rows`` has ``pos, source, posterior, cut``."""

    def __init__(self, df: DataFrame, row_id: str = "pos_ord", source: str = "source", text: str = "khmer"):
        spark = df.sparkSession
        feats = materialize(features(df, row_id, source, text), "cut-features")
        hist = feats.select("source", "kind", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("u"))
        hist = materialize(hist.groupBy("source", "kind", "u.unit", "u.length").count().withColumnRenamed("count", "n"), "cut-lengths")
        # The pooled length distribution has one row for each distinct length, not for each value.
        pooled = {}
        for unit in ("chars", "bytes"):
            h = hist.where(F.col("unit") == unit).groupBy((F.ceil(F.log1p("length") * 64)).alias("l")).agg(F.sum("n").alias("n")).toPandas()
            pooled[unit] = fit_lengths(np.expm1(h["l"].to_numpy() / 64.0), h["n"].to_numpy(), None, None, 80) if len(h) else [(0.8, 3.0, 0.4), (0.2, 4.5, 0.3)]
        self.sources = materialize(
            hist.groupBy("source").applyInPandas(
                _source_table(pooled["chars"], pooled["bytes"]),
                "source string, lim int, unit string, gain double, at_limit double, long_from int, habit double",
            ),
            "cut-sources",
        )
        shapes = shape_counts(df, text)
        # At most 8^4 shapes exist, one row each; their two totals are numbers.
        shapes = materialize(shapes, "cut-shapes")
        ends, anywhere = shapes.agg(F.coalesce(F.sum("ends"), F.lit(0)), F.coalesce(F.sum("anywhere"), F.lit(0))).first()
        shapes = shapes.select(
            "shape",
            (((F.col("anywhere") + 1) / (anywhere + 4096)) / ((F.col("ends") + 0.5) / (ends + 2048))).alias("shape_odds"),
        )
        j = feats.join(F.broadcast(self.sources), "source") if self._few_sources() else feats.join(self.sources, "source")
        j = j.join(F.broadcast(shapes), "shape", "left")
        self.rows = j.select("pos", "source", self._posterior().alias("posterior")).withColumn("cut", F.col("posterior") >= DECIDE)
        self.spark = spark

    def _few_sources(self) -> bool:
        """Whether the source table is small enough to send to every task."""
        return self.sources.count() <= 20_000

    @staticmethod
    def _posterior() -> Column:
        size = F.when(F.col("unit") == "chars", F.col("chars")).otherwise(F.col("bytes"))
        width = F.when(F.col("unit") == "chars", 1).otherwise(3)
        at = (F.col("lim") > 0) & (size <= F.col("lim")) & (size > F.col("lim") - width)
        prior = F.when(at, F.greatest(F.col("at_limit"), F.lit(CUT_RATE))).otherwise(F.lit(CUT_RATE))
        printing = (F.col("habit") >= 0.6) & (F.col("chars") >= F.col("long_from"))
        shape = F.coalesce(F.col("shape_odds"), F.lit(1.0))
        odds = (
            F.when(F.col("kind") == "open", F.lit(1e5))
            .when(F.col("kind") == "stop", F.lit(0.005))
            .when(F.col("kind") == "close", F.lit(0.01))
            .otherwise(F.least(F.greatest(shape, F.lit(0.05)), F.lit(1e4)) * F.when(printing, F.lit(3000.0)).otherwise(F.lit(1.0)))
        )
        o = prior / (1.0000001 - prior) * odds
        return o / (1 + o)

    def cut_rows(self) -> DataFrame:
        return self.rows.where("cut").select("pos")

    def by_source(self) -> DataFrame:
        """Share of cut values and the limit found, for every source."""
        n = self.rows.groupBy("source").agg(F.count("*").alias("n_values"), F.count_if("cut").alias("n_cut"))
        s = self.sources.select("source", "lim", "unit")
        return n.join(s, "source").select(
            "source", "n_values", "n_cut", (F.col("n_cut") / F.col("n_values")).alias("share_cut"),
            F.when(F.col("lim") > 0, F.col("lim")).alias("limit_length"), F.when(F.col("lim") > 0, F.col("unit")).alias("limit_unit"),
        )
