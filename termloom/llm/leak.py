"""Evaluation texts inside training documents (problem 8).

Method: winnowing.  Texts are reduced to lower-cased canonical letters and
digits; of every ``WINDOW`` successive hashes of ``GRAM`` characters the least
is a fingerprint, so any shared span of ``RUN = WINDOW + GRAM - 1`` characters
shares at least one.  Fingerprints of documents and items are joined; for each
pair with enough of them the hits are extended: all runs of ``SEED`` equal
characters that lie on one diagonal band of the alignment count, and the part of
the item they cover must reach half of it.

What is enough follows from the guarantee: ``m`` shared fingerprints cannot come
from more than ``(RUN + WINDOW - 1) * m`` characters in runs of ``RUN`` or more,
so a pair with fewer than half of the item needs is never a case in such runs,
and every other pair is extended.  A fingerprint that more than ``STOCK`` items
have is a stock instruction's: it joins nothing by itself, unless an item has no
other, so a phrase that a third of the documents use does not pair them with all
items.

Cases: null and empty texts leak nowhere; an item below ``2 * RUN`` characters is
too short for the guarantee and is looked for directly: any half of it, and at
least ``GRAM`` characters or all it has, must stand in the document; equal items
are reported each; an item repeated in a document, or a document fetched twice,
is reported for each document once; long documents are scanned whole, every band
of every item in them; an empty table gives an empty result.
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
from .sketch import char_shingles, code_points, mix

GRAM, WINDOW, SEED = 14, 10, 10
COVER = 0.5
#: Diagonals that count as one passage, as a share of the item's length: room for inserted and dropped words.
BAND = 0.15
RUN = WINDOW + GRAM - 1
#: Items that may share a fingerprint that joins them to documents.
STOCK = 2
#: An item without any such fingerprint is joined by all it has.
LEAST_OWN = 1
#: Characters of the items that are sent to every task; beyond it both sides are shuffled.
BROADCAST_MAX = 8_000_000

_DROP = re.compile("[^0-9a-z\\u00df-\\u024f\\u0370-\\u1fff\\u2c00-\\ud7ff\\uf900-\\ufffc]+|[\\u17d4-\\u17da\\u0e3f\\u0e4f]+")


def squash(text: str | None) -> str:
    """Lower-case letters, marks and digits of the canonical form."""
    if not text:
        return ""
    return _DROP.sub("", canonical(text).lower())


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and position of the winnowed fingerprints of squashed texts."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    rows, h = char_shingles(texts, GRAM, seed=11) if len(texts) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    n_full = int(np.maximum(lengths - GRAM + 1, 0).sum())
    rows, h = rows[:n_full], h[:n_full]  # without texts shorter than one gram
    per = np.maximum(lengths - GRAM + 1, 0)
    start = np.cumsum(per) - per
    at = np.arange(n_full) - np.repeat(start, per)
    if not n_full:
        return rows, h, at
    # least hash among the window that ends here, within the text; ties take the rightmost
    pad = np.full(WINDOW - 1, np.uint64(0xFFFFFFFFFFFFFFFF), dtype=np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, h]), WINDOW)
    rev = view[:, ::-1].argmin(axis=1)
    pick = np.arange(n_full) - rev
    full = at >= np.minimum(WINDOW - 1, np.repeat(per, per) - 1)
    inside = rows[np.maximum(pick, 0)] == rows
    pick = pick[full & inside]  # never falls
    pick = pick[np.concatenate([[True], pick[1:] != pick[:-1]])] if len(pick) else pick
    return rows[pick], h[pick], at[pick]


def prefixes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length and hash of every opening of squashed texts, from ``GRAM`` characters on; equal openings have equal hashes."""
    rows, lengths, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    flat, ends = code_points(texts)
    with np.errstate(over="ignore"):
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            if b - a >= GRAM:
                place = np.arange(b - a, dtype=np.uint64)
                h = mix(np.cumsum(mix(flat[a:b] + (place << np.uint64(21)))))[GRAM - 1 :]
                rows.append(np.full(len(h), i))
                lengths.append(np.arange(GRAM, b - a + 1))
                hashes.append(h)
    return np.concatenate(rows), np.concatenate(lengths), np.concatenate(hashes)


def seeds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of an item's runs of ``SEED`` characters, and where they stand."""
    _, h = char_shingles([text], SEED, seed=3) if len(text) >= SEED else (None, np.zeros(0, np.uint64))
    order = np.argsort(h, kind="stable")
    return h[order], order


def cover_of(length: int, item_seeds: tuple[np.ndarray, np.ndarray], hd: np.ndarray) -> float:
    """Greatest share of an item's characters that one passage of a document, given by its seeds, holds in order."""
    s, order = item_seeds
    lo, up = np.searchsorted(s, hd, "left"), np.searchsorted(s, hd, "right")
    n = up - lo
    some = np.flatnonzero(n)
    if not len(some):
        return 0.0
    n, lo = n[some], lo[some]
    d = np.repeat(some, n)
    within = np.arange(len(d)) - np.repeat(np.cumsum(n) - n, n)
    i = order[np.repeat(lo, n) + within]
    diag = d - i
    band = max(int(BAND * length), 24)
    best = 0.0
    for shift in (0, band // 2):
        cell = (diag + length + shift) // band
        # places of the item in each band, in order; each covers SEED characters, less what the next one covers too
        by = np.lexsort((i, cell))
        c, at = cell[by], i[by]
        fresh = np.minimum(np.concatenate([np.where(c[1:] == c[:-1], at[1:] - at[:-1], SEED), [SEED]]), SEED)
        edge = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        best = max(best, float(np.add.reduceat(fresh, edge).max()) / length)
    return best


def coverage(item: str, doc: str) -> float:
    """Greatest share of the item's characters that one passage of the document holds, in order."""
    return cover_of(len(item), seeds(item), char_shingles([doc], SEED, seed=3)[1]) if len(item) >= SEED and len(doc) >= SEED else 0.0


def short_part(length: int) -> int:
    """Characters of a short item that must stand in a document."""
    return min(length, max(GRAM, (length + 1) // 2))


def enough(length: int) -> int:
    """Fingerprints that half of an item cannot do without, in runs of ``RUN`` characters or more."""
    return max(1, -(-int(COVER * length) // (RUN + WINDOW - 1)))


def _squash_udf(df: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "t": [squash(x) for x in b["t"]]})

    some = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).where(F.length("t") > 0)
    return some.mapInPandas(run, "id long, t string").where(F.length("t") > 0)


class _Index:
    """The items' fingerprints, seeds and short items, as the tasks use them."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.texts, self.length = ids, texts, np.array([len(t) for t in texts], dtype=np.int64)
        long = np.flatnonzero(self.length >= 2 * RUN)
        r, h, at = fingerprints([texts[i] for i in long])
        pairs = pd.DataFrame({"h": h.view(np.int64), "item": long[r], "at": at}).groupby(["h", "item"], sort=True)["at"].max().reset_index()
        self.h, self.item = pairs["h"].to_numpy(), pairs["item"].to_numpy()
        opening = np.zeros(len(texts), dtype=np.int64)
        r, n, h = prefixes([texts[i] for i in long])
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        shared = times[inverse] > STOCK
        np.maximum.at(opening, long[r[shared]], n[shared])
        own = pairs["at"].to_numpy() + GRAM > opening[self.item]
        has_own = np.bincount(self.item[own], minlength=len(texts)) > 0
        self.joins = own | ~has_own[self.item]
        self.need = np.array([enough(int(n)) for n in self.length], dtype=np.int64)
        self.seeds = [seeds(t) for t in texts]
        self.short = {}
        for i in np.flatnonzero(self.length < 2 * RUN):
            m = short_part(int(self.length[i]))
            for a in range(int(self.length[i]) - m + 1):
                self.short.setdefault(m, {}).setdefault(texts[i][a : a + m], set()).add(int(i))

    def search(self, docs: list[str]) -> list[tuple[int, int, float]]:
        """Document, item and cover of every leak in the documents."""
        out: list[tuple[int, int, float]] = []
        if len(self.h):
            r, h, _ = fingerprints(docs)
            h = h.view(np.int64)
            lo = np.searchsorted(self.h, h, "left")
            hit = np.flatnonzero(self.h[np.minimum(lo, len(self.h) - 1)] == h)
            r, h, lo = r[hit], h[hit], lo[hit]
            c = np.searchsorted(self.h, h, "right") - lo
            at = np.repeat(lo, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            # distinct (document, item, fingerprint)
            x = np.unique(np.stack([np.repeat(r, c), at], axis=1), axis=0)
            x = pd.DataFrame({"r": x[:, 0], "item": self.item[x[:, 1]], "joins": self.joins[x[:, 1]]}).groupby(["r", "item"])["joins"].agg(["size", "any"]).reset_index()
            x = x[(x["size"] >= self.need[x["item"]]) & x["any"]]
            if len(x):
                some = np.unique(x["r"])
                rows, hd = char_shingles([docs[i] for i in some], SEED, seed=3)
                edge = np.searchsorted(rows, np.arange(len(some) + 1))
                place = {int(i): k for k, i in enumerate(some)}
                for d, i in zip(x["r"], x["item"]):
                    k = place[int(d)]
                    cover = cover_of(int(self.length[i]), self.seeds[i], hd[edge[k] : edge[k + 1]])
                    if cover >= COVER:
                        out.append((int(d), int(i), cover))
        for m, parts in self.short.items():
            for d, t in enumerate(docs):
                for i in {i for a in range(len(t) - m + 1) for i in parts.get(t[a : a + m], ())}:
                    out.append((d, i, 1.0 if self.texts[i] in t else m / float(self.length[i])))
        return out


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, cover`` of documents that hold at least half of an item in one passage."""
    spark = docs.sparkSession
    same = materialize(_squash_udf(items, item_id, text), "leak-items")
    # equal items are one until the end
    item = same.groupBy("t").agg(F.min("id").alias("id"))
    size = item.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    schema = "doc_id long, item_id long, cover double"
    if size <= BROADCAST_MAX:
        # The item side is the held-out set, of a size checked just now.
        t = item.orderBy("id").toPandas()
        known = spark.sparkContext.broadcast(_Index(t["id"].tolist(), t["t"].tolist()))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = known.value
            for b in batches:
                found = index.search([squash(x) for x in b["t"]])
                yield pd.DataFrame({"doc_id": b["id"].to_numpy()[[d for d, _, _ in found]], "item_id": [index.ids[i] for _, i, _ in found], "cover": [c for _, _, c in found]}).astype(
                    {"item_id": "int64", "cover": "float64"}
                )

        some = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).where(F.length("t") > 0)
        hits = some.mapInPandas(scan, schema)
    else:
        hits = _joined_leaks(materialize(_squash_udf(docs, doc_id, text), "leak-documents"), item, schema)
    again = same.join(item.withColumnRenamed("id", "first"), "t").where("id <> first").select("id", "first")
    more = hits.join(again, F.col("item_id") == F.col("first")).select("doc_id", F.col("id").alias("item_id"), "cover")
    return hits.unionByName(more) if again.limit(1).count() else hits


def _joined_leaks(doc: DataFrame, item: DataFrame, schema: str) -> DataFrame:
    """The same for held-out sets of any size: fingerprints, openings and short parts are shuffled and joined."""

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            r, h, _ = fingerprints(b["t"].tolist())
            yield pd.DataFrame({"h": h.view(np.int64), "id": b["id"].to_numpy()[r]}).drop_duplicates()

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            r, h, at = fingerprints(b["t"].tolist())
            yield pd.DataFrame({"h": h.view(np.int64), "id": b["id"].to_numpy()[r], "at": at})

    def openings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            r, n, h = prefixes(b["t"].tolist())
            yield pd.DataFrame({"h": h.view(np.int64), "id": b["id"].to_numpy()[r], "n": n})

    long = item.where(F.length("t") >= 2 * RUN)
    opening = materialize(long.mapInPandas(openings, "h long, id long, n long"), "leak-openings")
    often = opening.groupBy("h").agg(F.count("*").alias("items")).where(F.col("items") > STOCK).select("h")
    opening = opening.join(often, "h").groupBy("id").agg(F.max("n").alias("opening"))
    p = long.mapInPandas(placed, "h long, id long, at long").groupBy("h", "id").agg(F.max("at").alias("at")).join(opening, "id", "left")
    p = materialize(p.withColumn("own", F.col("at") + GRAM > F.coalesce("opening", F.lit(0))), "leak-prints")
    has = p.groupBy("id").agg(F.max("own").alias("has_own"))
    p = p.join(has, "id").select("h", F.col("id").alias("item"), (F.col("own") | ~F.col("has_own")).alias("joins"))
    dp = materialize(doc.mapInPandas(prints, "h long, id long").withColumnRenamed("id", "doc"), "leak-document-prints")
    first = dp.join(p.where("joins"), "h").select("doc", "item").distinct()
    # the stock fingerprints of a pair are only counted where another one has joined it
    stock = p.where("not joins").select("h", "item").join(first, "item").join(dp, ["h", "doc"], "left_semi").groupBy("doc", "item").agg(F.count("*").alias("m"))
    own = dp.join(p.where("joins"), "h").groupBy("doc", "item").agg(F.count("*").alias("n"))
    need = F.greatest(F.lit(1), F.ceil(F.floor(F.length("ti") * COVER) / (RUN + WINDOW - 1)))
    pairs = own.join(stock, ["doc", "item"], "left").join(long.select(F.col("id").alias("item"), F.col("t").alias("ti")), "item")
    pairs = pairs.where(F.col("n") + F.coalesce("m", F.lit(0)) >= need).join(doc.select(F.col("id").alias("doc"), F.col("t").alias("td")), "doc")

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc"], "item_id": b["item"], "cover": np.array([coverage(i, d) for i, d in zip(b["ti"], b["td"])], dtype=float)})

    found = pairs.mapInPandas(extend, schema).where(F.col("cover") >= COVER)
    # short items: every part that would do, against the documents' stretches of that length
    length = F.length("t")
    part = F.least(length, F.greatest(F.lit(GRAM), F.ceil(length / 2))).cast("int")
    short = item.where(length < 2 * RUN).withColumn("m", part)
    short = short.withColumn("a", F.explode(F.sequence(F.lit(1), length - F.col("m") + 1))).select("id", "t", "m", F.substring("t", F.col("a"), F.col("m")).alias("part"))
    lengths = short.groupBy().agg(F.collect_set("m").alias("ms"))  # at most RUN numbers
    d = doc.join(F.broadcast(lengths)).select("id", "t", F.explode("ms").alias("m")).where(F.length("t") >= F.col("m"))
    d = d.select(F.col("id").alias("doc"), "t", "m", F.explode(F.sequence(F.lit(1), F.length("t") - F.col("m") + 1)).alias("a"))
    d = d.select("doc", "m", F.substring("t", F.col("a"), F.col("m")).alias("part")).distinct()
    s = d.join(short.distinct(), ["m", "part"]).select("doc", "id").distinct().join(item, "id").join(doc.select(F.col("id").alias("doc"), F.col("t").alias("td")), "doc")
    whole = F.when(F.contains("td", "t"), 1.0).otherwise(F.least(F.length("t"), F.greatest(F.lit(GRAM), F.ceil(F.length("t") / 2))) / F.length("t"))
    return found.unionByName(s.select(F.col("doc").alias("doc_id"), F.col("id").alias("item_id"), whole.alias("cover")))
