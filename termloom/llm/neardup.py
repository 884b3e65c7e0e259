"""Groups of rows that record one term with small edits (problem 2).

Method: one-permutation hashing with optimal densification over character
shingles of the Khmer side and words of the gloss, banded buckets.

1. Every row is reduced to its comparison keys; rows with equal keys form a
   class and only its first row (the representative) goes on, so a value that a
   third of all rows share costs one row from here.
2. Representatives get three families of bucket keys: pairs of Khmer bins with one
   bin of the gloss's character pairs, one Khmer bin with pairs of gloss bins, and
   triples of Khmer bins alone (for blank or misspelt glosses).
3. Within a bucket each row is compared with each other by 128 bits that bound the
   letters two rows can share, so no pair that records one term is excluded.  The
   rows of a bucket of over ``HOT``, such as one headword with very many glosses,
   meet under prefixes of their character pairs (``exact_pairs``), which miss no
   such pair either; only pairs that share no bucket at all are not compared.
4. Edges are confirmed on the texts and joined up.  Edits do not add up, so the
   pairs inside a component are tested once more: all of them up to ``COMPONENT``
   representatives; in larger ones all that ``exact_pairs`` cannot rule out.

Cases: rows whose Khmer holds fewer than two letters (null, blank, lone letters)
belong to no group; ties go to the smallest id; repeated rows are members of one
class; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components
from .keys import GLOSS_AGREE as GLOSS_SHARED
from .keys import GLOSS_ORDER, KHMER_AGREE, KHMER_ORDER_ALONE, gloss_words, khmer_letters, same_term
from .sketch import EMPTY, char_shingles, code_points, combine, mix, sketch

BOTH_BANDS, KHMER_BANDS, KHMER_ROWS = 8, 12, 3
#: Bins of the signature for each field, four bits each, and how many must agree: a true pair has about seven of the
#: Khmer bins and three of the gloss bins, an unrelated one none or one.
SIGNATURE, GLOSS_SIGNATURE, SIGNATURE_AGREE, GLOSS_AGREE = 12, 4, 4, 1
BUCKET, COMPONENT = 64, 64
#: Rows of a bucket that are compared each with each; more are divided by character pairs. Comparisons made at once.
HOT, PAIRS = 1024, 500_000
#: Counters of letters in ``bounds``: no two of a to z have one in common.
KHMER_BINS, GLOSS_BINS = 31, 26
ENTRY, EDGE = "key long, pos long, sig long, sig2 long", "a long, b long, hot boolean"


def comparison_keys(df: DataFrame, row_id: str, khmer: str = "khmer", gloss: str = "english", item_prefix: bool = False) -> DataFrame:
    """``pos, kkey, gkey, k1, k2`` of the rows that can be compared at all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            k = [khmer_letters(x, item_prefix) for x in b["_k"]]
            keep = np.array([bool(x) for x in k], dtype=bool)
            g = [gloss_words(x) if ok else "" for x, ok in zip(b["_g"], keep)]
            yield pd.DataFrame({"pos": b["pos"], "kkey": k, "gkey": g})[keep]

    read = df.select(F.col(row_id).cast("long").alias("pos"), F.col(khmer).alias("_k"), F.col(gloss).alias("_g"))
    read = read.where(F.length("_k") > 1)
    keys = read.mapInPandas(run, "pos long, kkey string, gkey string")
    return keys.withColumns({"k1": F.xxhash64("kkey", "gkey"), "k2": F.xxhash64("gkey", "kkey", F.lit(7))})


def signatures(two: np.ndarray, gloss: np.ndarray) -> np.ndarray:
    """Four bits of the last ``SIGNATURE`` bins of the Khmer sketch, and of the last of the gloss sketch (0 for a blank gloss)."""
    sig = np.zeros(len(two), dtype=np.uint64)
    for i in range(SIGNATURE):
        sig |= (mix(two[:, 2 * BOTH_BANDS + i]) & np.uint64(15)) << np.uint64(4 * (GLOSS_SIGNATURE + i))
    some = gloss[:, 0] != EMPTY
    for i in range(GLOSS_SIGNATURE):
        sig |= np.where(some, mix(gloss[:, BOTH_BANDS + i]) % np.uint64(15) + np.uint64(1), np.uint64(0)) << np.uint64(4 * i)
    return sig


def sketches(kkeys: list[str], gkeys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of the Khmer and of the gloss character pairs."""
    two = sketch(*char_shingles(kkeys, 2, seed=1), len(kkeys), 2 * BOTH_BANDS + SIGNATURE)
    return two, sketch(*char_shingles(gkeys, 2, seed=3), len(gkeys), BOTH_BANDS + GLOSS_SIGNATURE)


def band_keys(kkeys: list[str], gkeys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and bucket keys of all bands, and a signature per row."""
    n = len(kkeys)
    two, gloss = sketches(kkeys, gkeys)
    three = sketch(*char_shingles(kkeys, 3, seed=2), n, KHMER_BANDS * KHMER_ROWS)
    glossed = np.flatnonzero(gloss[:, 0] != EMPTY)
    at, keys = [], []
    for i in range(BOTH_BANDS):
        at.append(glossed)
        if i % 2:
            parts = two[glossed, 2 * i], two[glossed, 2 * i + 1], gloss[glossed, i]
        else:
            parts = two[glossed, 2 * i], gloss[glossed, i], gloss[glossed, i + 1]
        key = combine(*parts, np.full(len(glossed), i, np.uint64))
        # an odd key is one of gloss pairs
        keys.append(key & ~np.uint64(1) if i % 2 else key | np.uint64(1))
    for i in range(KHMER_BANDS):
        at.append(np.arange(n))
        keys.append(combine(*[three[:, KHMER_ROWS * i + j] for j in range(KHMER_ROWS)], np.full(n, 100 + i, np.uint64)) & ~np.uint64(1))
    return np.concatenate(at), np.concatenate(keys), signatures(two, gloss)


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            kkeys, gkeys = b["kkey"].tolist(), b["gkey"].tolist()
            at, keys, _ = band_keys(kkeys, gkeys)
            sig, sig2 = (x.view(np.int64)[at] for x in bounds(kkeys, gkeys))
            # 32 bits and an even number: rows that only meet by chance are excluded by their bounds
            key = (keys >> np.uint64(31) & ~np.uint64(1)).view(np.int64)
            yield pd.DataFrame({"key": key, "pos": b["pos"].to_numpy()[at], "sig": sig, "sig2": sig2})


def bounds(kkeys: list[str], gkeys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a row from which ``may_match`` bounds what two rows share: how often letters occur, 3 standing for more,
    by the Khmer code point modulo 31 and for each of a to z in the gloss (two planes of bits each), 6 bits of the gloss's
    length and 8 of the Khmer's, of which two stand above the Khmer planes."""
    glosses = [g.replace(" ", "") for g in gkeys]

    def letters(texts: list[str], bins: int) -> np.ndarray:
        flat, ends = code_points(texts)
        at = np.repeat(np.arange(len(texts)) * bins, np.diff(ends)) + (flat % np.uint64(bins)).astype(np.int64)
        n = np.minimum(np.bincount(at, minlength=len(texts) * bins), 3).reshape(-1, bins).astype(np.uint64)
        bit = np.arange(bins, dtype=np.uint64)
        return ((n & np.uint64(1)) << bit | (n >> np.uint64(1)) << (bit + np.uint64(bins))).sum(axis=1, dtype=np.uint64)

    long = np.array([[min(len(k), 255), min(len(g), 63)] for k, g in zip(kkeys, glosses)], dtype=np.uint64).reshape(-1, 2)
    sig = letters(kkeys, KHMER_BINS) | long[:, 0] >> np.uint64(6) << np.uint64(62)
    return sig, letters(glosses, GLOSS_BINS) | long[:, 1] << np.uint64(52) | long[:, 0] << np.uint64(58)


def _unshared(a: np.ndarray, b: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters that one row has more of than the other, at least: of the first, and of the second."""
    plane, up = np.uint64(2**bins - 1), np.uint64(bins)
    one, two = [], []  # whether a row has a letter at all and twice, side by side, and three times
    for x in (a, b):
        low, high = x & plane, x >> up & plane
        one.append(low | high | high << up)
        two.append(low & high)
    count = lambda x, y: np.bitwise_count(one[x] & ~one[y]).astype(np.int32) + np.bitwise_count(two[x] & ~two[y])
    return count(0, 1), count(1, 0)


def may_match(a: np.ndarray, a2: np.ndarray, b: np.ndarray, b2: np.ndarray, blank: bool | np.ndarray = False) -> np.ndarray:
    """False only where two rows cannot record one term: a letter that one of them has more of is not shared so often.

    Where ``blank``, one of the glosses must be blank.
    """
    a, a2, b, b2, blank = np.broadcast_arrays(a, a2, b, b2, blank)
    # KHMER_AGREE and GLOSS_AGREE of keys.same_term in whole numbers; a length that does not fit its bits bounds nothing
    la, lb = ((x >> np.uint64(62) << np.uint64(6) | y >> np.uint64(58)).astype(np.int32) for x, y in ((a, a2), (b, b2)))
    ga, gb = ((x >> np.uint64(52) & np.uint64(63)).astype(np.int32) for x in (a2, b2))
    open_k, none = (la == 255) | (lb == 255), (ga == 0) | (gb == 0)
    open_g = none | (~blank & (np.maximum(ga, gb) == 63))
    ok = (open_k | (10 * np.minimum(la, lb) >= 7 * np.maximum(la, lb))) & (open_g | (~blank & (4 * np.minimum(ga, gb) >= 3 * np.maximum(ga, gb))))
    for x, y, bins, nx, ny, most, least, free in ((a2, b2, GLOSS_BINS, ga, gb, 4, 3, open_g), (a, b, KHMER_BINS, la, lb, 10, 7, open_k)):
        at = np.flatnonzero(ok & ~free)
        nx, ny = nx[at], ny[at]
        more, other = _unshared(x[at], y[at], bins)
        agree = least * np.maximum(nx, ny)
        ok[at] = (most * more <= most * nx - agree) & (most * other <= most * ny - agree)
    return ok


def _numbered_pairs(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every character pair of the texts, a repeated one with its number: sets that overlap as the pairs do."""
    rows, h = char_shingles(texts, 2, seed=seed)
    o = np.lexsort((h, rows))
    rows, h = rows[o], h[o]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    number = np.arange(len(rows)) - np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    return rows, combine(h, number.astype(np.uint64))


def _first_pairs(texts: list[str], seed: int, agree: float, order: float, often: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of a text's rarest character pairs, as many as must hold one in common with any text that agrees.

    ``n`` pairs agree only with ``agree * (n + 1) - 1`` or more, so ``order`` asks for ``least`` in common, and all but
    ``least - 1`` of the pairs cannot miss them all if both texts leave out by the same order.
    """
    rows, h = _numbered_pairs(texts, seed)
    n = np.bincount(rows, minlength=len(texts))
    least = np.maximum(np.ceil(order / 2 * (n + agree * (n + 1) - 1) - 1e-9), 1).astype(np.int64)
    words, where = np.unique(h, return_inverse=True)
    df = np.array([often.get(int(w), 0) for w in words.view(np.int64)], dtype=np.int64)[where] if len(h) else np.zeros(0, np.int64)
    o = np.lexsort((h, df, rows))
    rows, h = rows[o], h[o]
    place = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
    keep = place < (n - least + 1)[rows]
    return rows[keep], h[keep]


def exact_pairs(rows: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` among rows ``grp, pos, kkey, gkey`` of one group, every pair that records one term among them.

    Glossed rows meet under a character pair of their glosses, rows without a gloss meet the others under one of the
    Khmer; which pairs of a row serve follows from the least agreement, so none is missed.
    """

    def glosses(b: pd.DataFrame) -> tuple[np.ndarray, list[str]]:
        some = np.flatnonzero((b["gkey"] != "").to_numpy())
        return some, [g.replace(" ", "") for g in b["gkey"].to_numpy()[some]]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = np.concatenate([_numbered_pairs(t, seed)[1] for t, seed in ((glosses(b)[1], 4), (b["kkey"].tolist(), 6))])
            words, n = np.unique(h, return_counts=True)
            yield pd.DataFrame({"h": words.view(np.int64), "n": n})

    # a number for each pair of letters of two scripts
    often = {r.h: r.n for r in rows.mapInPandas(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).collect()}

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            grp, pos, kkeys = b["grp"].to_numpy().view(np.uint64), b["pos"].to_numpy(), b["kkey"].tolist()
            sig, sig2 = (x.view(np.int64) for x in bounds(kkeys, b["gkey"].tolist()))
            some, texts = glosses(b)
            at, h = _first_pairs(texts, 4, GLOSS_SHARED, GLOSS_ORDER, often)
            at = some[at]
            alone, k = _first_pairs(kkeys, 6, KHMER_AGREE, KHMER_ORDER_ALONE, often)
            # an odd key is one under which a gloss must be blank
            key = np.concatenate([combine(grp[at], h) & ~np.uint64(1), combine(grp[alone], k) | np.uint64(1)])
            at = np.concatenate([at, alone])
            yield pd.DataFrame({"key": key.view(np.int64), "pos": pos[at], "sig": sig[at], "sig2": sig2[at]})

    return _bucket_pairs(rows.mapInPandas(keyed, ENTRY))


def _sorted_by_key(entries: DataFrame) -> DataFrame:
    parts = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return entries.repartition(parts, "key").sortWithinPartitions("key")


def _pairs_inside(most: int | None = None):
    """Pairs ``a, b`` of equal keys that ``may_match`` does not exclude; input is sorted by key, keys may span batches.

    Of a key with over ``most`` entries each comes out as ``a`` its key, ``b`` its row, ``hot``.
    """
    cols = ["key", "pos", "sig", "sig2"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail, hot_key = None, None

        def pairs(cur: dict[str, np.ndarray], first: np.ndarray, late: np.ndarray) -> Iterator[pd.DataFrame]:
            """Of the rows ``late`` with all before them, a stretch of about ``PAIRS`` at a time."""
            key, pos, sig, sig2 = (cur[c] for c in cols)
            sig, sig2 = sig.view(np.uint64), sig2.view(np.uint64)
            late = late[late > first[late]]
            total = np.cumsum(late - first[late])
            for part in np.split(late, np.searchsorted(total, np.arange(PAIRS, total[-1], PAIRS))) if len(late) else ():
                n = part - first[part]
                i = np.repeat(part, n)
                j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first[i]
                ok = may_match(sig[i], sig2[i], sig[j], sig2[j], (key[i] & 1) == 1) & (pos[i] != pos[j])
                x, y = pos[i[ok]], pos[j[ok]]
                if len(x):
                    both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
                    yield pd.DataFrame({"a": both[0], "b": both[1], "hot": False})

        for b in batches:
            cur, old = {c: b[c].to_numpy() for c in cols}, 0
            if not len(b):
                continue
            if tail is not None and tail["key"][0] == cur["key"][0]:
                old = len(tail["key"])
                cur = {c: np.concatenate([tail[c], cur[c]]) for c in cols}
            elif tail is not None and most is not None:  # it was whole
                yield from pairs(tail, np.zeros(len(tail["key"]), np.int64), np.arange(len(tail["key"])))
            key = cur["key"]
            first, idx = np.searchsorted(key, key, "left"), np.arange(len(key))
            if most is None:
                yield from pairs(cur, first, idx[old:])
                tail = {c: cur[c][first[-1] :] for c in cols}
                continue
            # a key that is still open waits, unless it is known to be hot
            hot = (np.searchsorted(key, key, "right") - first > most) | (key == hot_key if hot_key is not None else False)
            hot_key = key[-1] if hot[-1] else None
            if hot.any():
                yield pd.DataFrame({"a": key[hot], "b": cur["pos"][hot], "hot": True})
            done = first[-1]
            yield from pairs(cur, first, idx[:done][~hot[:done]])
            tail = None if hot[-1] else {c: cur[c][done:] for c in cols}
        if most is not None and tail is not None:
            n = len(tail["key"])
            yield from pairs(tail, np.zeros(n, np.int64), np.arange(n))

    return run


def _bucket_pairs(entries: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of entries with one key that ``may_match`` does not exclude."""
    return _sorted_by_key(entries).mapInPandas(_pairs_inside(), EDGE).select("a", "b").distinct()


_ONES, _GLOSS = np.uint64(0x1111111111111111), np.uint64(16**GLOSS_SIGNATURE - 1)


def fits(a: np.ndarray, b: np.ndarray, gloss: bool | np.ndarray = True) -> np.ndarray:
    """Whether two signatures agree in enough Khmer bins and, where ``gloss``, in a gloss bin, unless a gloss is blank."""
    x = a ^ b
    x = ~(x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & _ONES  # a bit for each equal bin
    khmer = np.bitwise_count(x & ~_GLOSS) >= SIGNATURE_AGREE
    blank = ((a & _GLOSS) == 0) | ((b & _GLOSS) == 0)
    return khmer & (~np.asarray(gloss) | blank | (np.bitwise_count(x & _GLOSS) >= GLOSS_AGREE))


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of the stars in every bucket; input is sorted by key, buckets may span batches."""
    open_key, leaders, leader_sigs, met = None, np.zeros(0, np.int64), np.zeros(0, np.uint64), 0
    for b in batches:
        key, pos, sig = b["key"].to_numpy(), b["pos"].to_numpy(), b["sig"].to_numpy().view(np.uint64)
        if not len(key):
            continue
        out_a, out_b = [], []
        start = 0
        if open_key is not None and key[0] == open_key:
            # the bucket that the last batch left open
            start = int(np.searchsorted(key, open_key, side="right"))
            for i in range(start):
                met += 1
                fit = np.flatnonzero(fits(leader_sigs, sig[i], met <= BUCKET or bool(key[0] & 1)))
                if len(fit):
                    out_a.append([leaders[fit[0]]])
                    out_b.append([pos[i]])
                else:
                    leaders, leader_sigs = np.append(leaders, pos[i]), np.append(leader_sigs, sig[i])
        if start < len(key):
            last = int(np.searchsorted(key, key[-1], side="left"))
            last = max(last, start)
            first_of = np.concatenate([[True], key[start + 1 :] != key[start:-1]])
            edge = np.flatnonzero(first_of)
            size = np.diff(np.concatenate([edge, [len(first_of)]]))
            small = np.repeat(size <= BUCKET, size) | (key[start:] & 1 == 1)
            idx = np.arange(start, len(key))
            idx = idx[np.repeat(size > 1, size) | (idx >= last)]  # one row alone gives no edge
            taken_of_last = []
            while len(idx):
                k = key[idx]
                first = np.ones(len(idx), dtype=bool)
                first[1:] = k[1:] != k[:-1]
                lead = idx[np.maximum.accumulate(np.where(first, np.arange(len(idx)), 0))]
                if idx[-1] >= last:
                    taken_of_last.append(int(lead[-1]))
                fit = ~first & fits(sig[lead], sig[idx], small[idx - start])
                out_a.append(pos[lead[fit]])
                out_b.append(pos[idx[fit]])
                idx = idx[~first & ~fit]
            new_leaders = np.array(sorted(set(taken_of_last)), dtype=np.int64)
            open_key, leaders, leader_sigs, met = key[-1], pos[new_leaders], sig[new_leaders], len(key) - last
        if out_a:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def _in_common(a: list[str], b: list[str], cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters that two texts share at most, as ``keys.shared`` counts them, and the longer one's; by pair."""
    held, long = [], []
    for texts in (a, b):
        flat, ends = code_points(texts)
        at = np.repeat(np.arange(len(texts)) * cells, np.diff(ends)) + (flat & np.uint64(cells - 1)).astype(np.int64)
        held.append(np.bincount(at, minlength=len(texts) * cells).reshape(-1, cells))
        long.append(np.diff(ends))
    return np.minimum(*held).sum(axis=1), np.maximum(*long)


def same_terms(ka: list[str], ga: list[str], kb: list[str], gb: list[str]) -> np.ndarray:
    """``same_term`` of many pairs; most are told apart by their characters, without a look at their order."""
    n, most = _in_common(ka, kb, 128)
    ok = 10 * n >= 7 * most
    some = np.flatnonzero(ok)
    x, y = ([g[i].replace(" ", "") for i in some] for g in (ga, gb))
    n, most = _in_common(x, y, 32)
    blank = np.array([not p or not q for p, q in zip(x, y)], dtype=bool)
    some = some[blank | (4 * n >= 3 * most)]
    ok = np.zeros(len(ka), dtype=bool)
    ok[some] = [same_term(ka[i], ga[i], kb[i], gb[i]) for i in some]
    return ok


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if len(b):
            yield b.loc[same_terms(*(b[c].tolist() for c in ("ka", "ga", "kb", "gb"))), ["a", "b"]]


def _with_texts(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    a = reps.select(F.col("pos").alias("a"), F.col("kkey").alias("ka"), F.col("gkey").alias("ga"))
    b = reps.select(F.col("pos").alias("b"), F.col("kkey").alias("kb"), F.col("gkey").alias("gb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ka", "ga", "kb", "gb")


def candidate_edges(reps: DataFrame) -> DataFrame:
    """Distinct pairs ``(a, b)`` of representatives ``(pos, kkey, gkey)`` that share a bucket and may record one term."""
    bands = reps.select("pos", "kkey", "gkey").mapInPandas(_bands, ENTRY)
    found = materialize(_sorted_by_key(bands).mapInPandas(_pairs_inside(HOT), EDGE), "bucket-pairs")
    pairs, hot = found.where("not hot").select("a", "b"), found.where("hot").select(F.col("a").alias("grp"), F.col("b").alias("pos"))
    if not hot.isEmpty():
        pairs = pairs.union(exact_pairs(hot.join(reps.select("pos", "kkey", "gkey"), "pos")))
    return pairs.distinct()


class TermGroups:
    """Groups of one table: ``members`` (pos, rep), ``groups`` (rep, comp) and ``links`` (a, b) between representatives."""

    def __init__(self, df: DataFrame, row_id: str = "pos_ord", khmer: str = "khmer", gloss: str = "english"):
        keyed = materialize(comparison_keys(df, row_id, khmer, gloss), "keyed")
        first = keyed.groupBy("k1", "k2").agg(F.min(F.struct("pos", "kkey", "gkey")).alias("r"), F.count("*").alias("n"))
        reps = materialize(first.select("k1", "k2", "r.*", "n"), "reps")
        self.reps = reps
        edges = _with_texts(candidate_edges(reps), reps).mapInPandas(_confirm, "a long, b long")
        self.groups = materialize(connected_components(edges), "groups")
        # rows of a class that has copies or a link
        wanted = reps.join(self.groups.select(F.col("id").alias("pos")), "pos", "left_semi").select("pos")
        wanted = wanted.union(reps.where("n > 1").select("pos")).distinct()
        few = reps.join(wanted, "pos", "left_semi").select("k1", "k2", F.col("pos").alias("rep"))
        self.members = materialize(keyed.select("k1", "k2", "pos").join(few, ["k1", "k2"]).select("pos", "rep"), "members")

    @cached_property
    def links(self) -> DataFrame:
        """``(a, b)``: pairs of representatives that record one term; classes alone do without."""
        sizes = self.groups.groupBy("comp").agg(F.count("*").alias("size"))
        inside = self.reps.join(self.groups, self.reps.pos == self.groups.id).join(sizes, "comp").select("pos", "kkey", "gkey", "comp", "size")
        inside = materialize(inside, "inside")
        few, many = inside.where(F.col("size") <= COMPONENT), inside.where(F.col("size") > COMPONENT)
        x, y = few.alias("x"), few.alias("y")
        pairs = x.join(y, F.expr("x.comp = y.comp and x.pos < y.pos")).select(
            F.col("x.pos").alias("a"), F.col("y.pos").alias("b"),
            F.col("x.kkey").alias("ka"), F.col("x.gkey").alias("ga"), F.col("y.kkey").alias("kb"), F.col("y.gkey").alias("gb"),
        )
        if not many.isEmpty():
            pairs = pairs.unionByName(_with_texts(exact_pairs(many.withColumnRenamed("comp", "grp")), many))
        return materialize(pairs.mapInPandas(_confirm, "a long, b long"), "links")

    def membership(self) -> DataFrame:
        """``(pos, group_row)``: rows of groups of two rows or more, with the group's smallest id."""
        g = self.groups.select(F.col("id").alias("rep"), "comp")
        return self.members.join(g, "rep", "left").select("pos", F.coalesce("comp", "rep").alias("group_row"))

    def row_pairs(self) -> DataFrame:
        """All pairs of rows that record the same term, ``pos_a < pos_b``."""
        m = self.members
        within = m.alias("x").join(m.alias("y"), F.expr("x.rep = y.rep and x.pos < y.pos"))
        within = within.select(F.col("x.pos").alias("pos_a"), F.col("y.pos").alias("pos_b"))
        across = self.links.join(m.select(F.col("rep").alias("a"), F.col("pos").alias("p")), "a")
        across = across.join(m.select(F.col("rep").alias("b"), F.col("pos").alias("q")), "b")
        across = across.select(F.least("p", "q").alias("pos_a"), F.greatest("p", "q").alias("pos_b"))
        return within.union(across)
