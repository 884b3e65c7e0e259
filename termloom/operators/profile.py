"""Column-level data quality profile and changes between loads (problem 6).

Exact aggregates per load and column come from one pass each.  For changes a
classifier two-sample test asks, load by load, how well a logistic regression
can tell the load's rows from the usual ones: by each column with all others
ablated, against the median load, and by all columns together, against all rows,
where each column is then ablated in turn (its part of the score is replaced by
its mean; the loss is the log-likelihood per row that this costs).  The model of
all columns is stacked on the others: it reads each column's held-out score in
``BINS`` bins.  A column changed if it discriminates by itself and the model of
all columns needs it.

Every row is described by a bounded set of attributes per column (blank, length,
case, script, words, ending, coding).  Spark counts the rows of each attribute
pattern by load and fold, over all data and in one pass; the regressions run on
these weighted patterns, so nothing is sampled.  They are fitted together by
distributed Newton steps: tasks sum up gradients and curvature of their part of
the patterns, a shuffle adds them up by model, and only the weights come to the
driver (some hundreds of numbers a model).  Both the load and what it is compared
with are folded by row, and discrimination is cross-fitted: the area under the
curve is always measured on the fold the model was not fitted on.  Twice the
area, less one, is at least the share of rows that depart.

Cases: null and blank values count as blank, and a load in which all columns are
blank is judged like any other; a load without rows is not there; a null load
number is a load of its own; with fewer than three loads there is no median and
no change is reported; repeated rows count as often as they occur; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FOLDS = 2
#: Least share of departing rows, and least distance from chance in standard errors, for a report.
DEPART, SIGNIFICANT = 0.18, 4.0
#: Least loss of log-likelihood a row when the column is ablated from the model of all columns.
ABLATION = 0.0005
RIDGE, ROUNDS, STEP = 1.0, 10, 0.02
#: Loads that are fitted at a time; their weights are on the driver.
LOADS_AT_ONCE = 256
_LEVELS = (2, 8, 5, 32, 6, 16, 4)
#: Edges of the bins in which the model of all columns reads a column's log-odds.
EDGES = (-1.0, 0.0, 1.0)
BINS = len(EDGES) + 1


def blank(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c)), F.lit(0)) == 0


def column_profile(df: DataFrame, load: str, columns: Sequence[str], usual: dict[str, str] | None = None) -> DataFrame:
    """One row per load and column: rows, blanks, distinct values, range of values and lengths, pattern violations.

    ``usual`` gives a regular expression of the usual form for a column.
    """
    usual = usual or {}
    each = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.when(~blank(F.col(c)), F.col(c).cast("string")).alias("v"),
                 (F.lit(c in usual) & ~blank(F.col(c)) & ~F.coalesce(F.col(c).rlike(usual.get(c, ".")), F.lit(False))).alias("off"))
        for c in columns
    ]))
    long = df.select(F.col(load).alias("load_no"), each.alias("x")).select("load_no", "x.*")
    # Values are counted first, so a value that many rows share is one row of the second aggregate.
    values = long.groupBy("load_no", "column_name", "v").agg(F.count("*").alias("n"), F.count_if("off").alias("off"))
    return values.groupBy("load_no", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_blank"),
        F.count("v").alias("n_distinct"),
        F.min("v").alias("least"),
        F.max("v").alias("greatest"),
        F.min(F.length("v")).cast("long").alias("shortest"),
        F.max(F.length("v")).cast("long").alias("longest"),
        F.max(F.when(F.col("v").isNotNull(), F.col("n"))).alias("most_repeated"),
        F.sum("off").alias("n_violations"),
    )


def attribute_pattern(c: Column) -> Column:
    """Attributes of a value as one integer, of mixed radix ``_LEVELS``."""
    v = F.trim(c)
    has = v.rlike
    upper, lower = has("\\p{Lu}"), has("\\p{Ll}")
    case = (
        F.when(upper & ~lower, 2).when(lower & ~upper, 1).when(upper & lower & has("^\\p{Lu}[^\\p{Lu}]*$"), 3).when(upper & lower, 4).otherwise(0)
    )
    script = (
        F.when(has("[A-Za-z]"), 1).otherwise(0) + F.when(has("[\\u00c0-\\u024f]"), 2).otherwise(0) + F.when(has("[\\u1780-\\u17d3]"), 4).otherwise(0)
        + F.when(has("[0-9\\u17e0-\\u17e9]"), 8).otherwise(0) + F.when(has("[^A-Za-z\\u00c0-\\u024f\\u1780-\\u17ff0-9\\s\\p{P}]"), 16).otherwise(0)
    )
    words = F.least(F.size(F.split(v, "\\s+")), F.lit(5))
    ending = F.pmod(F.xxhash64(F.lower(F.regexp_extract(v, "(\\w{1,2})\\W*$", 1))), F.lit(16)).cast("int")
    coding = (
        F.when(has("[\\u00c2\\u00c3\\u00e2\\u00e1][\\u0080-\\u00bf\\u0152-\\u0192\\u2013-\\u20ac\\u2122]"), 1).otherwise(0)
        + F.when(has("&[#a-zA-Z0-9]+;|\\\\[ux]|%[0-9A-F]{2}|\\ufffd|\\?{2,}|[_=+]"), 2).otherwise(0)
    )
    length = F.least(F.floor(F.log2(F.length(v))), F.lit(7)).cast("int")
    code = F.lit(1)
    for value, level in zip((length, case, script, words, ending, coding), _LEVELS[1:]):
        code = code * level + F.coalesce(value, F.lit(0))
    return F.when(blank(c), F.lit(0)).otherwise(code).cast("int")


def _attributes(codes: np.ndarray) -> np.ndarray:
    """Feature numbers of every attribute of every column, ``rows x (columns * attributes)``; -1 for none.

    ``codes`` is ``rows x columns``: -1 for an ablated column, 0 for a blank value, of which only the first attribute counts.
    """
    out = np.full((len(codes), codes.shape[1] * len(_LEVELS)), -1, dtype=np.int64)
    size = sum(_LEVELS)
    for j in range(codes.shape[1]):
        rest, at = codes[:, j].copy(), (j + 1) * size
        some = rest > 0
        for i in range(len(_LEVELS) - 1, -1, -1):
            at -= _LEVELS[i]
            digit = rest % _LEVELS[i]
            rest = rest // _LEVELS[i]
            out[some, j * len(_LEVELS) + i] = at + digit[some]
        out[codes[:, j] == 0, j * len(_LEVELS)] = j * size
    return out


def _bins(codes: np.ndarray) -> np.ndarray:
    """Feature numbers of the bins of every column."""
    return codes + np.arange(codes.shape[1]) * BINS


def area(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """Weighted area under the curve; ties count half."""
    _, inv = np.unique(score, return_inverse=True)
    p, n = np.bincount(inv, pos), np.bincount(inv, neg)
    below = np.cumsum(n) - n
    total = p.sum() * n.sum()
    return float((p * (below + n / 2)).sum() / total) if total else 0.5


def _design(codes: np.ndarray, features=_attributes) -> tuple[np.ndarray, np.ndarray]:
    """Indicator matrix with a constant, over the features that occur, and their numbers (the constant is -1)."""
    f = features(codes)
    used = np.unique(f)
    used = used[used >= 0]
    x = np.zeros((len(codes), len(used) + 1))
    x[:, 0] = 1.0
    for k in range(f.shape[1]):
        some = np.flatnonzero(f[:, k] >= 0)
        x[some, 1 + np.searchsorted(used, f[some, k])] = 1.0
    return x, np.concatenate([[-1], used])


_MODEL = ["li", "m", "fold"]
_PART = "li int, m int, fold int, used array<int>, g array<double>, h array<double>, mean array<double>"


def _balanced(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both classes, alike in total."""
    half = 0.5 * (b["n_all"].to_numpy() + 1)
    return b["n"].to_numpy() / np.maximum(b["n_all"].to_numpy(), 1e-9) * half, b["r"].to_numpy() / np.maximum(b["r_all"].to_numpy(), 1e-9) * half


def _newton_parts(weights: dict[tuple[int, int, int], dict[int, float]], features):
    """Gradient, curvature and mean of the features of each model, over one task's patterns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            a, r = _balanced(b)
            for key, at in b.groupby(_MODEL).indices.items():
                x, used = _design(np.stack(b["codes"].to_numpy()[at]).astype(np.int64), features)
                known = weights.get(tuple(int(k) for k in key), {})
                w = np.array([known.get(int(u), 0.0) for u in used])
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                g = x.T @ (a[at] * (1 - p) - r[at] * p)
                h = (x * ((a[at] + r[at]) * p * (1 - p))[:, None]).T @ x
                out.append((*key, used, g, h.ravel(), x.T @ (a[at] + r[at])))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PART.split(", ")])

    return run


def _newton_step(parts: pd.DataFrame) -> pd.DataFrame:
    """The parts of one model added up, and the step they call for."""
    used = np.unique(np.concatenate(parts["used"].to_list()))
    g, h, mean = np.zeros(len(used)), np.zeros((len(used), len(used))), np.zeros(len(used))
    for u, gi, hi, mi in zip(parts["used"], parts["g"], parts["h"], parts["mean"]):
        at = np.searchsorted(used, u)
        g[at] += gi
        h[np.ix_(at, at)] += np.reshape(hi, (len(at), len(at)))
        mean[at] += mi
    key = {k: [parts[k].iloc[0]] for k in _MODEL}
    return pd.DataFrame({**key, "used": [used], "g": [g], "h": [h.ravel()], "mean": [mean / max(mean[0], 1e-9)]})


def fit_logistic(patterns: DataFrame, features=_attributes, rounds: int = ROUNDS, ridge: float = RIDGE) -> dict[tuple[int, int, int], tuple[dict[int, float], dict[int, float]]]:
    """Weights and feature means of all models ``(li, m, fold)``, fitted together on ``codes`` with ``n, r, n_all, r_all``."""
    weights: dict[tuple[int, int, int], dict[int, float]] = {}
    means: dict[tuple[int, int, int], dict[int, float]] = {}

    def solve(parts: pd.DataFrame) -> pd.DataFrame:
        s = _newton_step(parts)
        used = s["used"][0]
        known = weights.get(tuple(int(s[k][0]) for k in _MODEL), {})
        w = np.array([known.get(int(u), 0.0) for u in used])
        step = np.linalg.solve(np.reshape(s["h"][0], (len(used), len(used))) + ridge * np.eye(len(used)), s["g"][0] - ridge * w)
        return s.assign(g=[w + step], h=[np.array([np.abs(step).max()])])

    n = int(patterns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(rounds):
        parts = patterns.mapInPandas(_newton_parts(dict(weights), features), _PART).repartition(n, *_MODEL)
        new = parts.groupBy(*_MODEL).applyInPandas(solve, _PART).collect()  # some hundreds of numbers a model
        for x in new:
            key = (x.li, x.m, x.fold)
            weights[key] = dict(zip(x.used, x.g))
            means[key] = dict(zip(x.used, x["mean"]))
        if all(x.h[0] < STEP for x in new):
            break
    return {k: (w, means[k]) for k, w in weights.items()}


def _scores(models: dict, n_columns: int, features=_attributes, size: int = 0):
    """Held-out patterns scored by the model of the other folds; with ``size`` features a column, what ablating each column costs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            a, r = _balanced(b)
            for key, at in b.groupby(_MODEL).indices.items():
                x, used = _design(np.stack(b["codes"].to_numpy()[at]).astype(np.int64), features)
                w, mean = models.get(tuple(int(k) for k in key), ({}, {}))
                part = x * np.array([w.get(int(u), 0.0) for u in used])
                s = np.clip(part.sum(axis=1), -30, 30)
                if not size:
                    out.append(pd.DataFrame({**dict(zip(_MODEL, key)), "c": -1, "score": np.round(s * 1e6).astype(np.int64), "n": b["n"].to_numpy()[at], "r": b["r"].to_numpy()[at]}))
                    continue
                ll = lambda z: -a[at] * np.logaddexp(0, -z) - r[at] * np.logaddexp(0, z)
                for c in range(n_columns):
                    own = (used >= c * size) & (used < (c + 1) * size)
                    usual = sum(w.get(f, 0.0) * v for f, v in mean.items() if c * size <= f < (c + 1) * size)
                    lost = (ll(s) - ll(np.clip(s - part[:, own].sum(axis=1) + usual, -30, 30))).sum()
                    out.append(pd.DataFrame({**{k: [v] for k, v in zip(_MODEL, key)}, "c": c, "score": 0, "n": [lost], "r": [(a[at] + r[at]).sum()]}))
            yield pd.concat(out) if out else pd.DataFrame({k: [] for k in [*_MODEL, "c", "score", "n", "r"]})

    return run


def _stacked(models: dict, pats: list[str], n_loads: int):
    """Every row's bins under each load's models of single columns: ``li, fold, code`` with the rows of the load (``n``) and of all loads (``r``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for fold, x in b.groupby("fold"):
                code = np.zeros((len(x), n_loads), dtype=np.int64)
                for c, p in enumerate(pats):
                    seen, inv = np.unique(x[p].to_numpy(), return_inverse=True)
                    codes = np.full((len(seen), len(pats)), -1, dtype=np.int64)
                    codes[:, c] = seen
                    d, used = _design(codes)
                    w = np.array([[models.get((li, c, fold), ({}, {}))[0].get(int(u), 0.0) for li in range(n_loads)] for u in used])
                    code = code * BINS + np.digitize(d @ w, EDGES)[inv]
                li, n = x["li"].to_numpy(), x["n"].to_numpy(float)
                for i in range(n_loads):
                    seen, inv = np.unique(code[:, i], return_inverse=True)
                    out.append(pd.DataFrame({"li": i, "fold": fold, "code": seen, "n": np.bincount(inv, n * (li == i), len(seen)), "r": np.bincount(inv, n, len(seen))}))
            yield pd.concat(out) if out else pd.DataFrame({k: [] for k in ("li", "fold", "code", "n", "r")})

    return run


def load_changes(df: DataFrame, load: str, columns: Sequence[str], row_key: Column | None = None) -> DataFrame:
    """``load_no, column_name, area, departing, ablation_loss, changed`` for every load and column.

    ``row_key`` decides the fold of a row and should be an id; without it rows are told apart by their place in the input.
    """
    spark, cols = df.sparkSession, list(columns)
    kind = dict(df.dtypes)[load]
    key = row_key if row_key is not None else F.monotonically_increasing_id()
    pats = [f"p_{i}" for i in range(len(cols))]
    rows = df.select(
        F.col(load).alias("load_no"), F.pmod(F.xxhash64(key, F.lit(11)), F.lit(FOLDS)).cast("int").alias("fold"),
        *[attribute_pattern(F.col(c)).alias(p) for c, p in zip(cols, pats)],
    )
    counts = materialize(rows.groupBy("load_no", "fold", *pats).agg(F.count("*").alias("n")), "profile-patterns")
    # One number per load comes to the driver.
    loads = [r[0] for r in counts.select("load_no").distinct().collect()]
    schema = f"load_no {kind}, column_name string, area double, departing double, ablation_loss double, changed boolean"
    if len(loads) < 3:
        return spark.createDataFrame([], schema)
    out = None
    for at in range(0, len(loads), LOADS_AT_ONCE):
        some = _changes(counts, loads, loads[at : at + LOADS_AT_ONCE], cols, pats, kind)
        out = some if out is None else out.unionByName(some)
    return out


def _changes(counts: DataFrame, loads: list, wanted: list, cols: list[str], pats: list[str], kind: str) -> DataFrame:
    spark = counts.sparkSession
    k = len(cols)
    # One row for each load, of which there are at most LOADS_AT_ONCE.
    numbered = F.broadcast(spark.createDataFrame([(x, i) for i, x in enumerate(wanted)], f"load_no {kind}, li int"))
    mine = counts.join(numbered, counts.load_no.eqNullSafe(numbered.load_no)).drop(numbered.load_no)

    # each column alone against the median load; a pattern that a load lacks has share 0 there
    single = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(p).alias("p")) for i, p in enumerate(pats)])).alias("x")
    alone = counts.select("load_no", "fold", "n", single).groupBy("load_no", "fold", "x.c", "x.p").agg(F.sum("n").alias("n"))
    total = counts.groupBy(F.col("load_no").alias("_l"), F.col("fold").alias("_f")).agg(F.sum("n").alias("total"))
    share = alone.join(F.broadcast(total) if len(loads) <= 10_000 else total, F.col("load_no").eqNullSafe(F.col("_l")) & (F.col("fold") == F.col("_f")))
    med = share.groupBy("fold", "c", "p").agg(F.sort_array(F.collect_list(F.col("n") / F.col("total")), asc=False).alias("s"))  # a number for each load
    med = med.select("fold", "c", "p", F.get("s", F.lit(len(loads) // 2)).alias("r")).where("r > 0")
    each = F.explode(F.sequence(F.lit(0), F.lit(len(wanted) - 1))).alias("li")
    codes = F.coalesce(*[F.when(F.col("c") == i, F.array(*[F.col("p") if j == i else F.lit(-1) for j in range(k)])) for i in range(k)])
    own = mine.select("li", "fold", "n", single).groupBy("li", "fold", "x.c", "x.p").agg(F.sum("n").cast("double").alias("n"))
    t1 = own.withColumn("r", F.lit(0.0)).unionByName(med.select(each, "fold", "c", "p", F.lit(0.0).alias("n"), "r"))
    t1 = t1.groupBy("li", "fold", "c", "p").agg(F.sum("n").alias("n"), F.sum("r").alias("r")).select("li", F.col("c").alias("m"), "fold", codes.alias("codes"), "n", "r")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def to_fit(held: DataFrame, label: str) -> DataFrame:
        # A pattern of one fold serves to fit the models that are held against the other ones.
        others = F.explode(F.array(*[F.lit(f) for f in range(FOLDS)])).alias("held")
        x = held.select("li", "m", others, "fold", "codes", "n", "r").where("held <> fold").drop("fold").withColumnRenamed("held", "fold")
        spread = F.pmod(F.xxhash64("codes"), F.lit(4))
        return materialize(with_totals(x).repartition(parts, *_MODEL, spread).sortWithinPartitions(*_MODEL), label)

    def with_totals(x: DataFrame) -> DataFrame:
        t = x.groupBy(*_MODEL).agg(F.sum("n").alias("n_all"), F.sum("r").alias("r_all"))
        return x.join(F.broadcast(t), _MODEL)  # a row for each model

    schema = "li int, m int, fold int, c int, score long, n double, r double"
    held = materialize(t1, "profile-held")
    models = fit_logistic(to_fit(held, "profile-fit"))
    alone = with_totals(held).mapInPandas(_scores(models, k), schema)

    # all columns at once against all rows, by the bins of their held-out scores
    rows = counts.join(numbered, counts.load_no.eqNullSafe(numbered.load_no), "left").select("fold", *pats, "n", F.coalesce("li", F.lit(-1)).alias("li"))
    bins = rows.mapInPandas(_stacked(models, pats, len(wanted)), "li int, fold int, code long, n double, r double")
    digits = F.array(*[F.pmod(F.floor(F.col("code") / BINS ** (k - 1 - i)), F.lit(BINS)).cast("int") for i in range(k)])
    bins = bins.groupBy("li", "fold", "code").agg(F.sum("n").alias("n"), F.sum("r").alias("r")).select("li", F.lit(k).alias("m"), "fold", digits.alias("codes"), "n", "r")
    held = materialize(bins, "profile-bins")
    models = fit_logistic(to_fit(held, "profile-fit-all"), _bins)
    together = with_totals(held).mapInPandas(_scores(models, k, _bins, BINS), schema)
    cells = alone.unionByName(together).groupBy(*_MODEL, "c", "score").agg(F.sum("n").alias("n"), F.sum("r").alias("r"))

    def judge(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        li = key[0]
        res = []
        for i, c in enumerate(cols):
            mine, aucs, sizes = x[(x["m"] == i) & (x["c"] == -1)], [], []
            for _, y in mine.groupby("fold"):
                if y["n"].sum() > 0 and y["r"].sum() > 0:
                    aucs.append(area(y["score"].to_numpy(), y["n"].to_numpy(), y["r"].to_numpy()))
                    sizes.append(y["n"].sum())
            lost = x[x["c"] == i]
            a = float(np.average(aucs, weights=sizes)) if aucs else 0.5
            loss = float(lost["n"].sum() / max(lost["r"].sum(), 1e-9))
            se = 1.5 * float(np.sqrt(1 / (12 * max(sum(sizes), 1))))
            res.append((int(li), c, a, 2 * a - 1, loss, bool(2 * a - 1 >= DEPART and a - 0.5 >= SIGNIFICANT * se and loss >= ABLATION)))
        return pd.DataFrame(res, columns=["li", "column_name", "area", "departing", "ablation_loss", "changed"])

    judged = cells.groupBy("li").applyInPandas(judge, "li int, column_name string, area double, departing double, ablation_loss double, changed boolean")
    return judged.join(numbered, "li").select("load_no", "column_name", "area", "departing", "ablation_loss", "changed")
