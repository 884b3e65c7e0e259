"""A blend of sources at target weights (problem 9).

Method: low-discrepancy source schedule.  Each source's distinct texts, in
hashed order, form one stream of tokens, cut into blocks of exactly ``block``
tokens; a text that crosses an edge lies in both blocks with its part.  The blend
is a row of slots of one block each; slot i takes the golden-ratio point
frac(i * phi) and the source in whose interval of the cumulative weights it
falls, so any stretch of the blend is close to the targets.  The n-th slot of a
source takes its n-th block, over again after the last one, at most
``max_repeats`` times.

All shares are reached: the blend ends before the first slot for which a source
has no block left, so its size is that of the source that its share and cap
exhaust first.  Without a given block size there are about ``SLOTS`` slots in a
small blend, so that a share is off by about a thousandth; in a large one a block
has ``BLOCK`` tokens.  ``total_tokens`` asks for a larger blend: a
source that runs out then gives all it may, and the others keep their proportions
(the least loss; ``shares`` shows it).  Weights are scaled to sum to 1 over the
targets that can be met: a share that is null or not positive, or a source
without documents, is left out and reported with its share reached of 0.

Cases: null and empty texts have no tokens and are not used; copies of a text,
in any source, are one text of the source of the smallest id; the last tokens of
a source, fewer than a block, are not used; documents of sources without a target
are not used; no target or no documents give an empty blend.  Nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

BLOCK, LEAST_BLOCK, SLOTS = 2_000, 8, 1_024
PHI = 0.6180339887498949
#: Rows that one window task numbers at most about.
CHUNK = 65_536
MOST_TARGETS = 100_000
TOKENIZER = "byte_bpe_multi_50k.tiktoken"

_loaded: dict[str, object] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str):
    """The tokenizer of a rank file, loaded once in each worker."""
    if path not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("termloom", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, order, tokens`` of every distinct text; copies count once, for their smallest id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path)
        for b in batches:
            yield b.drop(columns="t").assign(tokens=np.array([len(enc.encode_ordinary(t)) for t in b["t"]], dtype=np.int64))

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("t")).where(F.length("t") > 0)
    read = read.select("doc_id", "source", F.xxhash64("t").alias("h1"), F.xxhash64("t", F.lit(5)).alias("h2"), "t")
    # Texts are counted where they are read; only ids, hashes and counts are shuffled.
    counted = read.mapInPandas(run, "doc_id long, source string, h1 long, h2 long, tokens long").where("tokens > 0")
    first = counted.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("d"))
    return first.select("d.doc_id", "d.source", F.col("h1").alias("order"), "d.tokens")


def allocation(shares: np.ndarray, most: np.ndarray, total: float) -> np.ndarray:
    """Amounts in proportion to the shares, none above its most; what one lacks the others take over in proportion."""
    got, open_ = np.zeros(len(shares)), shares > 0
    while open_.any():
        scale = (total - got[~open_].sum()) / shares[open_].sum()
        over = open_ & (shares * scale >= most)
        if not over.any():
            got[open_] = shares[open_] * scale
            break
        got[over] = most[over]
        open_ &= ~over
    return got


def _points(slots):
    """Golden-ratio points of slots; the same arithmetic as in the plan."""
    x = slots * PHI
    return x - np.floor(x)


class Blend:
    """``rows`` (slot, source, pass, doc_id, from_token, tokens) and ``shares``."""

    def __init__(self, docs: DataFrame, targets: DataFrame, path: str | None = None, block: int | None = None, total_tokens: int | None = None):
        spark = docs.sparkSession
        counts = materialize(token_counts(docs, path or tokenizer_path()), "mix-counts")
        want = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
        of = counts.join(want.select("source"), "source")

        # stream position of every document: sums of chunks of the hashed order, then within the chunk
        parts = max(1, of.count() // CHUNK + 1)
        of = of.withColumn("chunk", F.pmod(F.shiftright("order", 3), F.lit(parts)).cast("int"))
        chunk_sum = of.groupBy("source", "chunk").agg(F.sum("tokens").alias("s"))
        before = chunk_sum.withColumn("before", F.sum("s").over(Window.partitionBy("source").orderBy("chunk")) - F.col("s")).drop("s")
        w = Window.partitionBy("source", "chunk").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
        placed = of.withColumn("inside", F.coalesce(F.sum("tokens").over(w), F.lit(0))).join(before, ["source", "chunk"])
        placed = placed.select("source", "doc_id", "tokens", (F.col("before") + F.col("inside")).alias("start"))

        # one row for each target: bounded by the target table, whose size is checked
        size = chunk_sum.groupBy("source").agg(F.sum("s").alias("size"))
        plan = want.join(size, "source", "left").withColumn("size", F.coalesce("size", F.lit(0)))
        p = plan.orderBy("source").limit(MOST_TARGETS + 1).toPandas()
        if len(p) > MOST_TARGETS:
            raise ValueError(f"more than {MOST_TARGETS} targets")
        usable = (p["target_share"].fillna(0) > 0) & (p["size"] > 0) & (p["max_repeats"] > 0)
        share = np.where(usable, p["target_share"].fillna(0), 0.0).astype(float)
        share = share / share.sum() if share.any() else share
        most = (p["max_repeats"] * p["size"]).to_numpy(float)
        on = share > 0
        exact = (most[on] / share[on]).min() if on.any() else 0.0
        asked = exact if total_tokens is None else min(float(total_tokens), most[on].sum() if on.any() else 0.0)
        self.block = b = block or int(max(1, min([BLOCK, max(LEAST_BLOCK, asked // SLOTS), *p["size"][on]])))
        blocks = (p["size"] // b).to_numpy()
        on &= blocks > 0
        caps = np.where(on, p["max_repeats"] * blocks, 0).astype(float)
        weight = np.where(on, share, 0.0)
        if on.any():
            weight = allocation(weight / weight.sum(), caps, min(asked / b, caps.sum()))
        n_slots = int(weight.sum())
        weight = weight / weight.sum() if n_slots else weight
        to = weight.cumsum()
        self.plan = p = p.assign(share=share, blocks=blocks, weight=weight, until=to, since=to - weight)
        on = p[p["weight"] > 0].reset_index(drop=True)
        self._want = want
        bounds = spark.createDataFrame(on[["source", "blocks", "max_repeats"]], "source string, blocks long, max_repeats int")

        slot = spark.range(n_slots).withColumn("u", F.col("id") * PHI - F.floor(F.col("id") * PHI))
        if len(on) <= 200:
            pick = F.lit(None).cast("string")
            for since, s in zip(on["since"], on["source"]):
                pick = F.when(F.col("u") >= float(since), F.lit(s)).otherwise(pick)
            slots = slot.select(F.col("id").alias("slot"), pick.alias("source"))
        else:
            edges, names = on["since"].to_numpy(), on["source"].to_numpy()

            def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for x in batches:
                    yield pd.DataFrame({"slot": x["id"], "source": names[np.searchsorted(edges, x["u"], "right") - 1]})

            slots = slot.mapInPandas(assign, "slot long, source string")
        slots = slots.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
        slot_sum = slots.groupBy("source", "chunk").count()
        ahead = slot_sum.withColumn("ahead", F.sum("count").over(Window.partitionBy("source").orderBy("chunk")) - F.col("count"))
        ahead = materialize(ahead, "mix-slots")
        # the first slot that finds its source used up: it lies in the first chunk that exceeds the source's cap
        over = ahead.join(F.broadcast(bounds), "source").where(F.col("ahead") + F.col("count") > F.col("blocks") * F.col("max_repeats"))
        end = n_slots
        for x in over.groupBy("source").agg(F.min(F.struct("chunk", "ahead")).alias("x"), F.first("blocks").alias("blocks"), F.first("max_repeats").alias("cap")).collect():
            t = on[on["source"] == x.source].iloc[0]
            i = np.arange(x.x.chunk * CHUNK, min((x.x.chunk + 1) * CHUNK, n_slots))
            u = _points(i)
            upper = on["since"][on["since"] > t.since].min()  # the next source's edge, as in the plan
            own = i[(u >= t.since) & ~(u >= upper)]
            end = min(end, int(own[x.blocks * x.cap - x.x.ahead]))
        self.n_slots = end
        rank = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
        ranked = slots.where(F.col("slot") < end).withColumn("r", rank).join(ahead.drop("count"), ["source", "chunk"])
        ranked = ranked.select("slot", "source", (F.col("ahead") + F.col("r")).alias("rank")).join(F.broadcast(bounds), "source")
        ranked = ranked.select("slot", "source", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), F.pmod("rank", F.col("blocks")).alias("block"))

        # the parts of the documents in each block
        first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("tokens") - 1) / b)
        inside = placed.join(F.broadcast(bounds.select("source", "blocks")), "source").where(first < F.col("blocks"))
        inside = inside.withColumn("block", F.explode(F.sequence(first, F.least(last, F.col("blocks") - 1))))
        since = F.greatest(F.col("block") * b - F.col("start"), F.lit(0))
        until = F.least((F.col("block") + 1) * b - F.col("start"), F.col("tokens"))
        inside = inside.select("source", "block", "doc_id", since.alias("from_token"), (until - since).alias("tokens"))
        self.rows = ranked.join(inside, ["source", "block"]).select("slot", "source", "pass", "doc_id", "from_token", "tokens")

    def shares(self) -> DataFrame:
        """``source, target_share, weight, tokens, actual_share, most_uses`` for each target."""
        spark = self.rows.sparkSession
        rows = materialize(self.rows, "mix-rows")
        uses = rows.groupBy("source", "doc_id", "from_token").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
        got = uses.groupBy("source").agg(F.sum("t").alias("tokens"), F.max("n").alias("most_uses"))
        got = got.withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy(F.lit(0))))  # a row for each target
        weights = spark.createDataFrame(self.plan[["source", "share"]].rename(columns={"share": "weight"}), "source string, weight double")
        j = self._want.join(weights, "source", "left").join(got, "source", "left")
        return j.select(
            "source", "target_share", "weight", F.coalesce("tokens", F.lit(0)).alias("tokens"),
            F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
            "max_repeats",
        )
