"""Operators over event streams: a keyed rate limit, top misses, resumable work."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LIMIT, SECONDS = 60, 60


def rate_limit(events: DataFrame, client: str, time: str, event_id: str, limit: int = LIMIT, seconds: int = SECONDS) -> DataFrame:
    """``event_id, client, accepted`` of logged events, in batch.

    An event is accepted if fewer than ``limit`` accepted ones of its client lie
    in the window before it (older than the window means strictly older); what is
    rejected uses up nothing.  Clients are handled one group at a time by the
    Arrow worker in time order, and only the accepted times of the last window
    are kept, so memory does not grow with a client's history.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from collections import deque

        who, recent = object(), deque()
        for b in batches:
            ok = []
            for c, t in zip(b["c"], b["t"]):
                if c != who:
                    who, recent = c, deque()
                while recent and recent[0] < t - seconds * 1_000_000:
                    recent.popleft()
                ok.append(len(recent) < limit)
                if ok[-1]:
                    recent.append(t)
            yield pd.DataFrame({"event_id": b["id"], "client": b["c"], "accepted": ok})

    micros = F.unix_micros(F.col(time).cast("timestamp"))
    e = events.select(F.col(event_id).alias("id"), F.col(client).cast("string").alias("c"), micros.alias("t"))
    kind = dict(e.dtypes)["id"]
    return e.repartition("c").sortWithinPartitions("c", "t", "id").mapInPandas(run, f"event_id {kind}, client string, accepted boolean")


def _step(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState, limit: int, seconds: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        # nothing of the client lies in the window any more: it needs no state
        state.remove()
        return
    recent = list(state.get[0]) if state.exists else []
    rows = pd.concat(list(frames)).sort_values(["t", "event_id"])
    ok = []
    for t in rows["t"]:
        recent = [x for x in recent if x >= t - seconds * 1_000_000]
        ok.append(len(recent) < limit)
        if ok[-1]:
            recent.append(int(t))
    state.update((recent,))
    if recent:
        state.setTimeoutTimestamp(max(recent[-1] // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame({"event_id": rows["event_id"], "client": key[0], "accepted": ok})


def rate_limit_stream(events: DataFrame, client: str, time: str, event_id: str, limit: int = LIMIT, seconds: int = SECONDS, late: str = "10 minutes") -> DataFrame:
    """The same on a stream: at most ``limit`` times are kept as state of a client.

    A client's state is dropped when the watermark (``late`` behind the newest
    event) has passed its window, so the state does not grow with the clients
    ever seen; until then no decision can depend on it being there or not.
    """
    e = events.withColumn("_w", F.col(time).cast("timestamp")).withWatermark("_w", late)
    e = e.select(F.col(event_id).cast("long").alias("event_id"), F.col(client).cast("string").alias("client"), F.unix_micros("_w").alias("t"), "_w")

    def step(key, frames, state):
        return _step(key, frames, state, limit, seconds)

    return e.groupBy("client").applyInPandasWithState(
        step, "event_id long, client string, accepted boolean", "recent array<bigint>", "append", GroupStateTimeout.EventTimeTimeout
    )


def top_misses(events: DataFrame, query: str, most: int = 40, kind: Column | None = None) -> DataFrame:
    """``query, n``: the most frequent queries without a result; ties by query."""
    e = events.where(kind) if kind is not None else events
    return e.where(F.col(query).isNotNull()).groupBy(F.col(query).alias("query")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "query").limit(most)


def recent_reports(events: DataFrame, kind: str, time: str, order: str, most: int = 40) -> DataFrame:
    """The newest events of a kind."""
    return events.where(F.col("kind") == kind).orderBy(F.desc(time), F.desc(order)).limit(most)


#: How long the fields of a report may be.
REPORT_FIELDS = {"khmer": 200, "entry_id": 60, "source": 120, "message": 2000, "contact": 200}


def clip_reports(reports: DataFrame) -> DataFrame:
    """Reports with over-long fields cut, as they are taken in; one without a message is left out."""
    r = reports.where(F.length(F.trim("message")) > 0)
    return r.withColumns({c: F.substring(F.coalesce(F.col(c), F.lit("")), 1, n) for c, n in REPORT_FIELDS.items() if c in r.columns})


def zero_results(searches: DataFrame, totals: str = "total") -> DataFrame:
    """Searches that found nothing, as events to append to the log."""
    return searches.where(F.col(totals) == 0).withColumn("kind", F.lit("zero_result"))


def append_events(stream: DataFrame, path: str, checkpoint: str):
    """A stream of events appended to a JSON log, exactly once."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
