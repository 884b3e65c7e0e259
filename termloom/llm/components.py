"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, comp)`` for every end of an edge ``(a, b)``; ``comp`` is the smallest id that can be reached.

    Large-star and small-star rounds: each connects a node's neighbours to the
    least of them, once for the larger neighbours and once for the smaller, so
    a path of n nodes takes O(log n) rounds, a star none.  Every round ends in
    a table in the shared folder.  A node's neighbours are only ever joined to
    their minimum (a map-side aggregate), never collected.
    """
    e = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    if e.isEmpty():
        return e.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    while True:
        # large star: larger neighbours of a node move to its least neighbour
        both = e.union(e.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: smaller neighbours and the node itself move to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = materialize(small, label)
        # a forest of stars stays as it is
        same = new.groupBy().agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        old = e.groupBy().agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        e = new
        if same == old:
            break
    nodes = e.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    return nodes.union(e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
