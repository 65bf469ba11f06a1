"""Connected components of a graph that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import forget, save

#: A vertex with more edges than this, and than a thousandth of all, is a hub: there are 2,000 at most.
HUB = 500


def with_least(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """edges with the m that least (a, m, c) has for their a. Hubs' edges stay where they are; the others are joined by a."""
    hubs = F.broadcast(least.where(F.col("c") > hub).select("a", F.col("m").alias("hub_m")))
    x = edges.join(hubs, "a", "left")
    rest = x.where("hub_m IS NULL").select("a", "b").join(least.where(F.col("c") <= hub).select("a", "m"), "a")
    return x.where("hub_m IS NOT NULL").select("a", "b", F.col("hub_m").alias("m")).unionByName(rest)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in edges (a long, b long): the smallest id reachable.

    Alternates two star steps. In the first, each vertex hands its larger neighbours to the smallest vertex it sees; in the
    second its smaller ones. Both keep the components and shrink the paths, in a number of rounds that grows with the
    logarithm of a component's size. Hubs cost no more than their edges: a step is a minimum (combined before the shuffle)
    joined back, that of hubs by broadcast. Every round's edges are written to the shared folder. Null ends and loops are ignored; repeated edges
    count once; no edges give no rows.
    """
    e = save(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "cc")
    before = (e.count(),)
    for _ in range(rounds):
        hub = max(HUB, before[0] // 1000)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("c"))
        large = with_least(both, least, hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = save(large.where("a <> b").distinct(), "cc")
        # now b < a in every edge: a's smaller neighbours
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c"))
        small = with_least(large, low, hub).select(F.col("b").alias("x"), "m").unionByName(low.select(F.col("a").alias("x"), "m"))
        last, e = e, save(small.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "cc")
        forget(last, large)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component"))
    ).distinct()
