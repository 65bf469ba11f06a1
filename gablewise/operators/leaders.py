"""Groups by their first leader: in order, each joins the first earlier leader that it is like, or leads itself.

A loop over all in order would be one task's work. Here candidate pairs come from a join, and who leads is settled in rounds: one leads once
none of those before it that it is like does, and follows once one of them does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.functions.text import alike_candidates, digits, name_key, similar_keys
from gablewise.sources.files import settled


def first_leaders(members: DataFrame, likes: DataFrame) -> DataFrame:
    """(key, leader) for members (key, ord), with likes (later, earlier): pairs of members that are alike, by their ords.

    Keys and ords are distinct. A round settles all that wait for nobody, so rounds are as many as the longest chain in which each waits for the one
    before; each writes who was settled, and reads only the pairs of those still open.
    """
    at = members.select("key", "ord")
    links = likes.join(at.select(F.col("key").alias("earlier"), F.col("ord").alias("place")), "earlier")
    links = settled(links.select("later", "earlier", "place"))
    free = at.join(links, F.col("key") == F.col("later"), "left_anti").select("key", F.col("key").alias("leader"))
    done = settled(free)
    while links.take(1):
        leads = done.select(F.col("key").alias("earlier"), (F.col("key") == F.col("leader")).alias("leads"))
        seen = links.join(leads, "earlier", "left").groupBy("later").agg(
            F.min(F.when(F.col("leads"), F.struct("place", "earlier"))).alias("first"),
            F.min(F.when(F.col("leads").isNull(), F.col("place"))).alias("open"),
        )
        # the first leader is known once nobody open stands before it
        sure = F.col("open").isNull() | (F.col("first.place") < F.col("open"))
        now = settled(seen.where(sure).select(F.col("later").alias("key"), F.coalesce("first.earlier", "later").alias("leader")))
        done = settled(done.unionByName(now))
        links = settled(links.join(now, F.col("later") == F.col("key"), "left_anti"))
    return done


def canonical_keys(names: DataFrame) -> DataFrame:
    """(key, canon) for the keys of street names (name, ord), in the order in which keys are first met; equal ords go by key.

    Names without letters or digits, and null ones, have no key. A key's canon is itself if it leads.
    """
    keys = names.select(name_key(F.col("name")).alias("key"), "ord").where("key <> ''").groupBy("key").agg(F.min("ord").alias("met"))
    keys = settled(keys.select("key", F.struct("met", "key").alias("ord")))
    pairs = alike_candidates(keys.select(F.col("key").alias("name")), F.col("name"), digits(F.col("name")))
    a, b = (keys.select(F.col("key").alias(n), F.col("ord").alias(f"ord_{n}")) for n in ("a", "b"))
    x = pairs.join(a, "a").join(b, "b")
    first = F.col("ord_a") < F.col("ord_b")
    x = x.select(F.when(first, F.col("b")).otherwise(F.col("a")).alias("later"), F.when(first, F.col("a")).otherwise(F.col("b")).alias("earlier"))
    found = first_leaders(keys, x.where(similar_keys(F.col("later"), F.col("earlier"))))
    return found.withColumnRenamed("leader", "canon")
