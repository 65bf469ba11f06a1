"""Mixing sources to target weights, with DataFrame functions only.

Each document gets a random key by hash. Within a source the documents stand in the order of their keys; the mix takes whole
epochs of a source and then the documents up to the place where the source's budget ends. That place is found with prefix
sums in two levels: sums by key range, then the documents of the one range in which the budget ends. So the texts are never
shuffled, and no task gets a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, packed, save

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, get the weights in turn. A target is its weight times one level, or `most` times the
    source's size if that is less; the level is the one at which the targets add up to `share` of all sizes. With the sources
    in the order of their limits over their weights, that level is the largest of those that take all sources before as full.
    The windows run over one row a source.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1))
    s = s.withColumn("most", F.col("source_size") * F.lit(most))
    by = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(W.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("w").over(
        by.rowsBetween(0, W.unboundedFollowing)
    )
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(W.partitionBy()))
    return s.select("source", "source_size", F.least(F.col("most").cast("double"), F.col("w") * F.col("level")).alias("target"))


def mixing_plan(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, digits: int = 3) -> DataFrame:
    """One row a source from a saved (source, key, size): its target, whole epochs, and the place of the cut.

    Rows alike in key and size share what the cut leaves of them evenly, rounded down.
    """
    t = source_targets(sizes, weights, share, most)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    t = save(t.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "mix-targets")
    small = broadcast_if_small(t.select(F.col("source").alias("s"), "rest"))

    ranges = sizes.withColumn("range", F.substring("key", 1, digits)).groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    ranges = ranges.withColumn("upto", F.sum("in_range").over(W.partitionBy("source").orderBy("range")))
    ends = ranges.join(small, F.col("source").eqNullSafe(F.col("s"))).where("rest > 0 AND upto >= rest AND upto - in_range < rest")
    ends = save(ends.select("s", "range", (F.col("rest") - F.col("upto") + F.col("in_range")).alias("need")), "mix-ends")

    near = sizes.join(broadcast_if_small(ends), F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, digits) == F.col("range")))
    near = near.where("size > 0").groupBy("s", "key", "size", "need").agg(F.count("*").alias("alike"))
    near = near.withColumn("upto", F.sum(F.col("alike") * F.col("size")).over(W.partitionBy("s").orderBy("key", "size")))
    start = F.col("upto") - F.col("alike") * F.col("size")
    cut = near.where((F.col("upto") >= F.col("need")) & (start < F.col("need"))).select(
        F.col("s"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"), F.floor((F.col("need") - start) / F.col("alike")).cast("long").alias("cut_words")
    )
    return save(t.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest"), "mix-plan")


def apply_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds source_size, target and taken to rows that have source, key and size."""
    p = broadcast_if_small(plan.withColumnRenamed("source", "s"))
    j = sized.join(p, F.col("source").eqNullSafe(F.col("s")), "left")
    place, cut = F.struct("key", "size"), F.struct(F.col("cut_key").alias("key"), F.col("cut_size").alias("size"))
    part = F.when(F.col("cut_key").isNull(), 0).when(place < cut, F.col("size")).when(place == cut, F.col("cut_words")).otherwise(0)
    return j.withColumn("taken", (F.col("size") * F.col("epochs") + part).cast("long")).drop("s", "epochs", "cut_key", "cut_size", "cut_words")


def mix_decisions(docs: DataFrame, seed: str = "mix", **plan_options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs (doc_id, source, text).

    Size is the number of words; a null text has none, and the mix takes none of it. A null doc_id has a key too; a null
    source is a source. Rows alike in every respect get the same result. No rows give no rows; other columns play no part.
    """
    sized = save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed).alias("key")), "mix-sizes")
    return apply_plan(sized, mixing_plan(sized, **plan_options)).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, seed: str = "mix", **plan_options) -> DataFrame:
    """The mixed corpus: docs' own columns, each row as many times as the mix takes it.

    Documents go in whole: the one at a source's cut goes in if at least half of its words do.
    """
    key, size = random_key(F.col("doc_id"), seed).alias("key"), word_count(F.col("text")).alias("size")
    plan = mixing_plan(save(docs.select("source", key, size), "mix-sizes"), **plan_options)
    rows = apply_plan(docs.select(packed(docs), "source", key, size), plan)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    rows = rows.withColumn("times", times).where("times > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
    return rows.select("row.*")
