"""Results of earlier runs and of people: upserts, invalidation, carry-over, latest answers, and as-of matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows, and the old ones whose key isn't among them."""
    return new.unionByName(old.join(new.select(*key).distinct(), list(key), "left_anti"))


def still_valid(kept: DataFrame, current: DataFrame, key: Sequence[str], stamp: str) -> DataFrame:
    """Kept results whose stamp is the current one of their key: others count as not asked."""
    return kept.join(current.select(*key, stamp), [*key, stamp], "left_semi")


def last_by(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key."""
    w = W.partitionBy(*key).orderBy(*[c.desc() if isinstance(c, Column) else F.desc(c) for c in order])
    return df.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def carry_over(rows: DataFrame, edits: DataFrame, key: Sequence[str], fields: Sequence[str], priority: str) -> DataFrame:
    """Adds the fields that people filled in: of a key's edits the last by priority; blank counts as missing.

    An edit with all fields missing is none, so an earlier one with some stays.
    """
    blank = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c))
    e = edits.select(*key, priority, *[blank(c).alias(c) for c in fields]).where(F.coalesce(*[F.col(c) for c in fields]).isNotNull())
    return rows.join(last_by(e, key, [priority]).drop(priority), list(key), "left")


def accepted(answers: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The answers that an import takes: not of another run (other_run), and of known keys."""
    return answers.where(~F.col("other_run")).drop("other_run").join(known.select(key).distinct(), key, "left_semi")


def latest_answers(answers: DataFrame, key: str, at: str, order: str, reviewer: str, same: Sequence[str]) -> DataFrame:
    """The last answer of each key, with a note where it differs from another reviewer's answer just before it.

    Answers go by time, then by their order in the file. Only the last one's note stays.
    """
    w = W.partitionBy(key).orderBy(at, order)
    before = {c: F.lag(c).over(w) for c in (reviewer, *same)}
    differs = F.lit(False)
    for c in same:
        differs = differs | ~before[c].eqNullSafe(F.col(c))
    other = before[reviewer].isNotNull() & (before[reviewer] != F.col(reviewer)) & differs
    told = F.concat_ws(", ", *[F.coalesce(before[c].cast("string"), F.lit("-")) for c in same])
    x = answers.withColumns({"disagrees": other, "note": F.when(other, F.concat(F.lit("earlier answer by "), before[reviewer], F.lit(": "), told)), "n_answers": F.count("*").over(W.partitionBy(key)), "nth": F.row_number().over(w)})
    return x.where(F.col("nth") == F.col("n_answers")).drop("nth")


def as_of(events: DataFrame, marks: DataFrame, time: str, tag: str, least_s: float, most_s: float, slice_s: int) -> DataFrame:
    """For each event the last mark at its time or before, and why it can't be taken: too soon, too long, before first.

    Marks and events are cut into slices of time; each slice starts with the last mark of an earlier slice, so the search is
    spread over slices rather than one window over all rows. Marks at one time: the last in the order of their tag counts.
    """
    events, marks = (x.withColumn(time, F.col(time).cast("timestamp")) for x in (events, marks))
    cut = F.floor(F.unix_micros(time) / (slice_s * 1_000_000))
    m = marks.select(F.col(time).alias("mark_time"), F.col(tag).alias("mark"), cut.alias("slice"))
    lasts = m.groupBy("slice").agg(F.max(F.struct("mark_time", "mark")).alias("end"))
    # slices are few: one row for each slice of time
    slices = lasts.select("slice", "end").unionByName(events.select(cut.alias("slice"), F.lit(None).cast(lasts.schema["end"].dataType).alias("end")).distinct())
    slices = slices.groupBy("slice").agg(F.max("end").alias("end"))
    slices = slices.select("slice", F.last("end", True).over(W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)).alias("earlier"))
    both = events.select("*", cut.alias("slice"), F.lit(None).cast("struct<mark_time:timestamp,mark:" + dict(marks.dtypes)[tag] + ">").alias("m"), F.lit(1).alias("kind"), F.col(time).alias("t")).unionByName(
        m.select("slice", F.struct("mark_time", "mark").alias("m"), F.lit(0).alias("kind"), F.col("mark_time").alias("t")), allowMissingColumns=True
    )
    w = W.partitionBy("slice").orderBy("t", "kind", F.col("m.mark"))
    found = both.withColumn("found", F.last("m", True).over(w)).where("kind = 1").join(slices, "slice", "left")
    found = found.withColumn("found", F.coalesce("found", "earlier"))
    gap = (F.unix_micros(time) - F.unix_micros("found.mark_time")) / 1e6
    why = F.when(F.col("found").isNull(), "before first").when(gap < least_s, "too soon").when(gap > most_s, "too long").otherwise("ok")
    return found.select(*events.columns, F.when(why == "ok", F.col("found.mark")).alias("mark"), why.alias("reason"))


def reusable(now: DataFrame, before: DataFrame, place: Sequence[str], same: Sequence[str], name: str) -> DataFrame:
    """Adds whether the row of an earlier plan at the same place is the same in all that matters."""
    old = before.select(*place, *[F.col(c).alias(f"{c}_before") for c in same])
    x, alike = now.join(old, list(place), "left"), F.lit(True)
    for c in same:
        alike = alike & (F.col(c) == F.col(f"{c}_before"))
    return x.withColumn(name, F.coalesce(alike, F.lit(False))).drop(*[f"{c}_before" for c in same])


def rekey(answers: DataFrame, requests: DataFrame, key: Sequence[str]) -> DataFrame:
    """Kept answers (key..., key) with the fresh key of their request (key..., fresh, legacy) if they have one of its legacy keys."""
    x, saved = answers.join(requests, list(key), "left"), F.col("key")
    old = F.array_contains("legacy", saved)
    state = F.when(F.col("fresh").isNull(), "no images").when(saved == F.col("fresh"), "already new").when(old, "re-keyed").otherwise("images changed, left alone")
    return x.select(*key, state.alias("state"), F.when(old, F.col("fresh")).otherwise(saved).alias("key"))


def import_counts(answers: DataFrame, known: DataFrame, key: str, at: str, order: str, reviewer: str, same: Sequence[str]) -> DataFrame:
    """One row of counts of an import: answers of another run (other_run) are rejected, those on unknown keys skipped.

    A disagreement is an answer that differs from the one just before it on the same key, by another reviewer.
    """
    x = answers.join(known.select(key).distinct().withColumn("known", F.lit(True)), key, "left")
    taken = ~F.col("other_run") & F.col("known").isNotNull()
    w = W.partitionBy(key, F.when(taken, 1).otherwise(0)).orderBy(at, order)
    differs = F.lit(False)
    for c in same:
        differs = differs | ~F.lag(c).over(w).eqNullSafe(F.col(c))
    x = x.withColumns({"taken": taken, "first": F.row_number().over(w) == 1, "other": ~F.lag(reviewer).over(w).eqNullSafe(F.col(reviewer)) & differs})
    n = F.count_if
    return x.agg(
        n("other_run").alias("rejected"), n(~F.col("other_run") & F.col("known").isNull()).alias("unknown_buildings"), n("taken").alias("answers"),
        n(F.col("taken") & F.col("first")).alias("unique_buildings"), n(F.col("taken") & ~F.col("first") & F.col("other")).alias("disagreements"),
    )
