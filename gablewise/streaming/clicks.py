"""Matching captures to clicks as both arrive, with Structured Streaming.

A capture waits for no later clicks than its own time, so both streams are joined within the longest gap allowed; the state
for a click is dropped once the watermark has passed it by that gap. Of the clicks that fit, the last is chosen per capture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.model import Settings


def candidate_matches(captures: DataFrame, clicks: DataFrame, s: Settings, delay: str = "10 minutes") -> DataFrame:
    """(event_id, ts, click_ts, user_id): clicks at most the longest gap before each capture. Append mode."""
    shots = captures.select("event_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay)
    marks = clicks.select(F.col("ts").cast("timestamp").alias("click_ts"), "user_id").withWatermark("click_ts", delay)
    within = F.expr(f"click_ts <= ts AND click_ts >= ts - INTERVAL {s.click_max_s} SECONDS")
    # an equality spreads both sides: a capture meets the clicks of its own stretch of time and of the one before
    width = s.click_max_s
    a = shots.withColumn("slot", F.explode(F.array(F.floor(F.unix_seconds("ts") / width), F.floor(F.unix_seconds("ts") / width) - 1)))
    b = marks.withColumn("slot", F.floor(F.unix_seconds("click_ts") / width))
    return a.join(b, (a.slot == b.slot) & within).select("event_id", "ts", "click_ts", "user_id")


def last_click(matches: DataFrame, s: Settings) -> DataFrame:
    """(event_id, mark): the last click of each capture that isn't too close to it."""
    best = matches.groupBy("event_id").agg(F.max(F.struct("click_ts", "user_id")).alias("c"), F.max("ts").alias("ts"))
    return best.where((F.unix_micros("ts") - F.unix_micros("c.click_ts")) / 1e6 >= s.click_min_s).select("event_id", F.col("c.user_id").alias("mark"))
