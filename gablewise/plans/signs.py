"""Queries over the text of signs, on lines built from the tables' names and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions import signs
from gablewise.functions.text import alike_candidates
from gablewise.operators import names
from gablewise.operators.grid import parts
from gablewise.plans.registry import query
from gablewise.sources import bindings as B

LINES = """array(
    case p_partkey % 5 when 0 then 'COIMBATORE CITY MUNICIPAL CORPORATION' when 1 then 'Google Street View' else concat(upper(p_name), ' stores') end,
    concat(case when p_partkey % 4 = 0 then 'GST No: 33' else 'No. ' end, p_size, '/', p_partkey % 90, ', ', p_name, case when p_partkey % 2 = 0 then ' Main Rd' else ' st 2' end),
    case when p_partkey % 3 = 0 then concat('641', lpad(cast(p_partkey % 1000 as string), 3, '0')) else ' ' end)"""


def sign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name", f"{LINES} as lines")


@query()
def sign_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each sign says: its kind, doors, pin codes, shops, up to three roads, and the viewer's own address line."""
    return extracted(sign_rows(spark, sf_dir).withColumn("panel", F.array(F.lit("Image capture: Feb 2026"), F.concat(F.col("p_name"), F.lit(" Rd")))), "p_partkey")


def extracted(s: DataFrame, key: str) -> DataFrame:
    """(key, kind, doors, pins, shops, road, roads, google_address, text) of signs (key, lines, panel)."""
    lines, text = F.col("lines"), signs.sign_text(F.col("lines"))
    joined = lambda c: F.array_join(c, "; ")
    x = s.withColumn("names", signs.road_names(lines))
    return x.select(
        key, signs.sign_kind(lines).alias("kind"), joined(signs.doors(text)).alias("doors"), joined(signs.pins(text)).alias("pins"), joined(signs.shop_lines(lines)).alias("shops"),
        F.get("names", F.lit(0)).alias("road"), joined("names").alias("roads"), signs.viewer_address(F.col("panel")).alias("google_address"), F.substring(text, 1, 400).alias("text"),
    )


@query()
def sign_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinary documents have no signs: how many lines are taken for one, by kind."""
    d = B.table(spark, sf_dir, "documents").select(F.split("text", "\n").alias("lines"))
    return d.groupBy(signs.sign_kind(F.col("lines")).alias("kind")).agg(F.count("*").alias("n"))


def road_pairs(roads: DataFrame) -> DataFrame:
    """(a, b): pairs of different names (name) that mean one road; only those with letters enough in common are compared."""
    low = F.lower(F.col("name"))
    pairs = alike_candidates(roads, signs.road_letters(low), F.coalesce(signs.street_number(low), F.lit("")))
    return pairs.where(signs.same_road(F.col("a"), F.col("b")))


@query()
def same_road_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of roads that mean one."""
    r = B.units(spark, sf_dir).select(signs.normal_name(F.col("road")).alias("name"), "ord")
    odd = F.when(F.col("ord") % 40 == 0, F.concat(F.col("name"), F.lit("e"))).otherwise(F.col("name"))
    return road_pairs(r.select(odd.alias("name")))


@query()
def decide_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sign_rows(spark, sf_dir)
    lines = F.col("lines")
    read = s.repartition(parts(s, 5_000), "p_partkey")  # many patterns for each of the rows, of which a file has a lot
    e = read.select((F.col("p_partkey") % 61).alias("stretch"), F.col("p_partkey").alias("ord"), F.get(signs.raw_roads(lines), F.lit(0)).alias("name"), signs.sign_kind(lines).alias("kind"), (F.col("p_partkey") % 7).cast("string").alias("unit_id"), (F.col("p_partkey") % 30).cast("double").alias("dist_m"))
    c = s.groupBy((F.col("p_partkey") % 61).alias("stretch")).agg(F.min("p_name").alias("candidate"))
    c = c.select("stretch", F.when(F.col("stretch") % 3 != 0, F.concat("candidate", F.lit(" Main Road"))).alias("candidate"))
    return names.decide_names(e, c, "stretch")


BOXES = "select event_id, user_id, event_type as word, value % 600 as y, (event_id * 37) % 500 as x, event_id % 5 = 0 as panel from events where value is not null"


@query(f"""with b as (select *, round_even(y / 15, 0)::int as line from ({BOXES})), o as (select *, lag(line) over w as l0, lag(panel) over w as p0 from b window w as (partition by user_id order by line, x, event_id)),
g as (select *, sum((l0 is distinct from line or p0 is distinct from panel)::int) over (partition by user_id order by line, x, event_id) as grp from o)
select user_id, grp::bigint as nth, panel, string_agg(word, ' ' order by x, event_id) as text from g group by all""")
def ocr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with their boxes to lines: a new line where the height or the panel changes."""
    b = B.table(spark, sf_dir, "events").where("value is not null").selectExpr("event_id", "user_id", "event_type as word", "value % 600 as y", "(event_id * 37) % 500 as x", "event_id % 5 = 0 as panel")
    b = b.withColumn("line", F.rint(F.col("y") / 15).cast("int"))
    w = W.partitionBy("user_id").orderBy("line", "x", "event_id")
    new = ~F.lag("line").over(w).eqNullSafe(F.col("line")) | ~F.lag("panel").over(w).eqNullSafe(F.col("panel"))
    b = b.withColumn("new", new.cast("int")).withColumn("nth", F.sum("new").over(w))
    one = F.array_sort(F.collect_list(F.struct("x", "event_id", "word")))
    return b.groupBy("user_id", "nth", "panel").agg(F.array_join(F.transform(one, lambda s: s.word), " ").alias("text"))
