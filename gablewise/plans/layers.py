"""Queries that make layers: buildings as features, links side by side, readings from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.functions import geo
from gablewise.functions.text import floors_text
from gablewise.model import Settings
from gablewise.operators import selection, sight
from gablewise.operators.grid import points_within
from gablewise.plans.registry import query
from gablewise.plans.spatial import SIGHT_SQL, views_of
from gablewise.sources import bindings as B
from gablewise.sources.files import parse_answer, rectangle, to_feature

S = Settings()


@query(f"{B.with_views('units')} select unit_id, to_json({{'type': 'Feature', 'properties': {{'unit_id': unit_id, 'usage': usage, 'storeys': storeys}}, 'geometry': {{'type': 'Polygon', 'coordinates': [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}}}})::varchar as feature from units")
def unit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = B.units(spark, sf_dir)
    return u.select("unit_id", to_feature(rectangle(*sight.RECT), ["unit_id", "usage", "storeys"]).alias("feature"))


@query()
def link_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four links a unit, side by side."""
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.link_dist)
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    one = F.struct(F.bround("dist", 6).alias("dist"), F.col("pano_ord").alias("ord"), geo.bearing(cx, cy, "px", "py").alias("side"), "pano_id", "pano_date")
    lists = x.groupBy("unit_id").agg(selection.spread(F.array_sort(F.collect_list(one)), S.max_links, S.link_sector).alias("c"))
    lists = lists.select("unit_id", F.explode(F.array("c")).alias("c"))  # made once a row: a generator keeps it from being made anew at each use
    text = lambda k: F.format_string("%d m, from %s, %s", F.rint(k.dist).cast("int"), geo.compass(k.side), k.pano_date)
    cells = {}
    for i in range(S.max_links):
        k = F.get("c", F.lit(i))
        cells |= {f"link{i + 1}": k.pano_id, f"link{i + 1}_text": F.when(k.isNotNull(), text(k))}
    return lists.select("unit_id", *[v.alias(n) for n, v in cells.items()])


RESPONSE = "case when o_orderkey % 5 = 0 then '{broken' when o_orderkey % 5 = 1 then '{\"views\": []}' else concat(case when o_orderkey % 5 = 2 then '[' else '' end, '{\"classification\": {\"floors_above_ground\": ', o_orderkey % 4, ', \"building_usage\": \"Mixed\"}}', case when o_orderkey % 5 = 2 then ']' else '' end) end"


@query("select o_orderkey as unit_key, case when o_orderkey % 5 > 1 then case when o_orderkey % 4 = 0 then 'G' else concat('G+', o_orderkey % 4) end end as floors, case when o_orderkey % 5 > 1 then 'Mixed' end as usage from orders")
def answers_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from the text of a model's response."""
    x = B.table(spark, sf_dir, "orders").selectExpr("o_orderkey as unit_key", f"{RESPONSE} as text")
    x = x.select("unit_key", parse_answer(F.col("text")).alias("a"))
    return x.select("unit_key", floors_text(F.col("a.classification.floors_above_ground")).alias("floors"), F.col("a.classification.building_usage").alias("usage"))


@query(f"{SIGHT_SQL}, k as (select unit_id, pano_id, count(*) filter (visible) as v from s group by all) select unit_id, count(*) as n_panos, count(*) filter (v > 0) as n_seeing, sum(v)::bigint as points_seen from k group by unit_id")
def sight_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each unit all panoramas within reach see."""
    k = views_of(spark, sf_dir, True).select("unit_id", F.size(F.filter("visible", lambda v: v)).alias("v"))
    return k.groupBy("unit_id").agg(F.count("*").alias("n_panos"), F.count_if(F.col("v") > 0).alias("n_seeing"), F.sum("v").alias("points_seen"))
