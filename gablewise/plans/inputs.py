"""Queries over what an audit takes in: footprints of several parts, and readings noted in codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import parts, readings
from gablewise.plans.registry import query
from gablewise.sources import bindings as B

S = Settings()
#: A building's parts: an L, a triangle that may be too small, and for some a slanted four-sided one, which may be the largest; as corners (x, y) from the middle.
PART_L = "struct({0} - 4.0e0 as x, {1} - 4.0e0 as y), struct({0} + 4.0e0 as x, {1} - 4.0e0 as y), struct({0} + 4.0e0 as x, {1} as y), struct({0} as x, {1} as y), struct({0} as x, {1} + 4.0e0 as y), struct({0} - 4.0e0 as x, {1} + 4.0e0 as y)"
PART_T = "struct({0} + 20.0e0 as x, {1} as y), struct({0} + 20.0e0 as x, {1} + 5.0e0 as y), struct({0} + 20.0e0 + p_size % 11 as x, {1} + 1.0e0 as y)"
PART_Q = "struct({0} as x, {1} + 30.0e0 as y), struct({0} + 3.0e0 + p_size % 9 as x, {1} + 31.0e0 as y), struct({0} + 4.0e0 + p_size % 9 as x, {1} + 36.0e0 as y), struct({0} + 1.0e0 as x, {1} + 35.0e0 as y)"
MIDDLE = ("(p_partkey % 40) * 60.0e0", "floor(p_partkey / 40.0e0) * 60.0e0")


def corners(text: str) -> str:
    return f"array({text.format(*MIDDLE)})"


def _sql(text: str) -> str:
    """The same corners for the SQL."""
    import re

    return "[" + re.sub(r"struct\((.*?) as x, (.*?) as y\)", r"struct_pack(x := \1, y := \2)", text.format(*MIDDLE)) + "]"


@query(f"""with b as (select p_partkey, concat('B', p_partkey) as building_id, p_partkey % 6 as kind, [{_sql(PART_L)}, {_sql(PART_T)}, {_sql(PART_Q)}] as parts from part),
p as (select p_partkey, building_id, k, parts[k] as r from b, (values (1), (2), (3)) v(k) where (kind > 0 or k = 1) and (kind > 2 or k < 3)),
a as (select *, abs(list_sum(list_transform(range(1, len(r) + 1), lambda i: r[i].x * r[i % len(r) + 1].y - r[i % len(r) + 1].x * r[i].y))) / 2 as area from p),
n as (select *, row_number() over (partition by p_partkey order by round_even(area, 6) desc, k) as nth from a), m as (select * from n where nth = 1 or area >= 15),
o as (select *, row_number() over (partition by p_partkey order by nth) as part, count(*) over (partition by p_partkey) as n_parts from m)
select case when n_parts = 1 then building_id else concat(building_id, '_p', part) end as unit_id, building_id, part::int as part, n_parts::int as n_parts, round_even(area, 4) as area, len(r)::int as n_corners from o""")
def units_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of footprints of up to three parts of different form."""
    p = B.table(spark, sf_dir, "part")
    every = F.array(*[F.expr(corners(t)) for t in (PART_L, PART_T, PART_Q)])
    kept = F.slice(every, F.lit(1), F.when(F.col("p_partkey") % 6 == 0, 1).when(F.col("p_partkey") % 6 <= 2, 2).otherwise(3))
    b = p.select(F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("building_id"), F.col("p_name").alias("road"), F.col("p_type").alias("usage"), F.col("p_size").alias("storeys"), kept.alias("parts"))
    return parts.load_units(b, S).select("unit_id", "building_id", "part", "n_parts", F.bround("area", 4).alias("area"), F.size("ring").alias("n_corners"))


VIS = "case l_returnflag when 'A' then 'c' when 'N' then 'p' else 'h' end"
SAME = "case when l_linenumber = 1 then 'r' when l_linestatus = 'O' then 'y' when l_suppkey % 3 = 0 then '?' else 'n' end"
BETWEEN = "case when l_suppkey % 29 = 5 then 'x' when l_suppkey % 7 = 0 then 'n2' when l_partkey % 11 = 0 then 'np' else 'y' end"
HIDDEN_BY = "case when l_returnflag = 'R' and l_partkey % 2 = 0 then 'tree' end"
NTH = f"row_number() over ({B.VIEW_ORDER})"


@query(f"""with l as (select l_orderkey as unit_key, {NTH} as nth, {VIS} as vis, {SAME} as same, {BETWEEN} as btw, {HIDDEN_BY} as hid from lineitem),
g as (select unit_key, count(*) as n, count(*) filter (btw = 'x') as bad, count(*) filter (same = 'r') as refs, count(*) filter (vis <> 'h') as seen, min(nth) filter (same = 'r') as ref, min(vis) filter (same = 'r') as ref_vis,
 string_agg(coalesce(hid, case when vis <> 'h' then 'nothing' else 'other' end), ', ' order by nth) as hidden_by, coalesce(string_agg(nth, ',' order by nth) filter (same in ('r', 'y')), '') as based_on from l group by unit_key),
p as (select g.*, case when o_orderkey is not null then n + case when o_orderkey % 10 = 7 then 1 else 0 end end as planned from g left join (select o_orderkey from orders where o_orderkey % 25 <> 3) on o_orderkey = unit_key)
select unit_key, case when planned is null then 'not planned' when bad > 0 then 'unknown code' when n <> planned then concat(n, ' views in the note, ', planned, ' planned') when seen > 0 and refs <> 1 then concat(refs, ' reference views') when seen > 0 and ref_vis = 'h' then 'the reference view is hidden' end as reason,
 case when seen > 0 then ref end::int as reference_view, hidden_by, based_on from p""")
def readings_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from notes in codes, against the views that were planned: valid ones, and the others with what is wrong."""
    l = B.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as unit_key", f"{NTH} as nth", f"struct({VIS} as vis, {SAME} as same, {BETWEEN} as between, '' as what, {HIDDEN_BY} as hidden_by, cast(null as array<string>) as boards) as v")  # noqa: E741
    notes = l.groupBy("unit_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "v"))), lambda x: x.v).alias("v"))
    planned = notes.join(B.table(spark, sf_dir, "orders").where("o_orderkey % 25 <> 3").select(F.col("o_orderkey").alias("unit_key")), "unit_key")
    planned = planned.select("unit_key", (F.size("v") + F.when(F.col("unit_key") % 10 == 7, 1).otherwise(0)).alias("n_views"))
    x = readings.validated(notes, planned, "unit_key")
    joined = lambda c, sep: F.array_join(c, sep)
    return x.select("unit_key", "reason", "reference_view", joined(F.col("views.hidden_by"), ", ").alias("hidden_by"), joined(F.transform("based_on", lambda n: n.cast("string")), ",").alias("based_on"))
