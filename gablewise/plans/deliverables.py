"""Queries for what is handed over, and for the checks on what comes in: rows of buildings and streets, corrections, links with
and without sight, assignments, validated readings, parsed clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions.geo import bearing
from gablewise.functions.text import floors_text, name_key, norm_unit
from gablewise.model import TRADE_USAGES, VISIBLE, Settings
from gablewise.operators import looks, rules, selection, sight
from gablewise.operators.grid import boxes_within, nearest, points_within
from gablewise.plans import streets as street_plans
from gablewise.plans.records import KEY_SQL, KEYS_SQL, cut_sql, main_value
from gablewise.plans.registry import query
from gablewise.plans.spatial import GRID_SQL, cameras, grid_points, pairs_sql, views_of
from gablewise.plans.streets import CUTS_SQL
from gablewise.plans.verdicts import CASE_SQL, FLAGS_SQL, PLACED, PLACED_WHY, SUM_SQL, VS_SQL, building_counts, cases, columns, flagged, judged, street_rows
from gablewise.sources import bindings as B

S = Settings()


@query(f"{B.with_views('lanes')}, {CUTS_SQL}, c as (select *, {cut_sql('road_name')} as s from si) select stretch_id from c where road_fid = 100001 or replace({KEY_SQL}, 'dh', 'th') = 'lane2' or stretch_id in (select min(stretch_id) from si)")
def select_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches that any of three selectors takes: a road, a name in any spelling, an id."""
    s = street_plans.stretches(spark, sf_dir)
    one = s.agg(F.min("stretch_id")).scalar()
    return s.where((F.col("road_fid") == 100001) | (name_key(F.col("road_name")) == "lane2") | (F.col("stretch_id") == one)).select("stretch_id")


@query(f"""{B.with_views('answer_views')}, g as (select unit_key, count(*) as n_views, count(*) filter (same_as_ref = 'this is the reference view') as n_ref,
 count(*) filter (target_visible not in ('clear', 'partly hidden', 'hidden') or between_marks not like 'yes%' and between_marks not like 'no%') as n_bad, count(*) filter (target_visible <> 'hidden') as n_seen from answer_views group by unit_key)
select unit_key, case when n_bad > 0 then 'unknown word' when n_ref > 1 then 'two references' when n_ref = 0 and n_seen > 0 then 'no reference' else 'valid' end as state from g""")
def readings_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that follow the rules: known words only, and one reference view unless all are hidden."""
    n, ref = F.count_if, F.col("same_as_ref") == "this is the reference view"
    known = F.col("target_visible").isin(*VISIBLE, "hidden") & (F.col("between_marks").startswith("yes") | F.col("between_marks").startswith("no"))
    g = B.answer_views(spark, sf_dir).groupBy("unit_key").agg(n(ref).alias("refs"), n(~known).alias("bad"), n(F.col("target_visible") != "hidden").alias("seen"))
    state = F.when(F.col("bad") > 0, "unknown word").when(F.col("refs") > 1, "two references").when((F.col("refs") == 0) & (F.col("seen") > 0), "no reference").otherwise("valid")
    return g.select("unit_key", state.alias("state"))


@query(f"{B.with_views('units', 'panos')}, {pairs_sql(30)}, z as (select unit_id, pano_id, dist < 4 as close, row_number() over (partition by unit_id order by dist < 4, round_even(dist, 6), pano_ord) as nth from pairs) select unit_id, pano_id, close from z where nth = 1")
def zoom_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panorama for a closer look: the nearest of those 4 m away at least, else the nearest."""
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.max_view_dist).withColumn("close", F.col("dist") < 4)
    return nearest(x, ["unit_id"], ["close", F.bround("dist", 6), "pano_ord"]).select("unit_id", "pano_id", "close")


@query(f"{B.with_views('units')} select unit_id, (x0 + x1) / 2 - 45 as west, (y0 + y1) / 2 - 45 as south, (x0 + x1) / 2 + 45 as east, (y0 + y1) / 2 + 45 as north, cast(least(1400, greatest(700, round_even((greatest(x1 - x0, y1 - y0) + 50) * 12, 0))) as int) as px from units")
def chip_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows to cut from an aerial picture around each unit, and their size in pixels."""
    u, cx, cy = B.units(spark, sf_dir), (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 50
    px = F.least(F.lit(1400), F.greatest(F.lit(700), F.rint(side * 12))).cast("int")
    return u.select("unit_id", (cx - 45).alias("west"), (cy - 45).alias("south"), (cx + 45).alias("east"), (cy + 45).alias("north"), px.alias("px"))


@query("""with m as (select l_orderkey as unit_key, l_linenumber - 1 as floor, max(l_linenumber * 1e9 + l_partkey * 1e3 + l_suppkey) as last from lineitem group by 1, 2),
u as (select distinct m.unit_key, m.floor, case when l_returnflag = 'N' then 'Commercial' when l_returnflag = 'A' then 'cannot tell' end as usage from m join lineitem on l_orderkey = m.unit_key and l_linenumber - 1 = m.floor and l_linenumber * 1e9 + l_partkey * 1e3 + l_suppkey = m.last)
select o_orderkey as unit_key, coalesce(o_orderkey % 4 >= 1 and exists (select 1 from range(1, 4) r(n) where n <= o_orderkey % 4 and not exists (select 1 from u where u.unit_key = o_orderkey and u.floor = n and u.usage = 'Commercial')), false) as unseen from orders""")
def upper_floors_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the use of any upper floor unknown? Of several entries for a floor the last counts."""
    order = "l_linenumber * 1e9 + l_partkey * 1e3 + l_suppkey"
    line = B.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as unit_key", "l_linenumber - 1 as floor", "case when l_returnflag = 'N' then 'Commercial' when l_returnflag = 'A' then 'cannot tell' end as usage", f"{order} as o")
    last = line.groupBy("unit_key", "floor").agg(F.max_by(F.struct("usage"), "o").alias("u"))
    known = last.where("u.usage is not null and u.usage <> 'cannot tell'").groupBy("unit_key").agg(F.collect_set("floor").alias("floors"))
    x = B.table(spark, sf_dir, "orders").selectExpr("o_orderkey as unit_key", "o_orderkey % 4 as n").join(known, "unit_key", "left")
    # sequence(1, 0) would count down
    missing = F.exists(F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), "n")), lambda f: ~F.coalesce(F.array_contains("floors", f.cast("int")), F.lit(False)))
    return x.select("unit_key", ((F.col("n") >= 1) & missing).alias("unseen"))


@query(f"{CASE_SQL} select unit_key, {PLACED} as verdict, {PLACED_WHY} as reason from y")
def viewer_placed_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each reading would prove if a person had placed its camera."""
    x = cases(spark, sf_dir)
    said, why = rules.viewer_placed_verdict(columns(x))
    return x.select("unit_key", said.alias("verdict"), why.alias("reason"))


@query(f"""{B.with_views('answer_views')}, r as (select unit_key, list(number_read order by view) filter (number_read is not null) as a from answer_views group by unit_key), o as (select l_orderkey as unit_key, list(distinct concat(l_linenumber, '-', cast(l_quantity as int))) as b from lineitem group by 1)
select unit_key, array_to_string(list_concat(coalesce(a, []), list_sort(list_filter(coalesce(b, []), lambda d: not list_contains(coalesce(a, []), d)))), ', ') as numbers from r left join o using (unit_key)""")
def sign_doors_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a reading, and after them those read off all lines' signs that it lacks."""
    return sign_doors(spark, sf_dir)


@query()
def sign_doors_merged_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under its earlier name."""
    return sign_doors_merged(spark, sf_dir)


def sign_doors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(unit_key, numbers): only where there is a reading."""
    v = B.answer_views(spark, sf_dir)
    a = v.groupBy("unit_key").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("number_read").isNotNull(), F.struct("view", "number_read")))), lambda s: s.number_read).alias("a"))
    o = B.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as unit_key", "concat(l_linenumber, '-', cast(l_quantity as int)) as d")
    o = o.groupBy("unit_key").agg(F.array_sort(F.collect_set("d")).alias("b"))
    none = F.expr("cast(array() as array<string>)")
    x = a.join(o, "unit_key", "left").withColumn("b", F.coalesce("b", none))
    return x.select("unit_key", F.array_join(F.concat("a", F.filter("b", lambda d: ~F.array_contains("a", d))), ", ").alias("numbers"))


@query()
def link_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four links a unit: panoramas that see it first, on different sides, then the nearest others, spread likewise."""
    u, p = B.units(spark, sf_dir), B.panos(spark, sf_dir)
    x = points_within(u, p, S.link_dist)
    seen = looks.candidates(views_of(spark, sf_dir), S).select("unit_id", "pano_id", "dist_near")
    x = x.join(seen, ["unit_id", "pano_id"], "left")
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    one = F.struct(F.col("dist_near").isNull().alias("blind"), F.bround(F.coalesce("dist_near", "dist"), 6).alias("dist"), F.col("pano_ord").alias("ord"), bearing(cx, cy, "px", "py").alias("side"), "pano_id")
    lists = x.groupBy("unit_id").agg(F.array_sort(F.collect_list(one)).alias("c"))
    first = selection.spread(F.filter("c", lambda k: ~k.blind), S.max_links, S.link_sector)
    rest = F.filter("c", lambda k: k.blind)
    # both kinds are spread over the sides of the building
    lists = lists.withColumns({"s": first, "r": selection.spread(rest, S.max_links, S.link_sector)})
    lists = lists.select("unit_id", F.concat("s", F.slice("r", 1, S.max_links - F.size("s"))).alias("s"))  # fewer are the first of more
    return lists.select("unit_id", F.posexplode("s").alias("at", "k")).select("unit_id", (F.col("at") + 1).alias("n"), "k.pano_id", (~F.col("k.blind")).alias("los"))


@query(f"""{B.with_views('units', 'lanes')}, {CUTS_SQL}, {KEYS_SQL}, d as (select unit_id, stretch_id, road_fid, sqrt(power(greatest(least(s.x0, s.x1) - u.x1, 0, u.x0 - greatest(s.x0, s.x1)), 2) + power(greatest(least(s.y0, s.y1) - u.y1, 0, u.y0 - greatest(s.y0, s.y1)), 2)) as dist from units u, si s),
w as (select d.*, key, row_number() over (partition by unit_id order by dist, stretch_id) as nth from d join units using (unit_id) join k using (road, ord) where dist <= 30), c as (select stretch_id, key, count(*) as n, min(unit_id) as first from w where nth = 1 group by all),
nm as (select stretch_id, key as name from (select *, row_number() over (partition by stretch_id order by n desc, first, key) as nth from c) where nth = 1),
h as (select w.unit_id, w.stretch_id, w.dist, w.nth, coalesce(w.key = nm.name, false) as same from w left join nm using (stretch_id)), pick as (select unit_id, stretch_id, row_number() over (partition by unit_id order by case when nth = 1 and same then 0 when same then 1 else 2 end, nth) as p, same, nth from h)
select unit_id, stretch_id, nth > 1 as moved from pick where p = 1""")
def units_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units on stretches in two passes: by distance, which names the stretches; then corner houses go to the nearest stretch in reach of their own name."""
    u = B.units(spark, sf_dir).withColumn("key", name_key(F.col("road")))
    s = street_plans.stretches(spark, sf_dir).select("stretch_id", F.least("x0", "x1").alias("r0"), F.least("y0", "y1").alias("s0"), F.greatest("x0", "x1").alias("r1"), F.greatest("y0", "y1").alias("s1"))
    x = boxes_within(u, s, S.back_lot_reach, sight.RECT, ("r0", "s0", "r1", "s1"), 60.0).select("unit_id", "key", "stretch_id", "dist")
    x = x.withColumn("order", F.row_number().over(W.partitionBy("unit_id").orderBy("dist", "stretch_id")))
    named = main_value(x.where("order = 1"), "stretch_id", "key", "unit_id").select("stretch_id", F.col("key").alias("name"))
    x = x.join(named, "stretch_id", "left").withColumn("same", F.coalesce(F.col("key") == F.col("name"), F.lit(False)))
    rank = F.when((F.col("order") == 1) & F.col("same"), 0).when(F.col("same"), 1).otherwise(2)
    return nearest(x, ["unit_id"], [rank, "order"]).select("unit_id", "stretch_id", (F.col("order") > 1).alias("moved"))


FIX = "case when unit_key % 50 = 0 then 'Residential' end"


@query(f"""{CASE_SQL}, {FLAGS_SQL}, c as (select *, llm_usage as said, coalesce({FIX}, llm_usage) as usage2, unit_key % 50 = 0 as corrected, coalesce(llm_floors >= 1 and unit_key % 2 = 0, false) as up from fl),
d as (select * replace (usage2 as llm_usage), case when corrected then false else up end as upper_unseen from c)
select unit_key, verdict as "check", case when llm_usage <> '' then llm_usage end as bldg_type, case when llm_floors = 0 then 'G' when llm_floors is not null then concat('G+', llm_floors) end as floors, case when llm_usage in ('Commercial', 'Mixed', 'Office / Lodge / Theater / Restaurants') then 'yes' when possible_shop then 'possible' else 'no' end as shop_gf,
 {VS_SQL} as vs_survey, case when runs_agree then 'yes' when runs_agree = false then 'no' end as runs_agree, flag from d""")
def building_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's row of each building: corrections replace what was read, and the difference to the survey follows them."""
    x = flagged(spark, sf_dir)
    fix = x.where("unit_key % 50 = 0").select("unit_key", F.lit("Residential").alias("fixed"))
    x = x.join(fix, "unit_key", "left").withColumn("usage", F.coalesce("fixed", "llm_usage"))
    unseen = F.when(F.col("fixed").isNotNull(), F.lit(False)).otherwise(F.coalesce((F.col("llm_floors") >= 1) & (F.col("unit_key") % 2 == 0), F.lit(False)))
    vs = rules.vs_survey(F.col("usage"), F.col("llm_floors"), F.col("rec_usage"), F.col("rec_floors"), unseen)
    yes_no = F.when(F.col("runs_agree"), "yes").when(~F.col("runs_agree"), "no")
    return x.select("unit_key", F.col("verdict").alias("check"), F.nullif("usage", F.lit("")).alias("bldg_type"), floors_text(F.col("llm_floors")).alias("floors"), rules.shop(F.col("usage"), F.col("possible_shop")).alias("shop_gf"), vs.alias("vs_survey"), yes_no.alias("runs_agree"), "flag")


@query(f"""{SUM_SQL}, k as (select stretch, count(*) as n_pictures, count(*) filter (verdict <> 'Not visible') as n_clear, max(newest) as newest from rw join (select unit_key, newest from readings) using (unit_key) group by stretch)
select stretch, case when n_clear = 0 then 'No picture' when stretch % 4 = 3 then 'Not read' else 'Read' end as "check", bldgs, read, trade_pct, n_pictures, n_clear, newest from bs join k using (stretch)""")
def street_layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's row of each stretch: its buildings' counts, its pictures, and whether it was read."""
    rows = street_rows(spark, sf_dir)
    pictures = rows.join(B.readings(spark, sf_dir).select("unit_key", "newest"), "unit_key").groupBy("stretch").agg(F.count("*").alias("n_pictures"), F.count_if(F.col("verdict") != "Not visible").alias("n_clear"), F.max("newest").alias("newest"))
    x = building_counts(rows, "stretch").join(pictures, "stretch")
    check = F.when(F.col("n_clear") == 0, "No picture").when(F.col("stretch") % 4 == 3, "Not read").otherwise("Read")
    return x.select("stretch", check.alias("check"), "bldgs", "read", "trade_pct", "n_pictures", "n_clear", "newest")


@query(f"{CASE_SQL}, s as (select unit_key, verdict, llm_usage, row_number() over (partition by verdict order by unit_key) as nth from v where verdict in ('Verified', 'Unsure') and llm_usage <> '') select unit_key, verdict, case when llm_usage in ('Commercial', 'Mixed', 'Office / Lodge / Theater / Restaurants') then 'trade' else 'other' end as tag from s")
def review_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings for reviewers: those with a reading that says something, tagged by trade."""
    x = judged(spark, sf_dir).where("verdict in ('Verified', 'Unsure') and llm_usage <> ''")
    return x.select("unit_key", "verdict", F.when(F.col("llm_usage").isin(*TRADE_USAGES), "trade").otherwise("other").alias("tag"))


CLICK_LINE = "case event_id % 6 when 0 then concat(' u', user_id, ',', '2026-01-0', 1 + event_id % 9, 'T10:00:', lpad(cast(event_id % 60 as string), 2, '0')) when 1 then 'only one field' when 2 then concat(',2026-01-01T00:00:00') when 3 then concat('u', user_id, ',yesterday') else concat('U', user_id, '_P2,2026-02-01 08:00:00') end"


@query(f"""with l as (select event_id, {CLICK_LINE} as line from events), f as (select event_id, trim(split_part(line, ',', 1)) as unit, try_cast(split_part(line, ',', 2) as timestamp) as t, line from l where contains(line, ','))
select event_id, regexp_replace(upper(unit), '_P([0-9]+)$', '_p\\1') as unit, strftime(t, '%Y-%m-%d %H:%M:%S') as at_time from f where unit <> '' and t is not null""")
def clicks_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a click log: those without a unit or a time are skipped."""
    x = B.table(spark, sf_dir, "events").selectExpr("event_id", f"{CLICK_LINE} as line")
    f = F.split("line", ",")
    x = x.select("event_id", norm_unit(F.get(f, F.lit(0))).alias("unit"), F.try_to_timestamp(F.get(f, F.lit(1))).alias("t"))
    return x.where("unit <> '' and t is not null").select("event_id", "unit", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("at_time"))


def panoramas_asked(points: DataFrame, panos: DataFrame, radius: float) -> DataFrame:
    """(pano_id, x, y): panoramas that are the nearest in reach of a point (x, y), with the last such point, row by row."""
    g = points.select("x", "y", F.col("x").alias("g1"), F.col("y").alias("h1"))
    x = nearest(points_within(g, panos, radius, ("x", "y", "g1", "h1")), ["x", "y"], [F.bround("dist", 6), "pano_ord"])
    return x.groupBy("pano_id").agg(F.max(F.struct("y", "x")).alias("last")).select("pano_id", "last.x", "last.y")


@query(f"""{B.with_views('units', 'panos')}, {GRID_SQL}, gn as (select x, y, pano_id, row_number() over (partition by x, y order by round_even(sqrt(power(px - x, 2) + power(py - y, 2)), 6), pano_ord) as nth from gp join panos on px between x - 10 and x + 10 and py between y - 10 and y + 10 and sqrt(power(px - x, 2) + power(py - y, 2)) <= 10),
gl as (select pano_id, max(struct_pack(y := y, x := x)) as last from gn where nth = 1 group by pano_id) select pano_id, last.x as x, last.y as y from gl""")
def panoramas_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panoramas found by asking at the search points around all units, 5 m apart; of several askings the last counts."""
    return panoramas_asked(grid_points(spark, sf_dir), B.panos(spark, sf_dir), S.nearest_radius)


@query()
def panoramas_found_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under its earlier name."""
    return panoramas_found(spark, sf_dir)


@query(f"{B.with_views('units', 'panos')}, {pairs_sql(30)}, c as (select unit_id, min(round_even(dist, 6)) as near, count(*) as n from pairs where dist >= 1.5e0 group by unit_id) select unit_id, near, n from c")
def cameras_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cameras(spark, sf_dir).groupBy("unit_id").agg(F.min(F.bround("dist", 6)).alias("near"), F.count("*").alias("n"))
