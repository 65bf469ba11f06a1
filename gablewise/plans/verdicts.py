"""Verdicts on readings, their comparison with the record, and reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions.text import floors_text, norm_door
from gablewise.model import REFERENCE, TRADE_USAGES, VISIBLE, Settings
from gablewise.operators import rules
from gablewise.plans.records import door_sql, main_value
from gablewise.plans.registry import query
from gablewise.sources import bindings as B

S = Settings()
USABLE = "target_visible in ('clear', 'partly hidden')"


def summary_sql(name: str, views: str, named: str = "reference_view") -> str:
    """The summary of a reading's views, as the table `name`; named: the column of readings that names the reference."""
    return f"""{name}0 as (select a.*, n.{named} as named from {views} a left join readings n using (unit_key)),
{name}1 as (select unit_key, count(*) as n_views, count(*) filter ({USABLE}) as n_usable, min(view) filter ({USABLE} and (named is null or named = view)) as ref_view,
  string_agg(distinct coalesce(hidden_by, '?'), ', ' order by coalesce(hidden_by, '?')) as hidden_by from {name}0 group by unit_key),
{name} as (select s.*, r.between_marks as ref_marks, case when ref_view is not null then 1 + (select count(*) from {views} o where o.unit_key = s.unit_key and o.{USABLE} and o.same_as_ref = 'yes' and o.view <> s.ref_view) else 0 end as n_agree
  from {name}1 s left join {views} r on r.unit_key = s.unit_key and r.view = s.ref_view)"""


SUMMARY_SQL = summary_sql("vm", "answer_views")


@query(f"{B.with_views('answer_views', 'readings')}, {SUMMARY_SQL} select unit_key, n_views, n_usable, ref_view, ref_marks, n_agree, hidden_by from vm")
def view_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.view_summary(B.answer_views(spark, sf_dir), "unit_key", B.readings(spark, sf_dir).select("unit_key", "reference_view"))


TWO = """case when n_usable{0} < 2 then 'only one clear view and no door number read' when n_agree{0} < 2 then 'no second view clearly shows the same building as the closest view'
 when ref_marks{0} like 'no%' then concat('marks in the reference view do not hold exactly one building: ', ref_marks{0}) when aerial{0} <> 'yes' and not features_both{0} then 'views agree but nothing matches the ortho'
 when not core_ok then 'frontage too narrow for the camera position error; needs a door number' end"""
PLACED = """case when n_agree = 0 then 'Unsure' when ref_marks like 'no%' then 'Unsure' when moved_away is not null then 'Unsure' else 'Verified' end"""
PLACED_WHY = """case when n_agree = 0 then 'screenshot: the reading could not confirm the building' when ref_marks like 'no%' then concat('screenshot shows more than one building or only part of one: ', ref_marks)
 when moved_away is not null then concat('screenshot taken away from the planned spot: ', moved_away) else 'camera placed by the checker at the planned spot; reading confirms one building' end"""

#: Doors on record of a unit: those of its lines with an even supplier; its neighbour is the next order with the same customer's number.
HITS_SQL = f"""own as (select distinct l_orderkey as unit_key, {door_sql("concat(l_linenumber, '-', cast(l_quantity as int))")} as door from lineitem where l_suppkey % 2 = 0),
rd as (select distinct unit_key, {door_sql('number_read')} as door from (select unit_key, number_read from answer_views union all select unit_key, number_read from second_views join readings using (unit_key) where n_runs > 1) where number_read is not null),
hit as (select rd.unit_key, rd.door, exists (select 1 from own o where o.unit_key = rd.unit_key and o.door = rd.door) as mine, exists (select 1 from own o where o.unit_key = rd.unit_key + 1 and o.door = rd.door) as next from rd),
hs as (select unit_key, coalesce(string_agg(door, ', ' order by door) filter (mine and not next), '') as own_hits,
 coalesce(string_agg(concat(door, ' is ', unit_key + 1), '; ' order by concat(door, ' is ', unit_key + 1)) filter (next and not mine), '') as neighbour_hits from hit group by unit_key)"""
CASE_SQL = f"""{B.with_views('answer_views', 'second_views', 'readings')}, {SUMMARY_SQL}, {summary_sql("vn", "second_views", "reference_view")}, {HITS_SQL},
w as (select unit_key, n_usable as n_usable2, n_agree as n_agree2, ref_marks as ref_marks2 from vn),
x as (select r.*, coalesce(n_usable2, 0) as n_usable2, coalesce(n_agree2, 0) as n_agree2, coalesce(ref_marks2, '') as ref_marks2, coalesce(n_usable, 0) as n_usable, coalesce(n_agree, 0) as n_agree, coalesce(ref_marks, '') as ref_marks, coalesce(hidden_by, '') as hidden_by, coalesce(own_hits, '') as own_hits, coalesce(neighbour_hits, '') as neighbour_hits
  from readings r left join vm using (unit_key) left join w using (unit_key) left join hs using (unit_key)),
y as (select *, {TWO.format('')} as two, {TWO.format('2')} as second_reason, concat(n_agree, ' views agree and match the ortho') as okay from x),
v as (select *, case when access = 'not visible' then 'Not visible' when access = 'not street-facing' then 'Not street-facing' when n_runs = 0 and error is not null then 'Unsure' when n_runs = 0 then 'Pending'
  when n_usable = 0 then 'Not visible' when neighbour_hits <> '' then 'Unsure' when own_hits <> '' then 'Verified' when viewer_placed then {PLACED} when two is not null then 'Unsure' when n_runs < 2 and second_required then 'Unsure'
  when n_runs < 2 then 'Verified' when second_reason is not null then 'Unsure' else 'Verified' end as verdict,
 case when access = 'not visible' then 'no panorama has a line of sight' when access = 'not street-facing' then 'seen only from a distance, through gaps between other buildings' when n_runs = 0 and error is not null then concat('LLM error: ', error)
  when n_runs = 0 then 'images are ready, the LLM has not been asked yet' when n_usable = 0 then concat('hidden in every view (', hidden_by, ')') when neighbour_hits <> '' then concat('door number read belongs to a neighbour: ', neighbour_hits)
  when own_hits <> '' then concat('door number read: ', own_hits) when viewer_placed then {PLACED_WHY} when two is not null then two when n_runs < 2 and second_required then 'second LLM run missing' when n_runs < 2 then concat(okay, ' (LLM asked once)')
  when second_reason is not null then concat('the two LLM runs disagree on identity: ', second_reason) else concat(okay, ', in both LLM runs') end as reason from y)"""


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the summary of their views in both runs and their door hits; and read, own, views_other: arrays of what these come from.

    All of a unit's lines meet in one aggregation. The neighbour's numbers come from a second, narrow one.
    """
    readings, lines = B.readings(spark, sf_dir), B.both_views(spark, sf_dir)
    lines = lines.join(readings.select("unit_key", F.col("reference_view").alias("named")), "unit_key", "left")
    doors = lambda c: F.collect_set(norm_door(F.col(c)))
    other = F.col("target_visible").isin(*VISIBLE) & (F.col("same_as_ref") == "no")
    per = lines.groupBy("unit_key").agg(
        *rules.summary_aggregates(), *rules.summary_aggregates("2"), doors("number_read").alias("read"), doors("number_read2").alias("read2"), doors("own_raw").alias("own"),
        F.array_sort(F.collect_list(F.when(other, F.col("view")))).alias("views_other"),
    )
    per = rules.with_summary(rules.with_summary(per), "2").drop("n_views2", "hidden_by2", "ref_view", "ref_view2")
    beside = B.both_views(spark, sf_dir).where("own_raw is not null").groupBy((F.col("unit_key") - 1).alias("unit_key")).agg(doors("own_raw").alias("next"))
    none = F.array().cast("array<string>")
    x = readings.join(per, "unit_key", "left").join(beside, "unit_key", "left").withColumns({c: F.coalesce(c, none) for c in ("read", "read2", "own", "next")})
    x = x.withColumn("read", F.when(F.col("n_runs") > 1, F.array_union("read", "read2")).otherwise(F.col("read"))).drop("read2")
    has = lambda c, d: F.array_contains(c, d)
    mine = F.filter("read", lambda d: has(F.col("own"), d) & ~has(F.col("next"), d))
    theirs = F.transform(F.filter("read", lambda d: has(F.col("next"), d) & ~has(F.col("own"), d)), lambda d: F.concat(d, F.lit(" is "), (F.col("unit_key") + 1).cast("string")))
    x = x.withColumns({"own_hits": F.array_join(F.array_sort(mine), ", "), "neighbour_hits": F.array_join(F.array_sort(theirs), "; ")}).drop("next")
    return x.fillna(0, ["n_usable", "n_agree", "n_usable2", "n_agree2"]).fillna("", ["ref_marks", "ref_marks2", "hidden_by"])


def columns(df: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in df.columns}


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = cases(spark, sf_dir)
    said, why = rules.verdict(columns(x))
    return x.withColumns({"verdict": said, "reason": why})


@query(f"{CASE_SQL} select unit_key, verdict, reason from v")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select("unit_key", "verdict", "reason")


@query(f"{CASE_SQL} select unit_key from y where own_hits = '' and neighbour_hits = '' and n_usable > 0 and two is null")
def second_opinion_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = cases(spark, sf_dir)
    return x.where(rules.needs_second_opinion(columns(x))).select("unit_key")


NORM = "regexp_replace(lower(coalesce({0}, 'None')), '[^a-z]', '', 'g')"
FLAGS_SQL = f"""f as (select *, case when storeys > 0 then storeys - 1 end as rec_floors, verdict in ('Verified', 'Unsure') and n_runs > 0 as checked from v),
g as (select *, case when not checked then 'Not checked' when llm_floors is null or rec_floors is null then 'Cannot tell' when llm_floors = rec_floors then 'Same' when llm_floors > rec_floors then 'LLM higher' else 'LLM lower' end as floor_flag,
 case when not checked then 'Not checked' when {NORM.format('llm_usage')} = {NORM.format('rec_usage')} then 'Same' else 'Different' end as usage_flag, case when checked and n_runs > 1 then llm_floors2 is not distinct from llm_floors and {NORM.format('llm_usage')} = {NORM.format('llm_usage2')} end as runs_agree from f),
fl as (select *, case when not checked then 'Not checked' when runs_agree = false then 'LLM runs disagree' when (floor_flag in ('LLM higher', 'LLM lower') or usage_flag = 'Different') and newest < '2025-01' then 'Mismatch (old imagery)'
 when floor_flag in ('LLM higher', 'LLM lower') or usage_flag = 'Different' then 'Mismatch' when possible_shop then 'Possible shop - check' else 'Match' end as flag from g)"""


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged readings with their floors and usage held against the record, and one overall flag."""
    x = judged(spark, sf_dir).withColumn("rec_floors", rules.record_floors(F.col("storeys")))
    checked = F.col("verdict").isin("Verified", "Unsure") & (F.col("n_runs") > 0)
    only = lambda c: F.when(F.col("checked"), c).otherwise("Not checked")
    x = x.withColumn("checked", checked)
    x = x.withColumns({
        "floor_flag": only(rules.floor_flag(F.col("llm_floors"), F.col("rec_floors"))),
        "usage_flag": only(rules.usage_flag(F.col("llm_usage"), F.col("rec_usage"))),
        "runs_agree": F.when(F.col("checked") & (F.col("n_runs") > 1), rules.runs_agree(*map(F.col, ("llm_floors", "llm_floors2", "llm_usage", "llm_usage2")))),
    })
    c = columns(x)
    return x.withColumn("flag", only(rules.overall_flag(c["floor_flag"], c["usage_flag"], c["runs_agree"], c["possible_shop"], c["newest"], S.old_imagery_before)))


@query(f"{CASE_SQL}, {FLAGS_SQL} select unit_key, floor_flag, usage_flag, runs_agree, flag from fl")
def compare_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select("unit_key", "floor_flag", "usage_flag", "runs_agree", "flag")


VS_SQL = f"""case when llm_usage is null or llm_usage in ('', 'cannot tell') then '-' else coalesce(nullif(concat_ws(' and ',
 case when {NORM.format('llm_usage')} <> {NORM.format('rec_usage')} then case when upper_unseen and {NORM.format('llm_usage')} = 'commercial' and {NORM.format('rec_usage')} = 'mixed' then 'type unclear (upper floors not seen)' else 'type differs' end end,
 case when llm_floors <> rec_floors then 'floors differ' end), ''), 'same') end"""
SURVEY_SQL = f"sv as (select *, {VS_SQL} as vs from (select *, case when storeys > 0 then storeys - 1 end as rec_floors, coalesce(llm_floors >= 1 and unit_key % 2 = 0, false) as upper_unseen from readings))"


def surveyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = B.readings(spark, sf_dir).withColumn("rec_floors", rules.record_floors(F.col("storeys")))
    x = x.withColumn("upper_unseen", F.coalesce((F.col("llm_floors") >= 1) & (F.col("unit_key") % 2 == 0), F.lit(False)))
    c = columns(x)
    return x.withColumn("vs", rules.vs_survey(c["llm_usage"], c["llm_floors"], c["rec_usage"], c["rec_floors"], c["upper_unseen"]))


@query(f"{B.with_views('readings')}, {SURVEY_SQL} select unit_key, vs from sv")
def vs_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surveyed(spark, sf_dir).select("unit_key", "vs")


TRADE_SQL = "('Commercial', 'Mixed', 'Office / Lodge / Theater / Restaurants')"


@query(f"{B.with_views('readings')} select unit_key, case when llm_usage in {TRADE_SQL} then 'yes' when possible_shop then 'possible' else 'no' end as shop_gf, case when llm_floors = 0 then 'G' when llm_floors is not null then concat('G+', llm_floors) end as floors from readings")
def shop_gf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.readings(spark, sf_dir).select("unit_key", rules.shop(F.col("llm_usage"), F.col("possible_shop")).alias("shop_gf"), floors_text(F.col("llm_floors")).alias("floors"))


@query(f"""{B.with_views('answer_views')} select unit_key, coalesce(min(view) filter (target_visible = 'clear' and same_as_ref in ('{REFERENCE}', 'yes', 'cannot tell')), min(view) filter (same_as_ref = '{REFERENCE}'), 1) as picture from answer_views group by unit_key""")
def picture_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view to show: the first clear one that isn't another building, else the reference, else the first."""
    v, view = B.answer_views(spark, sf_dir), F.col("view")
    fine = (F.col("target_visible") == "clear") & F.col("same_as_ref").isin(REFERENCE, "yes", "cannot tell")
    pick = F.coalesce(F.min(F.when(fine, view)), F.min(F.when(F.col("same_as_ref") == REFERENCE, view)), F.lit(1))
    return v.groupBy("unit_key").agg(pick.alias("picture"))


@query(f"""{B.with_views('answer_views', 'readings')}, b as (select unit_key, bool_or(has_board) filter (same_as_ref = '{REFERENCE}') as here, bool_or(has_board) filter (same_as_ref <> '{REFERENCE}') as there from answer_views group by unit_key)
select unit_key, llm_usage in {TRADE_SQL} and not coalesce(here, false) and coalesce(there, false) as elsewhere from readings join b using (unit_key)""")
def trade_only_in_other_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade was concluded, and boards were read only in views other than the reference."""
    ref = F.col("same_as_ref") == REFERENCE
    seen = lambda c: F.coalesce(F.bool_or(F.when(c, F.col("has_board"))), F.lit(False))
    b = B.answer_views(spark, sf_dir).groupBy("unit_key").agg(seen(ref).alias("here"), seen(~ref).alias("there"))
    x = B.readings(spark, sf_dir).join(b, "unit_key")
    return x.select("unit_key", (F.col("llm_usage").isin(*TRADE_USAGES) & ~F.col("here") & F.col("there")).alias("elsewhere"))


@query(f"{B.with_views('answer_views')} select unit_key, string_agg(number_read, ', ' order by view) as numbers from answer_views where number_read is not null group by unit_key")
def numbers_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numbers of a reading's views in the order of the views."""
    one = F.collect_list(F.struct("view", "number_read"))
    v = B.answer_views(spark, sf_dir).where("number_read is not null").groupBy("unit_key").agg(F.array_sort(one).alias("x"))
    return v.select("unit_key", F.array_join(F.transform("x", lambda s: s.number_read), ", ").alias("numbers"))


STREET_ROWS = """rw as (select o_custkey % 97 as stretch, unit_key, verdict, llm_usage, vs, case when o_custkey % 9 = 0 then 'cannot see' else 'seen' end as role, case when llm_usage in ('Mixed', 'Commercial') then 'yes' when possible_shop then 'possible' else 'no' end as shop_gf,
 verdict in ('Verified', 'Unsure') and llm_usage not in ('', 'cannot tell') as read from v join sv using (unit_key, llm_usage, possible_shop) join (select o_orderkey, o_custkey from orders) on o_orderkey = unit_key)"""
SUM_SQL = f"""{CASE_SQL}, {SURVEY_SQL}, {STREET_ROWS},
bs as (select stretch, count(*) as bldgs, count(*) filter (role = 'seen') as seen, count(*) filter (role <> 'seen') as cant_see, count(*) filter (read) as read, count(*) filter (read and verdict = 'Verified') as bldg_verified,
 count(*) filter (read and verdict = 'Unsure') as bldg_unsure, count(*) filter (role = 'seen' and verdict = 'Pending') as pending, count(*) filter (read and llm_usage = 'Residential') as residential, count(*) filter (read and llm_usage = 'Commercial') as commercial,
 count(*) filter (read and llm_usage = 'Mixed') as mixed, count(*) filter (read and shop_gf = 'yes') as shops, count(*) filter (read and shop_gf = 'possible') as poss_shops, count(*) filter (read and vs like '%differ%') as differ,
 count(*) filter (read and vs like '%type differs%') as differ_type, count(*) filter (read and vs like '%floors differ%') as differ_floors, count(*) filter (read and vs like '%type unclear%') as type_unclear,
 cast(round_even(100.0e0 * count(*) filter (read and llm_usage in {TRADE_SQL}) / nullif(count(*) filter (read), 0), 0) as int) as trade_pct,
 cast(round_even(100.0e0 * count(*) filter (read and vs like '%differ%') / nullif(count(*) filter (read), 0), 0) as int) as differ_pct, string_agg(distinct case when read and vs like '%differ%' then unit_key::varchar end, ', ' order by case when read and vs like '%differ%' then unit_key::varchar end) as differ_ids from rw group by stretch)"""


def street_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged readings along stretches."""
    customer = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unit_key"), "o_custkey")
    x = judged(spark, sf_dir).join(surveyed(spark, sf_dir).select("unit_key", "vs"), "unit_key").join(customer, "unit_key")
    read = F.col("verdict").isin("Verified", "Unsure") & ~F.col("llm_usage").isin("", "cannot tell")
    return x.select(
        (F.col("o_custkey") % 97).alias("stretch"), "unit_key", "verdict", "llm_usage", "vs", F.when(F.col("o_custkey") % 9 == 0, "cannot see").otherwise("seen").alias("role"),
        rules.shop(F.col("llm_usage"), F.col("possible_shop")).alias("shop_gf"), read.alias("read"),
    )


def building_counts(rows: DataFrame, key: str) -> DataFrame:
    """Counts over the buildings of each stretch, in one pass."""
    read, seen = F.col("read"), F.col("role") == "seen"
    says = lambda t: F.col("vs").contains(t)
    n = F.count_if
    pct = lambda c: F.rint(F.lit(100.0) * n(read & c) / F.nullif(n(read), F.lit(0))).cast("int")
    ids = F.array_join(F.array_sort(F.collect_set(F.when(read & says("differ"), F.col("unit_key").cast("string")))), ", ")
    return rows.groupBy(key).agg(
        F.count("*").alias("bldgs"), n(seen).alias("seen"), n(~seen).alias("cant_see"), n(read).alias("read"),
        n(read & (F.col("verdict") == "Verified")).alias("bldg_verified"), n(read & (F.col("verdict") == "Unsure")).alias("bldg_unsure"),
        n(seen & (F.col("verdict") == "Pending")).alias("pending"), *[n(read & (F.col("llm_usage") == u)).alias(u.lower()) for u in ("Residential", "Commercial", "Mixed")],
        n(read & (F.col("shop_gf") == "yes")).alias("shops"), n(read & (F.col("shop_gf") == "possible")).alias("poss_shops"), n(read & says("differ")).alias("differ"),
        n(read & says("type differs")).alias("differ_type"), n(read & says("floors differ")).alias("differ_floors"), n(read & says("type unclear")).alias("type_unclear"),
        pct(F.col("llm_usage").isin(*TRADE_USAGES)).alias("trade_pct"), pct(says("differ")).alias("differ_pct"), F.nullif(ids, F.lit("")).alias("differ_ids"),
    )


@query(f"{SUM_SQL} select * from bs")
def building_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return building_counts(street_rows(spark, sf_dir), "stretch")


LOOKS = {
    "zone": "case stretch % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' end",
    "road_type": "case stretch % 5 when 0 then 'main road' when 1 then 'lane' when 2 then 'dead end' when 3 then 'street' end",
    "width": "case when stretch % 3 = 0 then '2 lanes' else '1 lane' end",
    "shops_seen": "case stretch % 7 when 0 then 'none' when 1 then 'few' when 2 then 'about half' when 3 then 'mostly' else 'few' end",
}


@query(f"""{SUM_SQL}, lk as (select stretch, trade_pct, read, {', '.join(f'{e} as {c}' for c, e in LOOKS.items())} from bs)
select stretch, case when zone is null then 'no zone' when road_type is null then 'not read'
 when (road_type = 'main road' or shops_seen in ('about half', 'mostly') or coalesce(read >= 5 and trade_pct >= 50, false)) and zone in ('B', 'C') then 'zone may be low'
 when road_type in ('lane', 'dead end') and width = '1 lane' and shops_seen in ('none', 'few') and coalesce(trade_pct < 20, true) and zone = 'A' then 'zone may be high' else 'fits' end as fit,
 case when coalesce(read, 0) = 0 then 'none' when differ_pct < 15 then 'below 15' when differ_pct < 35 then '15-35' when differ_pct < 60 then '35-60' else '60 and more' end as gap from lk join bs using (stretch, trade_pct, read)""")
def zone_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does each stretch look like its zone, and the class of its gap to the survey."""
    x = building_counts(street_rows(spark, sf_dir), "stretch").withColumns({c: F.expr(e) for c, e in LOOKS.items()})
    fit = rules.zone_fit(*[F.col(c) for c in ("zone", "road_type", "width", "shops_seen", "trade_pct", "read")])
    d = F.col("differ_pct")
    gap = F.when(F.col("read") == 0, "none").when(d < 15, "below 15").when(d < 35, "15-35").when(d < 60, "35-60").otherwise("60 and more")
    return x.select("stretch", fit.alias("fit"), gap.alias("gap"))


SHARES = (("verified_floors", "verdict = 'Verified'", "floor_flag"), ("verified_usage", "verdict = 'Verified'", "usage_flag"), ("checked_floors", "verdict in ('Verified', 'Unsure') and llm_usage <> ''", "floor_flag"), ("checked_usage", "verdict in ('Verified', 'Unsure') and llm_usage <> ''", "usage_flag"))


@query(f"""{CASE_SQL}, {FLAGS_SQL} select 'verdict: ' || verdict as item, count(*)::double as value from fl group by verdict union all select 'flag: ' || flag, count(*)::double from fl group by flag
union all select 'buildings', count(*)::double from fl union all select 'possible shops', count(*) filter (possible_shop)::double from fl union all select 'door numbers matched', count(*) filter (own_hits <> '')::double from fl
""" + "".join(f"union all select '{n}', round_even(100e0 * count(*) filter ({t} and {c} = 'Same') / nullif(count(*) filter ({t} and {c} <> 'Cannot tell'), 0), 1) from fl " for n, t, c in SHARES))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a reviewer needs first, as items with a value; one pass gathers them by verdict and flag."""
    x = flagged(spark, sf_dir)
    n = F.count_if
    parts = [n(F.expr(f"({t}) and {c} = 'Same'")).alias(f"{k}_same") for k, t, c in SHARES] + [n(F.expr(f"({t}) and {c} <> 'Cannot tell'")).alias(f"{k}_known") for k, t, c in SHARES]
    g = x.groupBy("verdict", "flag").agg(F.count("*").alias("n"), n("possible_shop").alias("shops"), n(F.col("own_hits") != "").alias("doors"), *parts)
    item = lambda df, name, value: df.select(name.alias("item"), value.cast("double").alias("value"))
    out = item(g.groupBy("verdict").agg(F.sum("n").alias("n")), F.concat(F.lit("verdict: "), "verdict"), F.col("n"))
    out = out.unionByName(item(g.groupBy("flag").agg(F.sum("n").alias("n")), F.concat(F.lit("flag: "), "flag"), F.col("n")))
    total = g.agg(*[F.sum(c).alias(c) for c in g.columns if c not in ("verdict", "flag")])
    pairs = [("buildings", F.col("n")), ("possible shops", F.col("shops")), ("door numbers matched", F.col("doors"))]
    pairs += [(k, F.bround(F.lit(100.0) * F.col(f"{k}_same") / F.nullif(F.col(f"{k}_known"), F.lit(0)), 1)) for k, _, _ in SHARES]
    rows = total.select(F.explode(F.array(*[F.struct(F.lit(k).alias("item"), v.cast("double").alias("value")) for k, v in pairs])).alias("r")).select("r.*")
    return out.unionByName(rows)


@query(f"{CASE_SQL}, u as (select trim(regexp_replace(regexp_replace(reason, '\\(.*?\\)', '', 'g'), ':.*$', '')) as reason, count(*) as n from v where verdict = 'Unsure' group by 1) select reason, n from u order by n desc, reason limit 8")
def unsure_reasons_top8(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.trim(F.regexp_replace("reason", r"\(.*?\)|:.*$", ""))
    return judged(spark, sf_dir).where("verdict = 'Unsure'").groupBy(r.alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(8)


@query(f"{CASE_SQL} select access, verdict, count(*) as n, row_number() over (order by count(*) desc, access, verdict)::int as place from v group by access, verdict")
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts for the legend, the most frequent first."""
    g = judged(spark, sf_dir).groupBy("access", "verdict").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "access", "verdict")))


@query(f"{B.with_views('readings')}, c as (select newest, llm_usage, count(*) as n, min(unit_key) as first from readings where llm_usage <> '' group by all), b as (select *, row_number() over (partition by newest order by n desc, first, llm_usage) as nth from c) select newest, llm_usage, n from b where nth = 1 and newest is not null")
def main_usage_by_imagery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_value(B.readings(spark, sf_dir).where("llm_usage <> '' and newest is not null"), "newest", "llm_usage", "unit_key").select("newest", "llm_usage", "n")
