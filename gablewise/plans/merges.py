"""Queries over earlier results and people's answers: as-of matching, latest answers, carry-over, upserts, invalidation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import merge, parts
from gablewise.plans import inputs
from gablewise.plans.registry import ORACLES, query
from gablewise.sources import bindings as B

S = Settings()


@query("""with clicks as (select ts, user_id from events where event_type = 'click'), shots as (select event_id, ts from events where event_type <> 'click'),
j as (select s.event_id, s.ts, c.ts as click_at, c.user_id from shots s asof left join clicks c on s.ts >= c.ts)
select event_id, case when click_at is null then 'before first' when epoch_us(ts) - epoch_us(click_at) < 2000000 then 'too soon' when epoch_us(ts) - epoch_us(click_at) > 240000000 then 'too long' else 'ok' end as reason,
 case when epoch_us(ts) - epoch_us(click_at) between 2000000 and 240000000 then user_id end as mark from j""")
def clicks_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each capture goes to the last click before it, unless too little or too much time has passed."""
    e = B.table(spark, sf_dir, "events")
    shots, clicks = e.where("event_type <> 'click'").select("event_id", "ts"), e.where("event_type = 'click'").select("ts", "user_id")
    return merge.as_of(shots, clicks, "ts", "user_id", S.click_min_s, S.click_max_s, 6 * 3600).select("event_id", "reason", "mark")


@query(f"""{B.with_views('reviews')}, l as (select *, lag(reviewer) over w as r0, lag(ident) over w as i0, lag(floors) over w as f0, lag(usage) over w as u0, row_number() over w as nth, count(*) over (partition by unit_key) as n from reviews window w as (partition by unit_key order by said_at, file_ord)),
d as (select *, r0 is not null and r0 <> reviewer and (i0 is distinct from ident or f0 is distinct from floors or u0 is distinct from usage) as differs from l)
select unit_key, reviewer, ident, floors, usage, n as n_answers, differs as disagrees, case when differs then concat('earlier answer by ', r0, ': ', i0, ', ', coalesce(f0::varchar, '-'), ', ', coalesce(u0, '-')) end as note from d where nth = n""")
def review_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = merge.latest_answers(B.reviews(spark, sf_dir), "unit_key", "said_at", "file_ord", "reviewer", ("ident", "floors", "usage"))
    return x.select("unit_key", "reviewer", "ident", "floors", "usage", "n_answers", "disagrees", "note")


@query(f"""{B.with_views('reviews')}, t as (select * from reviews where file_ord % 97 <> 0 and unit_key in (select o_orderkey from orders)),
l as (select *, lag(reviewer) over w as r0, lag(ident) over w as i0, lag(floors) over w as f0, lag(usage) over w as u0, row_number() over w as nth, count(*) over (partition by unit_key) as n from t window w as (partition by unit_key order by said_at, file_ord))
select unit_key, reviewer, ident, floors, usage, n as n_answers, r0 is not null and r0 <> reviewer and (i0 is distinct from ident or f0 is distinct from floors or u0 is distinct from usage) as disagrees from l where nth = n""")
def review_merge_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last answer on each building, of those that belong to this run and to a building of it."""
    taken = merge.accepted(B.reviews(spark, sf_dir).withColumn("other_run", F.col("file_ord") % 97 == 0), B.readings(spark, sf_dir), "unit_key")
    x = merge.latest_answers(taken, "unit_key", "said_at", "file_ord", "reviewer", ("ident", "floors", "usage"))
    return x.select("unit_key", "reviewer", "ident", "floors", "usage", "n_answers", "disagrees")


EDITS = {"unit_key": "user_id", "priority": "event_id", "remark": "case when event_id % 4 = 0 then '  ' when event_id % 4 = 1 then null else concat('seen ', event_type) end", "status": "case when event_id % 5 = 0 then 'done' end"}


@query(f"""with e as (select {', '.join(f'{v} as {k}' for k, v in EDITS.items())} from events), f as (select unit_key, priority, case when trim(remark) <> '' then remark end as remark, status from e),
l as (select *, row_number() over (partition by unit_key order by priority desc) as nth from f where coalesce(remark, status) is not null)
select o_orderkey as unit_key, remark, status from orders left join l on l.unit_key = o_orderkey and nth = 1""")
def carry_over_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.table(spark, sf_dir, "orders").selectExpr("o_orderkey as unit_key")
    edits = B.table(spark, sf_dir, "events").selectExpr(*[f"{v} as {k}" for k, v in EDITS.items()])
    return merge.carry_over(rows, edits, ["unit_key"], ["remark", "status"], "priority")


@query(f"{B.with_views('panos')}, n as (select concat('P', user_id) as pano_id, max(strftime(ts, '%Y-%m')) as pano_date from events group by 1) select pano_id, pano_date from n union all select pano_id, pano_date from panos where pano_id not in (select pano_id from n)")
def pano_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = B.table(spark, sf_dir, "events").groupBy(F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("pano_id")).agg(F.max(F.date_format("ts", "yyyy-MM")).alias("pano_date"))
    return merge.upsert(B.panos(spark, sf_dir).select("pano_id", "pano_date"), new, ["pano_id"])


@query(f"{B.with_views('units')} select unit_id from units where storeys > 0 and ord not in (select user_id from events where event_type = 'click')")
def missing_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that should have pictures and have none."""
    done = B.table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("ord"))
    return B.units(spark, sf_dir).where("storeys > 0").join(done, "ord", "left_anti").select("unit_id")


STAMP = "substring(sha1(concat_ws('|', l_returnflag, cast(l_linenumber % {0} as string))), 1, 16)"
STAMP_SQL = "left(sha1(concat_ws('|', l_returnflag, cast(l_linenumber % {0} as varchar))), 16)"


@query(f"""with k as (select l_orderkey as unit_key, min({STAMP_SQL.format(3)}) as stamp, max({STAMP_SQL.format(3)}) as answer from lineitem group by 1), c as (select l_orderkey as unit_key, min({STAMP_SQL.format(4)}) as stamp from lineitem group by 1)
select k.unit_key, answer from k join c using (unit_key, stamp)""")
def key_invalidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose request is still the same."""
    line = B.table(spark, sf_dir, "lineitem")
    kept = line.groupBy(F.col("l_orderkey").alias("unit_key")).agg(F.min(F.expr(STAMP.format(3))).alias("stamp"), F.max(F.expr(STAMP.format(3))).alias("answer"))
    now = line.groupBy(F.col("l_orderkey").alias("unit_key")).agg(F.min(F.expr(STAMP.format(4))).alias("stamp"))
    return merge.still_valid(kept, now, ["unit_key"], "stamp").select("unit_key", "answer")


NAMES = """concat(lower(concat('b', p_partkey, case when p_partkey % 6 > 2 and p_size % 3 = 0 then '_P2' else '' end)), case p_size % 4 when 0 then '' when 1 then '_2' when 2 then '-3' else '_x' end,
 case p_size % 7 when 0 then '.txt' when 1 then '.JPG' when 2 then '' when 3 then '.webp' else '.png' end)"""
STEM, UNIT_NAME = r"^(.*)\.([A-Za-z]+)$", r"^([A-Za-z0-9]*[0-9](?:_[pP][0-9]+)?)(?:[_-]([0-9]+))?$"


@query(f"""with un as ({ORACLES['units_of_parts']}), kn as (select unit_id as said, unit_id from un union all select building_id, unit_id from un where part = 1 and unit_id <> building_id),
f as (select {NAMES} as name from part), g as (select name, regexp_extract(name, '{STEM}', 1) as stem from f where lower(regexp_extract(name, '{STEM}', 2)) in ('png', 'jpg', 'jpeg', 'webp')),
m as (select name, regexp_replace(upper(regexp_extract(stem, '{UNIT_NAME}', 1)), '_P([0-9]+)$', '_p\\1') as said, coalesce(try_cast(nullif(regexp_extract(stem, '{UNIT_NAME}', 2), '') as int), 1) as n from g)
select name, unit_id, case when unit_id is not null then n end as n from m left join kn using (said)""")
def match_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures by their names: a unit's or a building's id, perhaps with a number; others are unknown, and other files left out."""
    return parts.match_files(B.table(spark, sf_dir, "part").selectExpr(f"{NAMES} as name"), inputs.units_of_parts(spark, sf_dir))


@query(f"""{B.with_views('reviews')}, l as (select *, row_number() over (partition by unit_key order by said_at desc, file_ord desc) as nth from reviews), r as (select l.*, o_orderkey % 4 as llm_floors, case o_custkey % 3 when 0 then 'Residential' when 1 then 'Mixed' end as rec_usage from l join orders on o_orderkey = unit_key where nth = 1)
select ident, count(*) as n, count(*) filter (floors is not null) as floors_known, round_even(100e0 * count(*) filter (floors = llm_floors) / nullif(count(*) filter (floors is not null), 0), 1) as floors_pct,
 round_even(100e0 * count(*) filter (usage <> 'cannot tell' and usage = rec_usage) / nullif(count(*) filter (usage <> 'cannot tell' and rec_usage is not null), 0), 1) as usage_pct, count(*) filter (shop = 'yes') as saw_shop from r group by ident""")
def review_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often what reviewers saw agrees with the reading and with the record."""
    last = merge.last_by(B.reviews(spark, sf_dir), ["unit_key"], ["said_at", "file_ord"])
    said = B.table(spark, sf_dir, "orders").selectExpr("o_orderkey as unit_key", "o_orderkey % 4 as llm_floors", f"{B.READINGS['rec_usage']} as rec_usage")
    n, told = F.count_if, F.col("usage") != "cannot tell"
    pct = lambda hit, of: F.bround(F.lit(100.0) * n(hit) / F.nullif(n(of), F.lit(0)), 1)
    return last.join(said, "unit_key").groupBy("ident").agg(
        F.count("*").alias("n"), n(F.col("floors").isNotNull()).alias("floors_known"), pct(F.col("floors") == F.col("llm_floors"), F.col("floors").isNotNull()).alias("floors_pct"),
        pct(told & (F.col("usage") == F.col("rec_usage")), told & F.col("rec_usage").isNotNull()).alias("usage_pct"), n(F.col("shop") == "yes").alias("saw_shop"),
    )


@query(f"{B.with_views('units')}, s as (select *, row_number() over (order by y0 desc, ord) as nth, count(*) over () as n from units where storeys > 2) select unit_id, case when nth <= ceil(n / 2.0e0) then 1 else 2 end as half from s")
def review_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review list from north to south in two halves: split at the median place, without ranking all rows in one task."""
    u = B.units(spark, sf_dir).where("storeys > 2").select("unit_id", "y0", "ord")
    rows = u.groupBy("y0").agg(F.count("*").alias("k"))
    w = W.orderBy(F.desc("y0"))
    rows = rows.withColumns({"before": F.sum("k").over(w) - F.col("k"), "n": F.sum("k").over(W.partitionBy())})  # one row a line of houses
    x = u.join(F.broadcast(rows), "y0").withColumn("nth", F.col("before") + F.row_number().over(W.partitionBy("y0").orderBy("ord")))
    return x.select("unit_id", F.when(F.col("nth") <= F.ceil(F.col("n") / 2), 1).otherwise(2).alias("half"))
