"""Queries for result rows and what is done with them: views by place, files, reviews, lists, pictures, request keys, roads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.functions.text import norm_usage
from gablewise.model import Settings
from gablewise.operators import looks, merge, selection
from gablewise.plans import spatial
from gablewise.plans.registry import query
from gablewise.plans.verdicts import CASE_SQL, FLAGS_SQL, NORM, flagged
from gablewise.sources import bindings as B
from gablewise.sources import files
from gablewise.sources.files import settled

S = Settings()
ROW_SQL = f"""{CASE_SQL}, {FLAGS_SQL}, dr as (select unit_key, string_agg(door, ', ' order by door) as door_read from rd group by unit_key), dn as (select unit_key, string_agg(door, ', ' order by door) as door_record from own group by unit_key),
oth as (select unit_key, string_agg(view, ', ' order by view) as views_other from answer_views where target_visible in ('clear', 'partly hidden') and same_as_ref = 'no' group by unit_key),
res as (select fl.unit_key, access, verdict, reason as verdict_why, flag, case when checked then llm_floors end as llm_floors, rec_floors, floor_flag, case when checked then nullif(llm_usage, '') end as llm_usage, rec_usage, usage_flag,
 case when checked then possible_shop end as poss_shop, coalesce(door_read, '') as door_read, coalesce(door_record, '') as door_record, own_hits as door_match, coalesce(n_views, 0) as n_views, n_usable as views_clear, n_agree as views_agree,
 coalesce(views_other, '') as views_other, n_runs as llm_runs, runs_agree, newest as pano_date from fl left join (select unit_key, n_views from vm) using (unit_key) left join dr using (unit_key) left join dn using (unit_key) left join oth using (unit_key))"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a building: access, verdict and why, what was read against the record, doors, views, runs."""
    x = flagged(spark, sf_dir)
    x = x.withColumns({"door_read": F.array_join(F.array_sort("read"), ", "), "door_record": F.array_join(F.array_sort("own"), ", "), "views_other": F.array_join(F.transform("views_other", lambda v: v.cast("string")), ", ")})
    if_checked = lambda c: F.when(F.col("checked"), c)
    return x.fillna("", ["door_read", "door_record", "views_other"]).fillna(0, ["n_views"]).select(
        "unit_key", "access", "verdict", F.col("reason").alias("verdict_why"), "flag", if_checked(F.col("llm_floors")).alias("llm_floors"), "rec_floors", "floor_flag",
        if_checked(F.nullif("llm_usage", F.lit(""))).alias("llm_usage"), "rec_usage", "usage_flag", if_checked(F.col("possible_shop")).alias("poss_shop"), "door_read", "door_record", F.col("own_hits").alias("door_match"),
        "n_views", F.col("n_usable").alias("views_clear"), F.col("n_agree").alias("views_agree"), "views_other", F.col("n_runs").alias("llm_runs"), "runs_agree", F.col("newest").alias("pano_date"),
    )


@query(f"{ROW_SQL} select * from res")
def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir)


#: What a reading says besides its verdict, as texts, lists with | between, and numbers; of a unit without a reading nothing.
DETAILS = {
    "floors_note": "case when o_orderkey % 8 = 0 then 'room on the terrace' else '' end",
    "terrace": "case o_orderkey % 3 when 0 then 'none' when 1 then 'water tank' else 'sheet roof' end",
    "shutters": "cast(o_orderkey % 3 as int)",
    "front_struct": "case when o_orderkey % 6 = 1 then 'stairs' else 'none' end",
    "constr": "case when o_orderkey % 10 = 3 then 'under construction' else 'complete' end",
    "roof": "case when o_custkey % 4 = 0 then 'tiles' else 'RCC flat' end",
    "conf_ident": "case when o_orderkey % 6 > 0 then (o_orderkey % 100) / 100.0e0 end",
    "conf_floors": "(o_orderkey % 90) / 100.0e0",
    "conf_usage": "(o_custkey % 80) / 100.0e0",
    "llm_note": "concat('seen ', o_orderkey % 11, ' times')",
}
LISTS = {
    "trade_evid": "case when o_totalprice > 100000e0 then concat('shutter|board ', o_orderkey % 7) when o_orderkey % 2 = 0 then '' end",
    "other_boards": "case when o_orderkey % 5 = 0 then concat('no ', o_orderkey % 10, '|to let') else '' end",
    "extras": "case when o_orderkey % 7 = 2 then 'gate|well|shed' else '' end",
}
MODELS = ("case when o_orderkey % 4 > 0 then concat('model ', o_orderkey % 3) end", "case when o_orderkey % 3 = 0 then 'model b' end")


def _details_sql() -> str:
    plain = ", ".join(f"case when n_runs > 0 then {e} end as {c}" for c, e in DETAILS.items())
    lists = ", ".join(f"case when n_runs > 0 then coalesce(array_to_string(string_split({e}, '|'), '; '), '') else '' end as {c}" for c, e in LISTS.items())
    return f"""de as (select o_orderkey as unit_key, o_custkey as place, {plain}, {lists}, coalesce(case when n_runs > 0 then {MODELS[0]} end, case when n_runs > 1 then {MODELS[1]} end) as model from orders join (select unit_key, n_runs from readings) r on r.unit_key = o_orderkey),
pd as (select l_orderkey as unit_key, string_agg(distinct strftime(l_shipdate, '%Y-%m'), ', ' order by strftime(l_shipdate, '%Y-%m')) as pano_dates from lineitem group by 1),
au as (select building_id, coalesce(string_agg(distinct trim(usage_raw), '+' order by trim(usage_raw)), '') as assess_usage from assess group by building_id),
pl as (select ord as place, un.building_id, road, assess_usage from units un left join au using (building_id))"""


@query(f"""{ROW_SQL}, units as ({B.WITH['units']}), assess as ({B.WITH['assess']}), {_details_sql()}
select res.*, pl.building_id, pl.road, pl.assess_usage, {', '.join([*DETAILS, *LISTS])}, model, coalesce(pano_dates, '') as pano_dates, null::varchar as evidence, {', '.join(f'null::varchar as {c}' for c in ('rev_ident', 'rev_usage', 'rev_by', 'rev_at', 'rev_note'))}
from res join de using (unit_key) left join pd using (unit_key) left join pl using (place)""")
def result_rows_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a building with all that its reading says, where it stands, the months of its views, and empty fields for reviewers."""
    x, o = results(spark, sf_dir), B.table(spark, sf_dir, "orders")
    told = lambda e: F.expr(f"case when n_runs > 0 then {e} end")
    listed = {c: F.coalesce(F.array_join(F.split(told(e), r"\|"), "; "), F.lit("")) for c, e in LISTS.items()}
    model = F.coalesce(told(MODELS[0]), F.expr(f"case when n_runs > 1 then {MODELS[1]} end"))
    runs = B.readings(spark, sf_dir).select("unit_key", "n_runs")
    d = o.join(runs, F.col("o_orderkey") == F.col("unit_key")).select("unit_key", F.col("o_custkey").alias("place"), *[told(e).alias(c) for c, e in DETAILS.items()], *[v.alias(c) for c, v in listed.items()], model.alias("model"))
    months = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit_key")).agg(F.array_join(F.array_sort(F.collect_set(F.date_format("l_shipdate", "yyyy-MM"))), ", ").alias("pano_dates"))
    usages = B.assess(spark, sf_dir).groupBy("building_id").agg(F.concat_ws("+", F.array_sort(F.collect_set(F.trim("usage_raw")))).alias("assess_usage"))
    places = B.units(spark, sf_dir).select(F.col("ord").alias("place"), "building_id", "road").join(usages, "building_id", "left")
    x = x.join(d, "unit_key").join(months, "unit_key", "left").join(places, "place", "left").drop("place").fillna("", ["pano_dates"])
    return x.withColumns({c: F.lit(None).cast("string") for c in ("evidence", "rev_ident", "rev_usage", "rev_by", "rev_at", "rev_note")})


@query(f"""{B.with_views('answer_views')}, p as (select o_orderkey as unit_key, unnest(range(1, 2 + o_orderkey % 4)) as view from orders)
select p.unit_key, p.view, target_visible as visible, hidden_by from p left join answer_views a on a.unit_key = p.unit_key and a.view = p.view where (p.unit_key + p.view) % 7 <> 0""")
def result_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned views with what the reading says of the view at the same place; views without a camera are left out."""
    p = B.table(spark, sf_dir, "orders").selectExpr("o_orderkey as unit_key", "explode(sequence(1L, 1 + o_orderkey % 4)) as view").where("(unit_key + view) % 7 <> 0")
    said = B.answer_views(spark, sf_dir).select("unit_key", F.col("view").cast("long").alias("view"), F.col("target_visible").alias("visible"), "hidden_by")
    return p.join(said, ["unit_key", "view"], "left")


FILE_NAME = "case event_id % 6 when 0 then 'result.gpkg' when 1 then concat('result_', event_id % 50, '.gpkg') when 2 then 'result_old.gpkg' when 3 then concat('result_', event_id % 50, '.json') else 'summary.json' end"


@query(f"""with f as (select user_id, {FILE_NAME} as name from events), n as (select *, case when name = 'result.gpkg' then 1 else try_cast(regexp_extract(name, '^result_([0-9]+)\\.gpkg$', 1) as int) end as number from f)
select user_id, arg_max(name, number) as latest from (select distinct * from n where number is not null) group by user_id""")
def latest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest result file of each run: result.gpkg, or of the numbered ones the highest."""
    return files.latest_result(B.table(spark, sf_dir, "events").selectExpr("user_id", f"{FILE_NAME} as name"), ["user_id"], "name")


LAST_SQL = "l as (select * from (select *, row_number() over (partition by unit_key order by said_at desc, file_ord desc) as nth from reviews) where nth = 1), rv as (select l.*, verdict, llm_floors, rec_floors, llm_usage, rec_usage, poss_shop from l join res using (unit_key))"
SAME = f"{NORM.format('{0}')} = {NORM.format('usage')}"
#: Of each figure, the rows that count and those that hit.
FIGURES = {
    "reviewed": ("true", "true"),
    "said yes": ("true", "ident = 'yes'"),
    "said no": ("true", "ident = 'no'"),
    "said cannot tell": ("true", "ident = 'cannot tell'"),
    "verified but wrong building": ("verdict = 'Verified'", "ident = 'no'"),
    "floors, reading": ("ident = 'yes' and floors is not null and llm_floors is not null", "floors = llm_floors"),
    "floors, record": ("ident = 'yes' and floors is not null and rec_floors is not null", "floors = rec_floors"),
    "usage, reading": ("ident = 'yes' and usage <> 'cannot tell' and llm_usage is not null", "{same llm_usage}"),
    "usage, record": ("ident = 'yes' and usage <> 'cannot tell' and rec_usage is not null", "{same rec_usage}"),
    "possible shop": ("ident = 'yes' and poss_shop", "shop = 'yes'"),
}


def _figure_sql(name: str, of: str, hit: str) -> str:
    for c in ("llm_usage", "rec_usage"):
        hit = hit.replace(f"{{same {c}}}", SAME.format(c))
    n, h = f"count(*) filter ({of})", f"count(*) filter (({of}) and ({hit}))"
    return f"select '{name}' as figure, {n} as n, {h} as hits, round_even(100e0 * {h} / nullif({n}, 0), 1) as pct from rv"


@query(ROW_SQL + f", {B.with_views('reviews').removeprefix('with ')}, {LAST_SQL} " + " union all ".join(_figure_sql(k, *v) for k, v in FIGURES.items()))
def review_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reviewers said, and how often the reading and the record agree with those that saw the right building."""
    last = merge.last_by(B.reviews(spark, sf_dir), ["unit_key"], ["said_at", "file_ord"])
    x = last.join(results(spark, sf_dir).select("unit_key", "verdict", "llm_floors", "rec_floors", "llm_usage", "rec_usage", "poss_shop"), "unit_key")
    same = {f"{{same {c}}}": norm_usage(F.col(c)) == norm_usage(F.col("usage")) for c in ("llm_usage", "rec_usage")}
    hits = {k: same[hit] if hit in same else F.expr(hit) for k, (_, hit) in FIGURES.items()}
    one = x.agg(*[F.struct(F.count_if(F.expr(of)).alias("n"), F.count_if(F.expr(of) & hits[k]).alias("hits")).alias(k) for k, (of, _) in FIGURES.items()])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("figure"), F.col(f"`{k}`.n").alias("n"), F.col(f"`{k}`.hits").alias("hits")) for k in FIGURES])).alias("r")).select("r.*")
    return rows.withColumn("pct", F.bround(F.lit(100.0) * F.col("hits") / F.nullif("n", F.lit(0)), 1))


@query(f"{ROW_SQL} select unit_key, verdict, flag from res where verdict = 'Unsure' and flag like 'Mismatch%' and contains(lower(concat('B', unit_key)), '7')")
def list_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of buildings under all its filters: verdict, flag, and a piece of the id."""
    x = results(spark, sf_dir).where((F.col("verdict") == "Unsure") & F.col("flag").startswith("Mismatch"))
    return x.where(F.lower(F.concat(F.lit("B"), "unit_key")).contains("7")).select("unit_key", "verdict", "flag")


@query(f"{ROW_SQL} select 'verdict' as field, verdict as value, count(*) as n from res group by 2 union all select 'flag', flag, count(*) from res group by 2")
def list_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many buildings each choice of the list's filters has."""
    x = results(spark, sf_dir)
    one = lambda c: x.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(c).alias("field"), "value", "n")
    return one("verdict").unionByName(one("flag"))


@query(f"""{B.with_views('reviews')}, r as (select *, file_ord % 97 = 0 as other_run, unit_key in (select o_orderkey from orders) as known from reviews), k as (select *, lag(reviewer) over w as r0, lag(ident) over w as i0, lag(floors) over w as f0, lag(usage) over w as u0, row_number() over w as nth
 from r where not other_run and known window w as (partition by unit_key order by said_at, file_ord))
select (select count(*) from r where other_run) as rejected, (select count(*) from r where not other_run and not known) as unknown_buildings, count(*) as answers, count(distinct unit_key) as unique_buildings,
 count(*) filter (nth > 1 and r0 is distinct from reviewer and (i0 is distinct from ident or f0 is distinct from floors or u0 is distinct from usage)) as disagreements from k""")
def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an import of reviewers' answers did: those of another run are rejected, those on unknown buildings skipped."""
    return merge.import_counts(B.reviews(spark, sf_dir).withColumn("other_run", F.col("file_ord") % 97 == 0), B.readings(spark, sf_dir).select("unit_key"), "unit_key", "said_at", "file_ord", "reviewer", ["ident", "floors", "usage"])


@query(f"""{B.with_views('answer_views')}, s as (select unit_key, view, target_visible = 'clear' as clear, (count(*) over (partition by unit_key) + 1) / 2e0 as mid from answer_views where not has_board),
r as (select *, row_number() over (partition by unit_key order by not clear, abs(view - mid), view) as nth from s) select unit_key, view from r where nth = 1""")
def layer_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The picture for the layer: of those that exist the clear one nearest the middle, else any nearest the middle."""
    return selection.middle_picture(B.answer_views(spark, sf_dir).where("not has_board"), "unit_key", "view", F.col("target_visible") == "clear")


@query(f"""{B.with_views('units')}, f as (select unit_id, ord, unnest(range(1, 1 + ord % 3)) as n from units), p as (select *, case when ord % 5 <> 0 then (ord * 7) % 360 * 1e0 end as heading from f)
select unit_id, n, concat(unit_id, '_s', n, '.jpg') as image, coalesce(heading, 0e0) as heading, case when heading is null then 90e0 else 60e0 end as fov from p""")
def screenshot_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures that people took, as a unit's views: they carry the first planned camera, or a neutral one if none was planned."""
    shots = B.units(spark, sf_dir).where("ord % 3 > 0").selectExpr("unit_id", "explode(sequence(1L, ord % 3)) as n")
    planned = B.units(spark, sf_dir).where("ord % 5 <> 0").select("unit_id", F.lit(1).alias("view"), (F.col("ord") * 7 % 360).cast("double").alias("heading"), F.lit(60.0).alias("fov"))
    first = planned.groupBy("unit_id").agg(F.min_by(F.struct("heading", "fov"), "view").alias("aim"))
    x = shots.join(first, "unit_id", "left")
    return x.select("unit_id", "n", F.concat("unit_id", F.lit("_s"), "n", F.lit(".jpg")).alias("image"), F.coalesce("aim.heading", F.lit(0.0)).alias("heading"), F.coalesce("aim.fov", F.lit(90.0)).alias("fov"))


AIM = "concat(l_returnflag, '/', cast({0} as string))"


@query(f"""with n as (select l_orderkey as unit_key, l_linenumber as n, min(l_partkey) as pano, min({AIM.format('l_suppkey % 3')}) as aim from lineitem group by 1, 2), o as (select unit_key, n, case when unit_key % 6 = 0 then pano + 1 else pano end as pano, case when n % 2 = 0 then aim else concat(aim, 'x') end as aim from n where n < 6)
select n.unit_key, n.n, coalesce(o.pano = n.pano and o.aim = n.aim, false) as reuse from n left join o on o.unit_key = n.unit_key and o.n = n.n""")
def pictures_planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which planned views can keep the picture that an earlier plan has at the same place: of the same panorama and aim."""
    now = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit_key"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("pano"), F.min(F.expr(AIM.format("l_suppkey % 3"))).alias("aim"))
    old = now.where("n < 6").select("unit_key", "n", F.when(F.col("unit_key") % 6 == 0, F.col("pano") + 1).otherwise(F.col("pano")).alias("pano"), F.when(F.col("n") % 2 == 0, F.col("aim")).otherwise(F.concat("aim", F.lit("x"))).alias("aim"))
    return merge.reusable(now, old, ["unit_key", "n"], ["pano", "aim"], "reuse").select("unit_key", "n", "reuse")


KEY = "substring(sha1(concat_ws('|', {0}, o_orderkey, o_orderpriority)), 1, 12)"


@query(f"""with s as (select o_orderkey as unit_key, case o_orderkey % 4 when 0 then {KEY.format("'now'")} when 1 then {KEY.format("'v1'")} when 2 then {KEY.format("'v2'")} else 'gone' end as saved, o_orderkey % 9 <> 0 as pictures, {KEY.format("'now'")} as fresh, {KEY.format("'v1'")} as a, {KEY.format("'v2'")} as b from orders)
select unit_key, case when not pictures then 'no images' when saved = fresh then 'already new' when saved in (a, b) then 're-keyed' else 'images changed, left alone' end as state, case when pictures and saved in (a, b) then fresh else saved end as key from s""")
def answers_rekeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept answers under the request key of today: those asked with an earlier prompt get it if their pictures are the same."""
    o = B.table(spark, sf_dir, "orders")
    keys = {k: F.expr(KEY.format(f"'{k}'")) for k in ("now", "v1", "v2")}
    saved = F.when(F.col("o_orderkey") % 4 == 0, keys["now"]).when(F.col("o_orderkey") % 4 == 1, keys["v1"]).when(F.col("o_orderkey") % 4 == 2, keys["v2"]).otherwise("gone")
    answers = o.select(F.col("o_orderkey").alias("unit_key"), saved.alias("key"))
    requests = o.where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("unit_key"), keys["now"].alias("fresh"), F.array(keys["v1"], keys["v2"]).alias("legacy"))
    return merge.rekey(answers, requests, ["unit_key"])


@query()
def views_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two more views a unit beside its chosen ones: the candidates of the best score at least 6 m from all that are taken, six in all."""
    c = settled(looks.candidates(spatial.views_of(spark, sf_dir), S))  # read twice
    chosen = selection.choose_views(c, S).select("unit_id", "pano_id", "nth")
    return extra_views(c, chosen, 2, 6, S.views_apart)


def extra_views(cands: DataFrame, chosen: DataFrame, extras: int, most: int, apart: float) -> DataFrame:
    """(unit_id, n, pano_id): views beside the chosen ones (unit_id, pano_id, nth), numbered on; units without chosen views get none."""
    one = F.struct((-F.col("score")).alias("less"), F.col("pano_ord").alias("ord"), "px", "py", "pano_id")
    x = cands.join(chosen, ["unit_id", "pano_id"], "left").groupBy("unit_id").agg(F.array_sort(F.collect_list(one)).alias("c"), F.collect_list(F.when(F.col("nth").isNotNull(), one)).alias("taken"))
    x = x.where(F.size("taken") > 0).withColumn("more", selection.further(F.col("c"), F.col("taken"), extras, most, apart))
    return x.select("unit_id", F.size("taken").alias("n"), F.posexplode("more").alias("at", "k")).select("unit_id", (F.col("n") + F.col("at") + 1).alias("n"), "k.pano_id")


LINE = "concat('[[', {0}, ',0],[', {0}, ',', 10 + s_suppkey % 7, '],[', {0} + 30, ',', 10 + s_suppkey % 7, ']]')"
ROAD = f"""case s_suppkey % 5 when 0 then concat('{{"type":"MultiLineString","coordinates":[', {LINE.format('s_suppkey')}, ',', {LINE.format('s_suppkey + 100')}, ']}}') when 1 then '{{"type":"LineString","coordinates":[]}}'
 when 2 then '{{"type":"Point","coordinates":[1,2]}}' else concat('{{"type":"LineString","coordinates":', {LINE.format('s_suppkey')}, '}}') end"""


@query("""with r as (select s_suppkey, case when s_suppkey % 3 = 0 then ' ' when s_suppkey % 4 = 0 then null else concat(' ', s_name, ' ') end as name, unnest(case s_suppkey % 5 when 0 then [1, 2] when 1 then [] when 2 then [] else [1] end) as part from supplier)
select s_suppkey as road_fid, part, nullif(trim(name), '') as road_name, 3 as n_points, 40e0 + s_suppkey % 7 as length_m from r""")
def roads_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road lines from GeoJSON geometries: a row for each single line; empty ones and other shapes are dropped, names cleaned."""
    x = B.table(spark, sf_dir, "supplier").selectExpr("s_suppkey as road_fid", f"{ROAD} as geometry", "case when s_suppkey % 3 = 0 then ' ' when s_suppkey % 4 = 0 then null else concat(' ', s_name, ' ') end as name")
    roads = files.load_roads(x, "road_fid", "geometry", "name")
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.hypot(F.get("path", i).x - F.get("path", i - 1).x, F.get("path", i).y - F.get("path", i - 1).y))
    return roads.select("road_fid", "part", "road_name", F.size("path").alias("n_points"), F.aggregate(steps, F.lit(0.0), lambda a, d: a + d).alias("length_m"))
