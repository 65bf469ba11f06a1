"""Queries over roads with bends in any direction, made from the rows of units: nearest roads, gaps, pictures, who belongs where, canonical names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.functions.text import name_key, norm_zone
from gablewise.model import Settings
from gablewise.operators import leaders, looks, network, selection, shapes, sight
from gablewise.plans.outlines import EDGES_SQL, SIGN, mm, outline_looks, outlines
from gablewise.plans.records import building_roads, main_value
from gablewise.plans.registry import query
from gablewise.sources import bindings as B
from gablewise.sources.files import settled

S = Settings()
#: Lanes pass some houses of a row of forty, cross roads one of each row, 25 rows a road; they take their name from their first house.
LANE, CROSS = "p_partkey % 40 in (0, 9, 19, 29, 39)", "p_partkey % 40 in (10, 25)"
LANE_X, LANE_Y = "(p_partkey % 40) * 14.0e0 - 2.0e0 + p_size % 3", "floor(p_partkey / 40.0e0) * 24.0e0 + p_size % 4"
CROSS_X, CROSS_Y = "(p_partkey % 40) * 14.0e0 - 3.0e0 + p_size % 2", "floor(p_partkey / 40.0e0) * 24.0e0 + 2.0e0"
LANE_ID, CROSS_ID = "cast(floor(p_partkey / 40.0e0) as bigint)", "cast(1000000000 + floor(p_partkey / 1000.0e0) * 40 + p_partkey % 40 as bigint)"


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(road_fid, road_name, path)"""
    p = B.table(spark, sf_dir, "part")
    points = [p.where(w).selectExpr(f"{i} as road_fid", "p_partkey", "p_name", f"{x} as x", f"{y} as y") for w, i, x, y in ((LANE, LANE_ID, LANE_X, LANE_Y), (CROSS, CROSS_ID, CROSS_X, CROSS_Y))]
    every = points[0].unionByName(points[1]).groupBy("road_fid").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "x", "y"))).alias("p"), F.min_by("p_name", "p_partkey").alias("name"))
    return every.select("road_fid", F.concat("name", F.lit(" road")).alias("road_name"), F.transform("p", lambda q: F.struct(q.x.alias("x"), q.y.alias("y"))).alias("path"))


ROADS_SQL = f"""rp as (select {LANE_ID} as road_fid, p_partkey, p_name, {LANE_X} as x, {LANE_Y} as y from part where {LANE} union all select {CROSS_ID}, p_partkey, p_name, {CROSS_X}, {CROSS_Y} from part where {CROSS}),
rs as (select * from (select road_fid, row_number() over w as k, x as ax, y as ay, lead(x) over w as fx, lead(y) over w as fy from rp window w as (partition by road_fid order by p_partkey)) where fx is not null)"""


def to_segment(px: str, py: str, a: str, b: str, c: str, d: str) -> str:
    """Distance of a point from a segment."""
    t = f"least(1, greatest(0, (({px} - {a}) * ({c} - {a}) + ({py} - {b}) * ({d} - {b})) / greatest(({c} - {a}) * ({c} - {a}) + ({d} - {b}) * ({d} - {b}), 1e-18)))"
    return f"sqrt(power({a} + ({c} - {a}) * {t} - {px}, 2) + power({b} + ({d} - {b}) * {t} - {py}, 2))"


def touch_sql(p: str, q: str, a: str, b: str) -> str:
    """Do two segments, given by the names of their ends in whole millimetres, have a point in common?"""
    (px, py), (qx, qy), (ax, ay), (bx, by) = ((f"i{e}x", f"i{e}y") for e in (p, q, a, b))
    near = f"least({px}, {qx}) <= greatest({ax}, {bx}) and greatest({px}, {qx}) >= least({ax}, {bx}) and least({py}, {qy}) <= greatest({ay}, {by}) and greatest({py}, {qy}) >= least({ay}, {by})"
    return f"{near} and {SIGN.format(px, py, qx, qy, ax, ay)} * {SIGN.format(px, py, qx, qy, bx, by)} <= 0 and {SIGN.format(ax, ay, bx, by, px, py)} * {SIGN.format(ax, ay, bx, by, qx, qy)} <= 0"


NEAREST_SQL = f"""un as (select bd.unit_id, road_fid, k, ax as cx, ay as cy, fx as dx, fy as dy from bd join rs on least(ax, fx) <= hi_x + 30 and greatest(ax, fx) >= lo_x - 30 and least(ay, fy) <= hi_y + 30 and greatest(ay, fy) >= lo_y - 30),
ue as (select un.unit_id, road_fid, un.k, cx, cy, dx, dy, ax, ay, ex, ey, {mm('cx', 'cy', 'dx', 'dy', 'ax', 'ay', 'ex', 'ey')} from un join ed on ed.unit_id = un.unit_id),
us as (select unit_id, road_fid, k, min(case when {touch_sql('c', 'd', 'a', 'e')} then 0e0 else least({to_segment('cx', 'cy', 'ax', 'ay', 'ex', 'ey')}, {to_segment('dx', 'dy', 'ax', 'ay', 'ex', 'ey')}, {to_segment('ax', 'ay', 'cx', 'cy', 'dx', 'dy')}, {to_segment('ex', 'ey', 'cx', 'cy', 'dx', 'dy')}) end) as dist,
 count(*) filter ((ay > cy) <> (ey > cy) and cx < (ex - ax) * (cy - ay) / (ey - ay) + ax) % 2 = 1 as is_in from ue group by all),
ud as (select unit_id, road_fid, min(case when is_in then 0e0 else dist end) as dist from us group by all having dist <= 30)"""


@query(f"""{EDGES_SQL}, {ROADS_SQL}, {NEAREST_SQL}, nt as (select *, row_number() over (partition by unit_id order by round_even(dist, 6), road_fid) as nth from ud) select unit_id, road_fid, round_even(dist, 6) as dist from nt where nth = 1""")
def bent_nearest_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The road nearest to each unit's outline, at most 30 m away."""
    near = network.roads_near(outlines(spark, sf_dir), roads(spark, sf_dir), "unit_id", "road_fid", S.back_lot_reach)
    return network.nearest_roads(near, ["unit_id"], "road_fid", ties=False).select("unit_id", "road_fid", F.bround("dist", 6).alias("dist"))


@query(f"""{EDGES_SQL}, {ROADS_SQL}, pr as (select pano_id, road_fid, min({to_segment('px', 'py', 'ax', 'ay', 'fx', 'fy')}) as dist from panos join rs on px between least(ax, fx) - 15 and greatest(ax, fx) + 15 and py between least(ay, fy) - 15 and greatest(ay, fy) + 15 group by all having dist <= 15),
nt as (select *, rank() over (partition by pano_id order by round_even(dist, 6)) as nth from pr) select pano_id, road_fid, round_even(dist, 6) as dist from nt where nth = 1""")
def bent_pano_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roads nearest to each panorama, at most 15 m away, all of them if several are equally near."""
    near = network.roads_near_points(B.panos(spark, sf_dir).select("pano_id", "px", "py"), roads(spark, sf_dir), ["pano_id"], "road_fid", S.camera_reach)
    return network.nearest_roads(near, ["pano_id"], "road_fid", ties=True).select("pano_id", "road_fid", F.bround("dist", 6).alias("dist"))


ALONG_SQL = """rm as (select *, sqrt((fx - ax) * (fx - ax) + (fy - ay) * (fy - ay)) as m from rs), rc as (select *, list_reduce(list_prepend(0e0, list(m) over (partition by road_fid order by k)), lambda s, v: s + v) as b from rm),
rl as (select *, coalesce(lag(b) over (partition by road_fid order by k), 0e0) as a, max(b) over (partition by road_fid) as len, k = max(k) over (partition by road_fid) as last from rc), rt as (select distinct road_fid, len from rl)"""


def at_sql(name: str, source: str, at: str, keep: str) -> str:
    """The point of each row's road at a distance along it."""
    return f"{name} as (select {keep}, ax + (fx - ax) * (({at} - a) / greatest(b - a, 1e-12)) as x, ay + (fy - ay) * (({at} - a) / greatest(b - a, 1e-12)) as y from {source} s join rl on rl.road_fid = s.road_fid and {at} >= a and ({at} < b or last))"


GAPS_SQL = f"""ga as (select road_fid, len, n::int as n, 5e0 + n * 10e0 as d from rt, unnest(range(greatest(0, ceil((len - 5e0) / 10e0)::int))) r(n)),
{at_sql('gp', 'ga', 'd', 's.road_fid, n')}, {at_sql('gb', 'ga', 'greatest(0e0, d - 1)', 's.road_fid, n')}, {at_sql('go', 'ga', 'least(s.len, d + 1)', 's.road_fid, n')},
gd as (select gp.road_fid, gp.n, gp.x as px, gp.y as py, go.x - gb.x as dx, go.y - gb.y as dy from gp join gb using (road_fid, n) join go using (road_fid, n)),
gm as (select *, sqrt(dx * dx + dy * dy) as m from gd), gn as (select road_fid, n, px, py, dx / m as tx, dy / m as ty from gm where m > 0),
gr as (select road_fid, n, way, px, py, px - ty * way * 25e0 as qx, py + tx * way * 25e0 as qy from gn, (values (1), (-1)) v(way)),
ge as (select road_fid, n, way, px, py, qx, qy, ax, ay, ex, ey, {mm('px', 'py', 'qx', 'qy', 'ax', 'ay', 'ex', 'ey')}
 from gr join bd on lo_x <= greatest(px, qx) and hi_x >= least(px, qx) and lo_y <= greatest(py, qy) and hi_y >= least(py, qy) join ed on ed.unit_id = bd.unit_id),
gh as (select road_fid, n, way, coalesce(((ax - px) * (ey - ay) - (ay - py) * (ex - ax)) / nullif((qx - px) * (ey - ay) - (qy - py) * (ex - ax), 0),
 least(((ax - px) * (qx - px) + (ay - py) * (qy - py)) / 625e0, ((ex - px) * (qx - px) + (ey - py) * (qy - py)) / 625e0)) as part from ge where {touch_sql('p', 'q', 'a', 'e')}),
gw as (select road_fid, n, bd.unit_id from gn join bd on px between lo_x and hi_x and py between lo_y and hi_y join ed on ed.unit_id = bd.unit_id group by all having count(*) filter ((ay > py) <> (ey > py) and px < (ex - ax) * (py - ay) / (ey - ay) + ax) % 2 = 1),
gs as (select road_fid, n, way, min(dist) as dist from (select road_fid, n, way, least(1, greatest(0, part)) * 25e0 as dist from gh union all select road_fid, n, way, 0e0 from gw, (values (1), (-1)) v(way)) group by all),
gg as (select road_fid, n, sum(dist) as gap from gs group by all having count(*) = 2)"""


@query(f"{EDGES_SQL}, {ROADS_SQL}, {ALONG_SQL}, {GAPS_SQL} select road_fid, count(*) as samples, count(gap) as both, round_even(median(gap), 1) as median_m, round_even(min(gap), 1) as min_m from gn left join gg using (road_fid, n) group by road_fid")
def bent_gap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between the fronts along bent roads, by rays at right angles to them."""
    return network.front_gaps(roads(spark, sf_dir), "road_fid", outlines(spark, sf_dir), S.gap_step, S.gap_reach)


def bent_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lanes with a bend in the middle, and the cross roads."""
    lanes = B.lanes(spark, sf_dir)
    point = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    bend = F.when(F.col("y0") == F.col("y1"), F.array(point("x0", "y0"), point("(x0 + x1) / 2", "y0 + 6"), point("x1", "y1"))).otherwise(F.array(point("x0", "y0"), point("x1", "y1")))
    return lanes.select("road_fid", "road_name", bend.alias("path"))


BENT_SQL = f"""bp as (select road_fid, road_name, unnest(case when y0 = y1 then [struct_pack(k := 1, x := x0, y := y0), struct_pack(k := 2, x := (x0 + x1) / 2, y := y0 + 6), struct_pack(k := 3, x := x1, y := y1)] else [struct_pack(k := 1, x := x0, y := y0), struct_pack(k := 2, x := x1, y := y1)] end) as p from lanes),
rs as (select * from (select road_fid, road_name, p.k as k, p.x as ax, p.y as ay, lead(p.x) over w as fx, lead(p.y) over w as fy from bp window w as (partition by road_fid order by p.k)) where fx is not null), {ALONG_SQL},
xs as (select s.road_fid, s.a, s.b, ((o.ax - s.ax) * (o.fy - o.ay) - (o.ay - s.ay) * (o.fx - o.ax)) / nullif((s.fx - s.ax) * (o.fy - o.ay) - (s.fy - s.ay) * (o.fx - o.ax), 0) as t,
 ((o.ax - s.ax) * (s.fy - s.ay) - (o.ay - s.ay) * (s.fx - s.ax)) / nullif((s.fx - s.ax) * (o.fy - o.ay) - (s.fy - s.ay) * (o.fx - o.ax), 0) as u from rl s join rl o on o.road_fid <> s.road_fid),
xc as (select distinct road_fid, a + t * (b - a) as cut from xs where t between 0 and 1 and u between 0 and 1),
xk as (select c.road_fid, cut from xc c join rt using (road_fid) where cut > 1 and cut < len - 1 union all select road_fid, 0e0 from rt union all select road_fid, len from rt),
xp as (select road_fid, cut as d0, lead(cut) over (partition by road_fid order by cut) as d1, (row_number() over (partition by road_fid order by cut) - 1)::int as n from xk), xq as (select * from xp where d1 - d0 >= 10),
{at_sql('za', 'xq', 'd0', 's.road_fid, n')}, {at_sql('zb', 'xq', 'd1', 's.road_fid, n')}, {at_sql('zm', 'xq', '((d0 + d1) / 2)', 's.road_fid, n')},
zz as (select q.road_fid, q.n, d0, d1, struct_pack(x := round_even(za.x, 0)::bigint, y := round_even(za.y, 0)::bigint) as p, struct_pack(x := round_even(zb.x, 0)::bigint, y := round_even(zb.y, 0)::bigint) as q, round_even(zm.x, 0)::bigint as mx, round_even(zm.y, 0)::bigint as my
 from xq q join za on za.road_fid = q.road_fid and za.n = q.n join zb on zb.road_fid = q.road_fid and zb.n = q.n join zm on zm.road_fid = q.road_fid and zm.n = q.n),
zi as (select *, concat('S', left(sha1(concat('[(', least(p, q).x, ', ', least(p, q).y, '), (', greatest(p, q).x, ', ', greatest(p, q).y, ')]|', mx, ',', my)), 6)) as stretch_id, (select count(*) from rl where rl.road_fid = zz.road_fid and rl.b > d0 and rl.b < d1) as bends from zz),
zn as (select *, row_number() over (partition by stretch_id order by road_fid, n) as nth from zi)"""


@query(f"{B.with_views('lanes')}, {BENT_SQL} select stretch_id, zn.road_fid, road_name, n, (2 + bends)::int as n_points, round_even(d1 - d0, 1) as length_m from zn join (select distinct road_fid, road_name from rs) using (road_fid) where nth = 1")
def bent_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads with bends split at their junctions."""
    roads = bent_roads(spark, sf_dir)
    x = shapes.split_paths(roads, shapes.path_cuts(roads, S.junction), S.junction, S.min_stretch)
    return x.select("stretch_id", "road_fid", "road_name", "n", F.size("path").alias("n_points"), "length_m")


PICTURES_SQL = f"""pk as (select *, greatest(1, round_even(len / 50, 0))::int as m from rt), pd as (select road_fid, len, n::int as n, (n - 0.5e0) * len / m as d from pk, unnest(range(1, m + 1)) r(n)),
{at_sql('pp', 'pd', 'd', 's.road_fid, n, d')}, {at_sql('pb', 'pd', 'greatest(0e0, d - 2)', 's.road_fid, n')}, {at_sql('po', 'pd', 'least(s.len, d + 2)', 's.road_fid, n')},
pt as (select pp.road_fid, pp.n, pp.d, pp.x, pp.y, ((degrees(atan2(po.x - pb.x, po.y - pb.y)) % 360) + 360) % 360 as heading from pp join pb using (road_fid, n) join po using (road_fid, n))"""


@query(f"{EDGES_SQL}, {ROADS_SQL}, {ALONG_SQL}, {PICTURES_SQL} select road_fid, n, round_even(d, 1) as along_m, round_even(x, 3) as x, round_even(y, 3) as y, round_even(heading, 1) as heading from pt")
def bent_picture_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picture points along bent roads, with the way the road goes there."""
    p = network.picture_points(roads(spark, sf_dir), "road_fid", S.picture_step)
    return p.select("road_fid", "n", "along_m", F.bround("x", 3).alias("x"), F.bround("y", 3).alias("y"), "heading")


@query()
def bent_picture_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each picture point of a bent road in turn the newest, then nearest panorama on this road that no earlier point took; null if there is none."""
    return network.choose_pictures(roads(spark, sf_dir), B.panos(spark, sf_dir), "road_fid", S)


@query()
def bent_units_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The road of each unit of any outline: of its closest view's camera, or of its footprint, or that of its address."""
    u, c = outlines(spark, sf_dir), settled(looks.candidates(outline_looks(spark, sf_dir), S))  # read three times
    access = sight.access_class(B.units(spark, sf_dir), c, S).select("unit_id", "access")
    views = selection.choose_views(c, S).join(c.select("unit_id", "pano_id", "px", "py", "dist_near"), ["unit_id", "pano_id"])
    r = roads(spark, sf_dir)
    return network.assign_units(u, access, views, r, r.select("road_fid", F.col("road_name").alias("name")), "road_fid", S.camera_reach, S.back_lot_reach)


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with the name of their street as it is written there: every fiftieth lost a letter, every seventieth has one twice over with another."""
    u, key = B.units(spark, sf_dir), name_key(F.col("road"))
    lost = F.concat(F.substring(key, 1, 4), F.substring(key, F.lit(6), F.length(key)))
    more = F.concat(F.substring(key, 1, 3), F.lit("x"), F.substring(key, F.lit(4), F.length(key)))
    return u.withColumn("name", F.when(F.col("ord") % 50 == 0, lost).when(F.col("ord") % 70 == 3, more).otherwise(F.col("road")))


@query()
def street_names_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name key under which each street name is known: its own, or that of the first earlier one which it is like."""
    return leaders.canonical_keys(spelled(spark, sf_dir).select("name", "ord"))


@query()
def zone_main_by_named_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main zone of each street with all its spellings, and its share of the assessments there that have one."""
    u = spelled(spark, sf_dir)
    canon = leaders.canonical_keys(u.select("name", "ord"))
    of = building_roads(u.select("building_id", F.col("name").alias("road"), "ord")).withColumn("key", name_key(F.col("road"))).join(canon, "key").select("building_id", "canon")
    z = B.assess(spark, sf_dir).join(of, "building_id").select("canon", "ord", norm_zone(F.col("zone_raw")).alias("zone"))
    m = main_value(z, "canon", "zone", "ord")
    return m.select("canon", "zone", "n", F.bround(F.col("n") / F.col("total"), 2).alias("share"))
