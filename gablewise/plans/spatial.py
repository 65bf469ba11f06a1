"""Spatial queries: distance joins, containment, nearest lines, sight, camera geometry, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions import geo
from gablewise.model import Settings
from gablewise.operators import links, looks, selection, sight
from gablewise.operators.grid import boxes_within, cell, in_cells, nearest, parts, points_within
from gablewise.plans.records import NEAR_SQL, building_neighbours
from gablewise.plans.registry import query
from gablewise.sources import bindings as B

S = Settings()
PAIR = "sqrt(power(greatest(x0 - px, 0, px - x1), 2) + power(greatest(y0 - py, 0, py - y1), 2))"
PAIRS_SQL = "pairs as (select u.unit_id, u.building_id, x0, y0, x1, y1, pano_id, pano_date, pano_ord, px, py, {pair} as dist from units u join panos p on {pair} <= {d})"


def pairs_sql(d: float) -> str:
    return PAIRS_SQL.format(pair=PAIR, d=d)


@query(f"{B.with_views('units', 'panos')}, {pairs_sql(30)} select unit_id, pano_id, round_even(dist, 6) as dist from pairs")
def join_units_panos_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.max_view_dist)
    return x.select("unit_id", "pano_id", F.bround("dist", 6).alias("dist"))


@query(f"{B.with_views('units')}, {NEAR_SQL.format(50)} select building_id, other from nb")
def join_unit_neighbours_50m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return building_neighbours(B.units(spark, sf_dir), S.door_unique_radius)


@query(f"{B.with_views('units', 'panos')}, {pairs_sql(50)} select unit_id, count(*) as n, min(round_even(dist, 6)) as nearest, cast(count(*) filter (pano_date < '2025-01') as bigint) as n_old from pairs group by unit_id")
def links_within_50m(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.link_dist)
    return x.groupBy("unit_id").agg(F.count("*").alias("n"), F.min(F.bround("dist", 6)).alias("nearest"), F.count_if(F.col("pano_date") < S.old_imagery_before).alias("n_old"))


SHIFTED = "q as (select * replace (py + 9.0e0 as py) from panos)"
INSIDE = "i as (select pano_id, px, py, unit_id, ord, x0, y0, x1, y1, least(px - x0, x1 - px, py - y0, y1 - py) as depth from q join units on px > x0 and px < x1 and py > y0 and py < y1)"


@query(f"{B.with_views('units', 'panos')}, {SHIFTED}, {INSIDE} select pano_id, unit_id, round_even(depth, 6) as depth from i")
def pano_inside_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = B.panos(spark, sf_dir).withColumn("py", F.col("py") + 9.0)
    return sight.inside_rects(p, B.units(spark, sf_dir)).select("pano_id", "unit_id", F.bround("depth", 6).alias("depth"))


MOVED = """m as (select *, case when px - x0 = depth then 'w' when x1 - px = depth then 'e' when py - y0 = depth then 's' else 'n' end as side from i where depth > 0 and depth <= 2.5e0),
t as (select m.*, k, case side when 'w' then px - depth - k when 'e' then px + depth + k else px end as nx, case side when 's' then py - depth - k when 'n' then py + depth + k else py end as ny from m, (values (0.5e0), (1.0e0)) v(k)),
f as (select t.pano_id, t.ord, k, nx, ny from t where not exists (select 1 from units u where t.nx > u.x0 and t.nx < u.x1 and t.ny > u.y0 and t.ny < u.y1)),
b as (select pano_id, ord, min(k) as k from f group by all), hit as (select i.pano_id, i.ord, b.k from i left join b using (pano_id, ord)),
okay as (select pano_id, count(*) as n, count(k) as n_ok, max(ord) as last from hit group by pano_id)"""


@query(f"""{B.with_views('units', 'panos')}, {SHIFTED}, {INSIDE}, {MOVED}
select q.pano_id, o.pano_id is not null as snapped, round_even(coalesce(f.nx, q.px), 6) as px, round_even(coalesce(f.ny, q.py), 6) as py from q left join okay o on o.pano_id = q.pano_id
left join b on b.pano_id = o.pano_id and b.ord = o.last left join f on f.pano_id = b.pano_id and f.ord = b.ord and f.k = b.k where q.own and (o.pano_id is null or n = n_ok)""")
def pano_snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own panoramas; those a little inside a footprint are moved out over its nearest side, deeper ones go."""
    u, p = B.units(spark, sf_dir), B.panos(spark, sf_dir).withColumn("py", F.col("py") + 9.0)
    i = sight.inside_rects(p.select("pano_id", "px", "py"), u.select("ord", *sight.RECT))
    depth = F.col("depth")
    side = F.when(F.col("px") - F.col("x0") == depth, "w").when(F.col("x1") - F.col("px") == depth, "e").when(F.col("py") - F.col("y0") == depth, "s").otherwise("n")
    t = i.withColumn("side", side).withColumn("k", F.explode(F.when(depth <= S.snap, F.array(F.lit(0.5), F.lit(1.0)))))
    nx = F.when(F.col("side") == "w", F.col("px") - depth - F.col("k")).when(F.col("side") == "e", F.col("px") + depth + F.col("k")).otherwise(F.col("px"))
    ny = F.when(F.col("side") == "s", F.col("py") - depth - F.col("k")).when(F.col("side") == "n", F.col("py") + depth + F.col("k")).otherwise(F.col("py"))
    t = t.select("pano_id", "ord", "k", nx.alias("px"), ny.alias("py"))
    blocked = sight.inside_rects(t, u.select(*sight.RECT)).select("pano_id", "ord", "k").distinct()
    free = t.join(blocked, ["pano_id", "ord", "k"], "left_anti").groupBy("pano_id", "ord").agg(F.min(F.struct("k", "px", "py")).alias("to"))
    hits = i.select("pano_id", "ord").join(free, ["pano_id", "ord"], "left")
    hits = hits.groupBy("pano_id").agg((F.count("*") == F.count("to")).alias("fine"), F.max_by("to", "ord").alias("to"))
    x = p.where("own").join(hits, "pano_id", "left").where("fine is null or fine")
    at = lambda c: F.bround(F.coalesce(F.col(f"to.{c}"), F.col(c)), 6).alias(c)
    return x.select("pano_id", F.col("fine").isNotNull().alias("snapped"), at("px"), at("py"))


STRETCH = "st as (select road_fid, road_name, x0 as r0, y0 as s0, x1 as r1, y1 as s1 from lanes)"
TO_LINE = "(select unit_id, road_fid, sqrt(power(greatest(r0 - x1, 0, x0 - r1), 2) + power(greatest(s0 - y1, 0, y0 - s1), 2)) as dist from units, st)"


def units_to_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = B.lanes(spark, sf_dir).selectExpr("road_fid", "x0 as r0", "y0 as s0", "x1 as r1", "y1 as s1")
    return boxes_within(B.units(spark, sf_dir), lanes, S.back_lot_reach, sight.RECT, ("r0", "s0", "r1", "s1"), 60.0)


@query(f"{B.with_views('units', 'lanes')}, {STRETCH}, d as {TO_LINE}, n as (select *, row_number() over (partition by unit_id order by dist, road_fid) as nth from d where dist <= 30) select unit_id, road_fid, round_even(dist, 6) as dist from n where nth = 1")
def nearest_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(units_to_lanes(spark, sf_dir), ["unit_id"], ["dist", "road_fid"]).select("unit_id", "road_fid", F.bround("dist", 6).alias("dist"))


@query(f"{B.with_views('units', 'lanes')}, {STRETCH}, d as {TO_LINE}, n as (select *, rank() over (partition by unit_id order by round_even(dist, 6)) as nth from d where dist <= 30) select unit_id, road_fid from n where nth = 1")
def nearest_stretch_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(units_to_lanes(spark, sf_dir), ["unit_id"], [F.bround("dist", 6)], ties=True).select("unit_id", "road_fid")


@query(f"{B.with_views('units')} select unit_id, building_id from units where x0 <= 206e0 and x1 >= -6e0 and sqrt(power(greatest(-0e0 - x1, 0, x0 - 200e0), 2) + power(greatest(24e0 - y1, 0, y0 - 24e0), 2)) <= 6")
def select_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units at most 6 m from a line, of which only the first 200 m count."""
    u = B.units(spark, sf_dir)
    d = geo.rect_rect(sight.RECT, (F.lit(0.0), F.lit(24.0), F.lit(200.0), F.lit(24.0)))
    return u.where(F.col("x0").between(-1e9, 206.0) & (F.col("x1") >= -6.0) & (d <= 6)).select("unit_id", "building_id")


@query(f"{B.with_views('units')} select unit_id, building_id from units where unit_id in ('B3', 'B12', 'B77') or building_id in ('B10', 'B100', 'B3')")
def select_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units whose own id or building's id is asked for."""
    ids = ["B3", "B12", "B77", "B10", "B100"]
    asked = spark.createDataFrame([(i,) for i in ids], "id string")
    u = B.units(spark, sf_dir).select("unit_id", "building_id")
    hit = u.join(F.broadcast(asked), F.col("unit_id") == F.col("id"), "left_semi").where(F.col("unit_id").isin("B3", "B12", "B77"))
    return hit.unionByName(u.where(F.col("building_id").isin("B10", "B100", "B3"))).distinct()


@query(f"""{B.with_views('units')}, e as (select ord, x0 + (ord % 7) as x0, y0 + (ord % 5) as y0, x1 + (ord % 7) as x1, y1 + (ord % 5) as y1 from units),
o as (select e.ord, (e.x1 - e.x0) * (e.y1 - e.y0) as area, coalesce(sum(greatest(0, least(e.x1, u.x1) - greatest(e.x0, u.x0)) * greatest(0, least(e.y1, u.y1) - greatest(e.y0, u.y0))), 0) as covered
 from e left join units u on u.x0 <= e.x1 and u.x1 >= e.x0 and u.y0 <= e.y1 and u.y1 >= e.y0 group by all)
select ord, round_even(covered, 6) as covered from o where covered <= 0.2e0 * area""")
def blockers_beyond_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring footprints that aren't copies of own ones."""
    return blockers(B.units(spark, sf_dir))


@query()
def blockers_beyond_own_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under its earlier name."""
    return blockers_beyond_own(spark, sf_dir)


def blockers(u: DataFrame) -> DataFrame:
    """(ord, covered): footprints, shifted a little, of which own ones cover a fifth at most."""
    e = u.selectExpr("ord", "x0 + (ord % 7) as e0", "y0 + (ord % 5) as f0", "x1 + (ord % 7) as e1", "y1 + (ord % 5) as f1")
    box = ("e0", "f0", "e1", "f1")
    pairs = boxes_within(e, u.select(*sight.RECT), 0.0, box, sight.RECT, 32.0)
    covered = pairs.groupBy("ord").agg(F.sum(geo.overlap_area(box, sight.RECT)).alias("covered"))
    x = e.join(covered, "ord", "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))
    area = (F.col("e1") - F.col("e0")) * (F.col("f1") - F.col("f0"))
    return x.where(F.col("covered") <= S.blocker_overlap * area).select("ord", F.bround("covered", 6).alias("covered"))


#: Search points: lattice points of each unit's grown box, outside of all units and less than 40 m from one.
GRID_SQL = """ga as (select x0, y0, x1, y1, unnest(range(ceil((x0 - 40) / 5)::bigint, floor((x1 + 40) / 5)::bigint + 1)) * 5e0 as x from units), gb as (select *, unnest(range(ceil((y0 - 40) / 5)::bigint, floor((y1 + 40) / 5)::bigint + 1)) * 5e0 as y from ga),
gd as (select x, y, min(sqrt(power(greatest(x0 - x, 0, x - x1), 2) + power(greatest(y0 - y, 0, y - y1), 2))) as dist from gb group by all), gp as (select x, y from gd where dist > 0 and dist < 40)"""


@query(f"{B.with_views('units')}, {GRID_SQL} select x, y from gp")
def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search points every 5 m around all units, outside of them and less than 40 m away."""
    return points_around(B.units(spark, sf_dir), S.grid_step, S.search_radius)


def points_around(units: DataFrame, step: float, radius: float) -> DataFrame:
    """(x, y): lattice points outside all units and less than radius away from one; each unit gives those of its grown box.

    A unit goes to the cells that its grown box touches and gives each the points that are in it, so that a point's distances meet in the one
    task of its cell, and no point is shuffled. A task has the cells of some thousand units.
    """
    per = int(radius // step) * 2  # lattice lines a cell
    x = in_cells(units.select(*sight.RECT), sight.RECT, per * step, radius).drop("first_x", "first_y").repartition(parts(units, 4_000), "cell_x", "cell_y")

    def at(lo: str, hi: str, of: str) -> Column:
        a, b = F.greatest(F.ceil((F.col(lo) - radius) / step), F.col(of) * per), F.least(F.floor((F.col(hi) + radius) / step), F.col(of) * per + per - 1)
        return F.when(a <= b, F.sequence(a, b, F.lit(1).cast("long")))

    p = x.withColumn("i", F.explode(at("x0", "x1", "cell_x"))).withColumn("j", F.explode(at("y0", "y1", "cell_y")))
    p = p.withColumns({"px": F.col("i") * step, "py": F.col("j") * step})
    near = p.withColumn("dist", geo.point_rect("px", "py", *sight.RECT)).groupBy("cell_x", "cell_y", "px", "py").agg(F.min("dist").alias("dist"))
    return near.where((F.col("dist") > 0) & (F.col("dist") < radius)).select(F.col("px").alias("x"), F.col("py").alias("y"))


@query()
def grid_points_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under its earlier name."""
    return grid_points(spark, sf_dir)


SIGHT_SQL = f"""{B.with_views('units', 'panos')}, {pairs_sql(30)},
pn as (select pairs.*, greatest(8, floor(2 * (x1 - x0 + y1 - y0) / 0.5e0))::int as n from pairs), ps as (select *, 2 * (x1 - x0 + y1 - y0) / n as step, x1 - x0 as w, y1 - y0 as h from pn),
pt as (select ps.*, i::int as i, i * step as a from ps, unnest(range(n)) r(i)),
pq as (select *, case when a < w then x0 + a when a < w + h then x1 when a < w + h + w then x1 - (a - w - h) else x0 end as qx,
  case when a < w then y0 when a < w + h then y0 + (a - w) when a < w + h + w then y1 else y1 - (a - w - h - w) end as qy from pt),
pd as (select *, greatest(sqrt(power(qx - px, 2) + power(qy - py, 2)), 1e-9) as d from pq),
pe as (select *, (qx - px) * least(1, greatest(0, (d - 0.05e0) / d)) as dx, (qy - py) * least(1, greatest(0, (d - 0.05e0) / d)) as dy from pd),
nb as (select ps.unit_id, ps.pano_id, u.x0 as b0, u.y0 as b1, u.x1 as b2, u.y1 as b3 from ps join units u on u.x0 <= greatest(ps.x1, px) and u.x1 >= least(ps.x0, px) and u.y0 <= greatest(ps.y1, py) and u.y1 >= least(ps.y0, py)),
hits as (select unit_id, pano_id, i, bool_or(greatest(case when dx <> 0 then least((b0 - px) / dx, (b2 - px) / dx) when px between b0 and b2 then 0 else 2 end,
   case when dy <> 0 then least((b1 - py) / dy, (b3 - py) / dy) when py between b1 and b3 then 0 else 2 end, 0)
  <= least(case when dx <> 0 then greatest((b0 - px) / dx, (b2 - px) / dx) when px between b0 and b2 then 1 else -1 end,
   case when dy <> 0 then greatest((b1 - py) / dy, (b3 - py) / dy) when py between b1 and b3 then 1 else -1 end, 1)) as hit from pe join nb using (unit_id, pano_id) group by all),
s as (select pd.*, not hit as visible from pd join hits using (unit_id, pano_id, i))"""

RUN_SQL = """r1 as (select *, min(case when not visible then i end) over (partition by unit_id, pano_id) as hid from s), r2 as (select *, (i - coalesce(hid, 0) + n) % n as pos from r1),
r3 as (select *, sum((not visible)::int) over (partition by unit_id, pano_id order by pos) as run from r2), r4 as (select *, count(*) over (partition by unit_id, pano_id, run) as run_n, min(pos) over (partition by unit_id, pano_id, run) as run_at from r3 where visible),
r5 as (select *, first_value(run) over (partition by unit_id, pano_id order by run_n desc, run_at) as best from r4), r as (select * from r5 where run = best),
b1 as (select *, ((degrees(atan2(qx - px, qy - py)) % 360) + 360) % 360 as bear from r),
b2 as (select *, ((degrees(atan2(avg(sin(radians(bear))) over p, avg(cos(radians(bear))) over p)) % 360) + 360) % 360 as mid from b1 window p as (partition by unit_id, pano_id)),
b3 as (select *, (((bear - mid + 180) % 360) + 360) % 360 - 180 as off from b2),
c1 as (select unit_id, pano_id, pano_ord, count(*) as m, min(d) as near, min(mid) as mid, min(step) as step, min(off) as lo, max(off) as hi,
  arg_min(struct_pack(x := qx, y := qy), struct_pack(a := round(off, 9), b := pos)) as l, arg_max(struct_pack(x := qx, y := qy), struct_pack(a := round(off, 9), b := -pos)) as rr from b3 group by all),
c2 as (select *, round_even(m * step, 2) as visible_m, round_even(hi - lo, 2) as span_deg, round_even(near, 2) as dist_near,
  round_even(abs((rr.x - l.x) * cos(radians(mid)) - (rr.y - l.y) * sin(radians(mid))), 2) as apparent_m from c1),
c as (select *, round_even((1 - least(0.8e0, 0.10e0 * greatest(0, 6 - dist_near) + 0.05e0 * greatest(0, dist_near - 18)))::decimal(30, 15), 2)::double as quality from c2 where visible_m >= 3 and span_deg between 12 and 120 and dist_near >= 1.5e0)"""


def views_of(spark: SparkSession, sf_dir: str, points: bool = False) -> DataFrame:
    """What each panorama within reach sees of each unit, perhaps point by point."""
    units = B.units(spark, sf_dir)
    return sight.outline_looks(sight.sight_pairs(units, B.panos(spark, sf_dir), S.max_view_dist), units, S, points=points)


@query(f"{SIGHT_SQL} select unit_id, pano_id, min(n) as n_points, count(*) filter (visible) as n_visible from s group by all")
def los_visible_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views_of(spark, sf_dir, True).select("unit_id", "pano_id", F.col("n").alias("n_points"), F.size(F.filter("visible", lambda v: v)).cast("long").alias("n_visible"))


#: Quality in hundredths from whole numbers, and the score with it.
SCORE_SQL = """h1 as (select *, 10000 - least(8000, 10 * greatest(0, 600 - round(dist_near * 100)::bigint) + 5 * greatest(0, round(dist_near * 100)::bigint - 1800)) as n from c),
h2 as (select *, n // 100 + case when 2 * (n % 100) > 100 or 2 * (n % 100) = 100 and (n // 100) % 2 = 1 then 1 else 0 end as q from h1), h3 as (select *, round(apparent_m * 100)::bigint * q as m2 from h2),
h as (select * replace (q / 100e0 as quality), (m2 // 100 + case when 2 * (m2 % 100) > 100 or 2 * (m2 % 100) = 100 and (m2 // 100) % 2 = 1 then 1 else 0 end) / 100e0 as score from h3)"""


@query(f"{SIGHT_SQL}, {RUN_SQL}, {SCORE_SQL} select unit_id, pano_id, visible_m, span_deg, dist_near, apparent_m, quality, score from h")
def los_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each camera sees, how good the view is, and its score."""
    c = looks.candidates(views_of(spark, sf_dir), S)
    return c.select("unit_id", "pano_id", "visible_m", "span_deg", "dist_near", "apparent_m", "quality", "score")


@query(f"""{SIGHT_SQL}, {RUN_SQL}, k as (select unit_id, count(*) as n, min(dist_near) as near from c group by unit_id)
select unit_id, case when n is null then 'not visible' when near > 15 then 'not street-facing' else 'street-facing' end as access, coalesce(n, 0) as n_candidates from units left join k using (unit_id)""")
def access_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = looks.candidates(views_of(spark, sf_dir), S)
    return sight.access_class(B.units(spark, sf_dir), c, S)


@query()
def views_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.choose_views(looks.candidates(views_of(spark, sf_dir), S), S)


@query()
def links_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four panoramas a unit, the nearest first, on different sides of it if there are."""
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.link_dist)
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    one = F.struct(F.bround("dist", 6).alias("dist"), F.col("pano_ord").alias("ord"), geo.bearing(cx, cy, "px", "py").alias("side"), "pano_id", "pano_date")
    # of a third of all panoramas at one place, a unit still needs its candidates only: those within reach
    lists = x.groupBy("unit_id").agg(F.array_sort(F.collect_list(one)).alias("cands"))
    chosen = lists.select("unit_id", F.posexplode(selection.spread(F.col("cands"), S.max_links, S.link_sector)).alias("at", "c"))
    return chosen.select("unit_id", (F.col("at") + 1).alias("n"), "c.pano_id", "c.dist", geo.compass(F.col("c.side")).alias("side"))


CAM = "cam as (select unit_id, pano_id, px, py, x0, y0, x1, y1, dist, ((degrees(atan2(x0 - px, y0 - py)) % 360) + 360) % 360 as bl, ((degrees(atan2(x1 - px, y0 - py)) % 360) + 360) % 360 as br, storeys from pairs join (select unit_id, storeys from units) using (unit_id) where dist >= 1.5e0)"
REL = "((({0} - {1} + 180) % 360) + 360) % 360 - 180"
MID = f"((bl + ((({REL.format('br', 'bl')}) % 360) + 360) % 360 / 2) % 360 + 360) % 360"


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the bearings of the lower wall's ends."""
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.max_view_dist).where("dist >= 1.5")
    return x.withColumns({"bl": geo.bearing("px", "py", "x0", "y0"), "br": geo.bearing("px", "py", "x1", "y0")})


@query(f"""{B.with_views('units', 'panos')}, {pairs_sql(30)}, {CAM}, m as (select *, {MID} as mid, {REL.format('br', 'bl')} as span, greatest(12e0, (storeys + 1) * 3.2e0) as height, greatest(dist, 1) as d from cam),
t as (select *, degrees(atan((height - 2.5e0) / d)) as top, degrees(atan(-2.5e0 / d)) as bottom from m), f as (select *, least(120, greatest(40, abs(span) + 16, top - bottom + 6)) as fov from t)
select unit_id, pano_id, round_even(mid, 2) as heading, round_even(fov, 1) as fov, round_even(case when top - bottom + 6 > 120 then top - fov / 2 + 3 else (top + bottom) / 2 end, 1) as pitch, height,
 round_even(least(45, greatest(25, abs(span) + 6)), 1) as zoom_fov from f""")
def camera_aim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cameras(spark, sf_dir)
    span = F.abs(geo.relative(F.col("br"), F.col("bl")))
    c = c.select("unit_id", "pano_id", geo.aim(span, F.col("dist"), F.col("bl"), F.col("br"), F.col("storeys"), S.camera_height).alias("a"), geo.aim_zoom(span, F.col("bl"), F.col("br")).alias("z"))
    return c.select("unit_id", "pano_id", "a.heading", "a.fov", "a.pitch", "a.height", F.col("z.fov").alias("zoom_fov"))


SHIFTS = ", ".join(f"{REL.format(f'((degrees(atan2({x} - (px + ({s}) * tx), y0 - (py + ({s}) * ty))) % 360) + 360) % 360', 'bl')} as {n}{i}" for n, x in (("l", "x0"), ("r", "x1")) for i, s in enumerate(("-2e0", "0e0", "2e0")))


@query(f"""{B.with_views('units', 'panos')}, {pairs_sql(30)}, {CAM}, m as (select *, cos(radians({MID})) as tx, -sin(radians({MID})) as ty from cam), k as (select unit_id, pano_id, bl, {SHIFTS} from m),
e as (select *, greatest(l0, l1, l2) as lo, least(r0, r1, r2) as hi from k) select unit_id, pano_id, hi > lo as core_ok,
 case when hi > lo then round_even((((bl + lo) % 360) + 360) % 360, 4) end as core_left, case when hi > lo then round_even((((bl + hi) % 360) + 360) % 360, 4) end as core_right from e""")
def core_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cameras(spark, sf_dir)
    core = geo.core_span(*[F.col(k) for k in ("px", "py", "x0", "y0", "x1", "y0", "bl", "br")], S.position_error)
    c = c.select("unit_id", "pano_id", core.alias("c"))
    return c.select("unit_id", "pano_id", F.col("c").isNotNull().alias("core_ok"), F.bround("c.left", 4).alias("core_left"), F.bround("c.right", 4).alias("core_right"))


@query(f"""{B.with_views('units', 'panos')}, {pairs_sql(30)}, {CAM}, a as (select *, radians({REL.format('br', MID)}) as delta, radians(8e0) as p, sqrt(power(x1 - px, 2) + power(y0 - py, 2)) as far from cam),
g as (select *, far * sin(delta) as gx, far * cos(delta) as gy from a), k as (select *, gy * cos(p) + 3e0 * sin(p) as depth, 3e0 * cos(p) - gy * sin(p) as up from g)
select unit_id, pano_id, case when depth > 0.05e0 then round_even(320 + 320 / tan(radians(80e0) / 2) * gx / depth, 3) end as px, case when depth > 0.05e0 then round_even(320 - 320 / tan(radians(80e0) / 2) * up / depth, 3) end as py from k""")
def pixel_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the wall's right end, 3 m above the camera, lands in a picture aimed at the wall's middle."""
    c = cameras(spark, sf_dir)
    far = F.hypot(F.col("x1") - F.col("px"), F.col("y0") - F.col("py"))
    p = geo.project(geo.relative(F.col("br"), geo.middle(F.col("bl"), F.col("br"))), far, F.lit(3.0), F.lit(80.0), F.lit(8.0), S.image_px)
    return c.select("unit_id", "pano_id", p.alias("p")).select("unit_id", "pano_id", F.bround("p.px", 3).alias("px"), F.bround("p.py", 3).alias("py"))


@query(f"""{B.with_views('units', 'panos')}, {pairs_sql(50)}, c as (select unit_id, pano_id, dist, pano_date, ((degrees(atan2(px - (x0 + x1) / 2, py - (y0 + y1) / 2)) % 360) + 360) % 360 as side,
 row_number() over (partition by unit_id order by round_even(dist, 6), pano_ord) as nth from pairs)
select unit_id, pano_id, concat(round_even(dist, 0)::int, ' m, from ', (['N','NE','E','SE','S','SW','W','NW'])[(floor((side + 22.5e0) / 45)::int % 8) + 1], ', ', pano_date) as label from c where nth = 1""")
def link_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest panorama of each unit, with its distance, side and date in words."""
    x = points_within(B.units(spark, sf_dir), B.panos(spark, sf_dir), S.link_dist)
    best = nearest(x, ["unit_id"], [F.bround("dist", 6), "pano_ord"])
    side = geo.compass(geo.bearing((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, "px", "py"))
    return best.select("unit_id", "pano_id", F.format_string("%d m, from %s, %s", F.rint("dist").cast("int"), side, "pano_date").alias("label"))


@query(f"""{B.with_views('panos')}, k as (select pano_id, px, py, round_even(px % 360, 1) as heading, least(100, 60e0 + pano_ord % 60) as fov, (pano_ord % 30) / 2e0 as pitch from panos)
select pano_id, concat('https://www.google.com/maps/@?api=1&map_action=pano&pano=', pano_id, '&heading=', heading, '&pitch=', pitch, '&fov=', fov, case when pano_id like '%5' then '' else printf('&viewpoint=%.7f,%.7f', 11 + py / 1e5, 76.9e0 + px / 1e5) end) as url from k""")
def viewer_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to a viewer of panoramas, with the camera's place where it is known; the field of view is at most 100."""
    p = B.panos(spark, sf_dir)
    place = F.struct((11 + F.col("py") / 1e5).alias("lat"), (76.9 + F.col("px") / 1e5).alias("lon"))
    look = (F.bround(F.col("px") % 360, 1), 60.0 + F.col("pano_ord") % 60, (F.col("pano_ord") % 30) / 2)
    return p.select("pano_id", F.when(F.col("pano_id").endswith("5"), links.viewer_url(F.col("pano_id"), *look)).otherwise(links.viewer_url(F.col("pano_id"), *look, place)).alias("url"))


def _sum_sql(start: str, coefficients, sign: str, term: str) -> str:
    return start + "".join(f" {sign} {c!r} * ({term.format(k=2 * j)})" for j, c in enumerate(coefficients, 1))


DEGREES_SQL = f"""dm as (select unit_id, (x0 + x1) / 2 + 711679.6e0 as x, (y0 + y1) / 2 + 1219908.4e0 as y from units), du as (select *, y / {geo.SCALE * geo.RADIUS!r} as u, (x - 500000) / {geo.SCALE * geo.RADIUS!r} as v from dm),
dv as (select *, {_sum_sql('u', geo.TO_SPHERE, '-', 'sin(u * {k}) * cosh(v * {k})')} as u1, {_sum_sql('v', geo.TO_SPHERE, '-', 'cos(u * {k}) * sinh(v * {k})')} as v1 from du),
dw as (select *, asin(sin(u1) / cosh(v1)) as w from dv), dd as (select unit_id, x, y, degrees({_sum_sql('w', geo.TO_LATITUDE, '+', 'sin(w * {k})')}) as lat, degrees(atan2(sinh(v1), cos(u1))) + 75 as lon from dw)"""


@query(f"{B.with_views('units')}, {DEGREES_SQL} select unit_id, round_even(lat, 7) as lat, round_even(lon, 7) as lon from dd")
def degrees_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latitude and longitude of each unit's middle, with the metric origin at a place of UTM zone 43."""
    d = unit_degrees(spark, sf_dir)
    return d.select("unit_id", F.bround("d.lat", 7).alias("lat"), F.bround("d.lon", 7).alias("lon"))


def unit_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = B.units(spark, sf_dir)
    return u.select("unit_id", geo.utm_to_degrees((F.col("x0") + F.col("x1")) / 2 + 711679.6, (F.col("y0") + F.col("y1")) / 2 + 1219908.4).alias("d"))


@query(f"{B.with_views('units')}, {DEGREES_SQL} select unit_id, round_even(x, 3) as x, round_even(y, 3) as y from dd")
def metres_of_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metres of each unit's middle again, from its latitude and longitude; in the SQL those that it started from."""
    m = unit_degrees(spark, sf_dir).select("unit_id", geo.degrees_to_utm(F.col("d.lat"), F.col("d.lon")).alias("m"))
    return m.select("unit_id", F.bround("m.x", 3).alias("x"), F.bround("m.y", 3).alias("y"))


@query(f"""{B.with_views('units', 'panos')}, p as (select *, row_number() over (partition by floor(px / 10e0), floor(py / 10e0) order by pano_ord desc) as nth from panos)
select floor(px / 10e0)::bigint as cell_x, floor(py / 10e0)::bigint as cell_y, pano_id from p where nth = 1""")
def panos_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the panoramas that meet in a cell, the last in order."""
    p = B.panos(spark, sf_dir).select(cell("px", 10).alias("cell_x"), cell("py", 10).alias("cell_y"), "pano_id", "pano_ord")
    return p.groupBy("cell_x", "cell_y").agg(F.max_by("pano_id", "pano_ord").alias("pano_id"))


@query(f"""{B.with_views('units')}, n as (select a.unit_id, b.unit_id as other, row_number() over (partition by a.unit_id order by round_even(sqrt(power(greatest(b.x0 - a.x1, 0, a.x0 - b.x1), 2) + power(greatest(b.y0 - a.y1, 0, a.y0 - b.y1), 2)), 6), b.ord) as nth
 from units a join units b on a.unit_id <> b.unit_id and b.x0 <= a.x1 + 25 and b.x1 >= a.x0 - 25 and b.y0 <= a.y1 + 25 and b.y1 >= a.y0 - 25)
select unit_id, string_agg(concat(chr(64 + nth::int), '=', other), ' ' order by nth) as letters from n where nth <= 12 group by unit_id""")
def neighbour_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve nearest neighbours whose bounds meet a unit's, grown by 25 m, by letters."""
    return letters(B.units(spark, sf_dir), 25.0, 12)


def letters(units: DataFrame, reach: float, most: int) -> DataFrame:
    other = units.selectExpr("unit_id as other", "ord as other_ord", "x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    x = boxes_within(units, other, reach * 2**0.5 + 1e-6, sight.RECT, ("u0", "v0", "u1", "v1"), 2 * reach).where("unit_id <> other")
    x = x.where((F.col("u0") <= F.col("x1") + reach) & (F.col("u1") >= F.col("x0") - reach) & (F.col("v0") <= F.col("y1") + reach) & (F.col("v1") >= F.col("y0") - reach))
    w = W.partitionBy("unit_id").orderBy(F.bround("dist", 6), "other_ord")
    x = x.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)
    one = F.struct("nth", F.concat(F.char(64 + F.col("nth")), F.lit("="), "other").alias("t"))
    return x.groupBy("unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda s: s.t), " ").alias("letters"))
