"""Queries over footprints of any outline, rotated and concave, and over roads with bends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import links, looks, outlook, overlap, selection, shapes, sight
from gablewise.plans.registry import query
from gablewise.plans.spatial import RUN_SQL, SCORE_SQL
from gablewise.sources import bindings as B

S = Settings()
#: What classes of views need nothing of.
POINTS = ("qx", "qy", "visible", "good", "cos")
#: Each unit as an L, turned about its middle by the angle of a 3-4-5 triangle if its number is odd: corners from the middle. Every fourth is drawn clockwise.
CORNERS = [(-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1)]


def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """units with their outline as ring."""
    u = B.units(spark, sf_dir)
    cx, cy, hx, hy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, (F.col("x1") - F.col("x0")) / 2, (F.col("y1") - F.col("y0")) / 2

    def corner(i: int, j: int) -> Column:
        a, b, odd = hx * i, hy * j, F.col("ord") % 2 == 1
        return F.struct((cx + F.when(odd, a * 0.8 - b * 0.6).otherwise(a)).alias("x"), (cy + F.when(odd, a * 0.6 + b * 0.8).otherwise(b)).alias("y"))

    ring = F.array(*[corner(i, j) for i, j in CORNERS])
    ring = F.when(F.col("ord") % 4 == 2, F.reverse(ring)).otherwise(ring)
    # made once a row: the optimizer carries no filter through a generator, in which the ring would be made anew at each use
    return u.select("*", F.explode(F.array(ring)).alias("ring"))


_HALVES = "(x0 + x1) / 2 as cx, (y0 + y1) / 2 as cy, (x1 - x0) / 2 as hx, (y1 - y0) / 2 as hy"
_AT = [f"struct_pack(k := case when ord % 4 = 2 then {len(CORNERS) - 1 - k} else {k} end, x := cx + case when ord % 2 = 1 then hx * {i} * 0.8e0 - hy * {j} * 0.6e0 else hx * {i} end, y := cy + case when ord % 2 = 1 then hx * {i} * 0.6e0 + hy * {j} * 0.8e0 else hy * {j} end)" for k, (i, j) in enumerate(CORNERS)]
EDGES_SQL = f"""{B.with_views('units', 'panos')}, vx as (select unit_id, building_id, ord, unnest([{', '.join(_AT)}]) as v from (select *, {_HALVES} from units)),
ed as (select a.unit_id, a.building_id, a.ord, a.v.k as k, a.v.x as ax, a.v.y as ay, b.v.x as ex, b.v.y as ey from vx a join vx b on b.unit_id = a.unit_id and b.v.k = (a.v.k + 1) % {len(CORNERS)}),
bd as (select unit_id, min(ax) as lo_x, min(ay) as lo_y, max(ax) as hi_x, max(ay) as hi_y from ed group by unit_id),
nr as (select bd.*, pano_id, pano_ord, px, py from bd join panos on px between lo_x - 30 and hi_x + 30 and py between lo_y - 30 and hi_y + 30),
pe as (select nr.*, k, ax, ay, ex, ey, least(1, greatest(0, ((px - ax) * (ex - ax) + (py - ay) * (ey - ay)) / greatest((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay), 1e-18))) as t from nr join ed using (unit_id)),
ps as (select unit_id, pano_id, px, py, lo_x, lo_y, hi_x, hi_y, min(sqrt(power(ax + (ex - ax) * t - px, 2) + power(ay + (ey - ay) * t - py, 2))) as depth,
 count(*) filter ((ay > py) <> (ey > py) and px < (ex - ax) * (py - ay) / (ey - ay) + ax) % 2 = 1 as is_in from pe group by all),
pairs as (select *, case when is_in then 0e0 else depth end as dist from ps where is_in or depth <= 30)"""


@query(f"{EDGES_SQL} select unit_id, pano_id, is_in as inside, round_even(dist, 4) as dist, round_even(depth, 4) as depth from pairs")
def outline_panos_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panoramas at most 30 m from a unit's outline, and those inside with their depth."""
    x = shapes.points_near(outlines(spark, sf_dir), B.panos(spark, sf_dir), S.max_view_dist)
    return x.select("unit_id", "pano_id", "inside", F.bround("dist", 4).alias("dist"), F.bround("depth", 4).alias("depth"))


def outline_looks(spark: SparkSession, sf_dir: str, unasked: Sequence[str] = ("qx", "qy", "visible")) -> DataFrame:
    """What each panorama within reach sees of each unit, but the columns that are unasked."""
    u = outlines(spark, sf_dir)
    pairs = shapes.points_near(u.select("unit_id", "ring"), B.panos(spark, sf_dir), S.max_view_dist)
    return outlook.outline_looks(pairs, u.select("ring"), S, unasked=unasked)


def mm(*names: str) -> str:
    """Columns in whole millimetres, an i before their names."""
    return ", ".join(f"floor({n} * 1000e0 + 0.5e0)::bigint as i{n}" for n in names)


SIGN = "sign(({2} - {0}) * ({5} - {1}) - ({3} - {1}) * ({4} - {0}))"
LINE_SQL = f"""ln as (select *, sqrt((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay)) as m from ed), cu as (select *, list_reduce(list_prepend(0e0, list(m) over (partition by unit_id order by k)), lambda s, v: s + v) as b from ln), cv as (select *, coalesce(lag(b) over (partition by unit_id order by k), 0e0) as a, max(b) over (partition by unit_id) as ring_m from cu),
nn as (select distinct unit_id, ring_m, greatest(8, floor(ring_m / 0.5e0))::int as n from cv), pp as (select unit_id, n, i::int as i, ring_m / n as step, i * (ring_m / n) as w from nn, unnest(range(n)) r(i)),
pt as (select pp.unit_id, n, i, step, ax + (ex - ax) * ((w - a) / greatest(b - a, 1e-12)) as qx, ay + (ey - ay) * ((w - a) / greatest(b - a, 1e-12)) as qy from pp join cv on cv.unit_id = pp.unit_id and w >= a and w < b),
ql as (select unit_id, pano_id, i, n, step, px, py, qx, qy, greatest(sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py)), 1e-9) as d from pairs join pt using (unit_id)),
qs as (select *, px + (qx - px) * least(1, greatest(0, (d - 0.05e0) / d)) as tx, py + (qy - py) * least(1, greatest(0, (d - 0.05e0) / d)) as ty from ql), qt as (select unit_id, pano_id, i, {mm('px', 'py', 'tx', 'ty')} from qs),
nb as (select p.unit_id, p.pano_id, {mm('ax', 'ay', 'ex', 'ey')} from pairs p join bd o on o.lo_x <= greatest(p.hi_x, px) and o.hi_x >= least(p.lo_x, px) and o.lo_y <= greatest(p.hi_y, py) and o.hi_y >= least(p.lo_y, py) join ed e on e.unit_id = o.unit_id),
hi as (select unit_id, pano_id, i, bool_or(least(ipx, itx) <= greatest(iax, iex) and greatest(ipx, itx) >= least(iax, iex) and least(ipy, ity) <= greatest(iay, iey) and greatest(ipy, ity) >= least(iay, iey)
 and {SIGN.format('ipx', 'ipy', 'itx', 'ity', 'iax', 'iay')} * {SIGN.format('ipx', 'ipy', 'itx', 'ity', 'iex', 'iey')} <= 0 and {SIGN.format('iax', 'iay', 'iex', 'iey', 'ipx', 'ipy')} * {SIGN.format('iax', 'iay', 'iex', 'iey', 'itx', 'ity')} <= 0) as hidden from qt join nb using (unit_id, pano_id) group by all)"""
SEEN_SQL = f"{EDGES_SQL}, {LINE_SQL}, s as (select ql.*, pano_ord, not hidden as visible from ql join hi using (unit_id, pano_id, i) join (select pano_id, pano_ord from panos) using (pano_id))"


@query(f"{EDGES_SQL}, {LINE_SQL} select unit_id, pano_id, count(*) as n_points, count(*) filter (not hidden) as n_visible from hi group by all")
def outline_visible_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many outline points each panorama sees past all other outlines and the unit's own walls."""
    x = outline_looks(spark, sf_dir, ("qx", "qy", "good", "cos"))
    return x.select("unit_id", "pano_id", F.col("n").cast("long").alias("n_points"), F.size(F.filter("visible", lambda v: v)).cast("long").alias("n_visible"))


@query(f"""{SEEN_SQL}, w as (select unit_id, sign(sum(ax * ey - ex * ay)) as way from ed group by unit_id),
g as (select s.unit_id, s.pano_id, s.i, (px - s.qx) / d as cx, (py - s.qy) / d as cy, b.qx - a.qx as tx, b.qy - a.qy as ty, way from s join pt a on a.unit_id = s.unit_id and a.i = (s.i + s.n - 1) % s.n join pt b on b.unit_id = s.unit_id and b.i = (s.i + 1) % s.n join w on w.unit_id = s.unit_id where visible),
o as (select unit_id, pano_id, (cx * ty - cy * tx) * way / greatest(sqrt(tx * tx + ty * ty), 1e-9) as cos from g)
select unit_id, pano_id, count(*) as n_good, round_even(sum(cos), 3) as cos_sum, round_even(max(cos), 5) as cos_max from o where cos >= 0.42e0 group by all""")
def outline_square_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many outline points each panorama sees squarely, whichever way the ring is drawn."""
    x = outline_looks(spark, sf_dir).where(F.size("good") > 0)
    add = F.aggregate("cos", F.lit(0.0), lambda a, c: a + c)
    return x.select("unit_id", "pano_id", F.size("good").cast("long").alias("n_good"), F.bround(add, 3).alias("cos_sum"), F.bround(F.array_max("cos"), 5).alias("cos_max"))


@query(f"{SEEN_SQL}, {RUN_SQL}, {SCORE_SQL} select unit_id, pano_id, visible_m, span_deg, dist_near, apparent_m, quality, score from h")
def outline_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views of units of any outline that are good enough, with quality and score."""
    c = looks.candidates(outline_looks(spark, sf_dir, POINTS), S)
    return c.select("unit_id", "pano_id", "visible_m", "span_deg", "dist_near", "apparent_m", "quality", "score")


@query(f"""{SEEN_SQL}, {RUN_SQL}, k as (select unit_id, count(*) as n, min(dist_near) as near from c group by unit_id)
select unit_id, case when n is null then 'not visible' when near > 15 then 'not street-facing' else 'street-facing' end as access, coalesce(n, 0) as n_candidates from units left join k using (unit_id)""")
def outline_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of access of units of any outline: visible, from near enough or not."""
    return sight.access_class(B.units(spark, sf_dir), looks.candidates(outline_looks(spark, sf_dir, POINTS), S), S)


@query()
def outline_views_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four views of each unit of any outline, each that which adds most wall. A sequential choice, so without SQL."""
    return selection.choose_views(looks.candidates(outline_looks(spark, sf_dir), S), S)


IN_SQL = f"""(count(*) filter ((iay > ipy) <> (iey > ipy) and {SIGN.format('iax', 'iay', 'iex', 'iey', 'ipx', 'ipy')} = case when iey > iay then 1 else -1 end) % 2 = 1
 and not bool_or({SIGN.format('iax', 'iay', 'iex', 'iey', 'ipx', 'ipy')} = 0 and ipx between least(iax, iex) and greatest(iax, iex) and ipy between least(iay, iey) and greatest(iay, iey)))"""


@query(f"""{EDGES_SQL}, q as (select pano_id, pano_ord, px, py + 9e0 as py from panos where own),
qe as (select pano_id, px, py, e.unit_id, e.ord, e.k, ax, ay, ex, ey, {mm('px', 'py', 'ax', 'ay', 'ex', 'ey')} from q join bd on px between lo_x and hi_x and py between lo_y and hi_y join ed e on e.unit_id = bd.unit_id),
qi as (select pano_id, ord from qe group by all having {IN_SQL}),
qk as (select qe.*, least(1, greatest(0, ((px - ax) * (ex - ax) + (py - ay) * (ey - ay)) / greatest((ex - ax) * (ex - ax) + (ey - ay) * (ey - ay), 1e-18))) as t from qe join qi using (pano_id, ord)),
qf as (select pano_id, ord, px, py, ax + (ex - ax) * t as fx, ay + (ey - ay) * t as fy, k from qk), qd as (select *, sqrt((fx - px) * (fx - px) + (fy - py) * (fy - py)) as depth from qf),
qm as (select * from (select *, row_number() over (partition by pano_id, ord order by depth, k) as nth from qd) where nth = 1),
qt as (select pano_id, ord, c, px + (fx - px) * ((depth + c) / depth) as px, py + (fy - py) * ((depth + c) / depth) as py from qm, (values (0.5e0), (1e0)) v(c) where depth > 0 and depth <= 2.5e0),
qy as (select pano_id, ord, c, e.unit_id, {mm('px', 'py', 'ax', 'ay', 'ex', 'ey')} from qt t join bd on px between lo_x and hi_x and py between lo_y and hi_y join (select unit_id, ax, ay, ex, ey from ed) e on e.unit_id = bd.unit_id),
qb as (select distinct pano_id, ord, c from (select pano_id, ord, c, unit_id from qy group by all having {IN_SQL})),
qo as (select pano_id, ord, min(c) as c from qt where not exists (select 1 from qb where qb.pano_id = qt.pano_id and qb.ord = qt.ord and qb.c = qt.c) group by all),
ok as (select pano_id, count(*) = count(c) as fine, max(ord) as ord from qi left join qo using (pano_id, ord) group by pano_id)
select q.pano_id, coalesce(fine, false) as snapped, round_even(coalesce(qt.px, q.px), 6) as px, round_even(coalesce(qt.py, q.py), 6) as py
from q left join ok using (pano_id) left join qo on qo.pano_id = ok.pano_id and qo.ord = ok.ord left join qt on qt.pano_id = qo.pano_id and qt.ord = qo.ord and qt.c = qo.c where fine is null or fine""")
def outline_panos_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own panoramas; those a little inside an outline are moved out over its nearest point, deeper ones go."""
    p = B.panos(spark, sf_dir).withColumn("py", F.col("py") + 9.0)
    x = outlook.usable_panoramas(p, outlines(spark, sf_dir), S)
    return x.select("pano_id", "snapped", F.bround("px", 6).alias("px"), F.bround("py", 6).alias("py"))


@query()
def outline_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four links a unit of any outline, with where each looks; those that see it first. A sequential choice, so without SQL."""
    return unit_links(spark, sf_dir)


def unit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = outlines(spark, sf_dir)
    return links.link_views(u, B.panos(spark, sf_dir), u.select("ring"), S)


@query()
def outline_link_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of each unit side by side: addresses for a viewer, and what they show in words."""
    return links.link_fields(unit_links(spark, sf_dir), S, (711679.6, 1219908.4))


OTHERS_SQL = """oe as (select ord, unit_id, k, ax + dx as ax, ay + dy as ay, ex + dx as ex, ey + dy as ey from (select *, ord % 7 + case when ord % 20 = 9 then 5000 else 0 end as dx, ord % 5 as dy from ed)),
ob as (select ord, min(ax) as lo_x, min(ay) as lo_y, max(ax) as hi_x, max(ay) as hi_y, abs(sum(ax * ey - ex * ay)) / 2 as area from oe group by ord),
bx as (select min(lo_x) - 80 as w0, min(lo_y) - 80 as w1, max(hi_x) + 80 as w2, max(hi_y) + 80 as w3 from bd),
oi as (select ob.* from ob, bx where lo_x <= w2 and hi_x >= w0 and lo_y <= w3 and hi_y >= w1),
op as (select oi.ord as p, bd.unit_id as q from oi join bd on bd.lo_x <= oi.hi_x and bd.hi_x >= oi.lo_x and bd.lo_y <= oi.hi_y and bd.hi_y >= oi.lo_y),
oq as (select p, q, 0 as w, ax, ay, ex, ey from op join oe on oe.ord = p union all select p, q, 1, ax, ay, ex, ey from op join ed on ed.unit_id = q),
cr as (select a.p, a.q, a.ay + (a.ey - a.ay) * (((b.ax - a.ax) * (b.ey - b.ay) - (b.ay - a.ay) * (b.ex - b.ax)) / nullif((a.ex - a.ax) * (b.ey - b.ay) - (a.ey - a.ay) * (b.ex - b.ax), 0)) as y,
 ((b.ax - a.ax) * (b.ey - b.ay) - (b.ay - a.ay) * (b.ex - b.ax)) / nullif((a.ex - a.ax) * (b.ey - b.ay) - (a.ey - a.ay) * (b.ex - b.ax), 0) as t,
 ((b.ax - a.ax) * (a.ey - a.ay) - (b.ay - a.ay) * (a.ex - a.ax)) / nullif((a.ex - a.ax) * (b.ey - b.ay) - (a.ey - a.ay) * (b.ex - b.ax), 0) as u from oq a join oq b on a.p = b.p and a.q = b.q and a.w = 0 and b.w = 1),
ys as (select distinct p, q, y from (select p, q, ay as y from oq union all select p, q, y from cr where t between 0 and 1 and u between 0 and 1)),
sl as (select p, q, y as y0, lead(y) over (partition by p, q order by y) as y1 from ys),
sm as (select p, q, y0, y1 - y0 as height, (y0 + y1) / 2 as y from sl where y1 > y0),
xs as (select sm.p, sm.q, sm.y0, height, w, list_sort(list(ax + (ex - ax) * ((y - ay) / (ey - ay)))) as x from sm join oq on oq.p = sm.p and oq.q = sm.q and (ay > y) <> (ey > y) group by sm.p, sm.q, sm.y0, height, w),
xi as (select p, q, y0, height, w, x[i] as lo, x[i + 1] as hi from xs, unnest(range(1, len(x), 2)) r(i)),
sh as (select a.p, sum(a.height * greatest(0, least(a.hi, b.hi) - greatest(a.lo, b.lo))) as covered from xi a join xi b on a.p = b.p and a.q = b.q and a.y0 = b.y0 and a.w = 0 and b.w = 1 group by a.p)"""


@query(f"{EDGES_SQL}, {OTHERS_SQL} select ord, round_even(coalesce(covered, 0), 4) as covered from oi left join sh on p = ord where coalesce(covered, 0) <= 0.2e0 * area")
def outline_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring outlines near the ward that aren't copies of own ones. The SQL measures overlaps by level slices, not by triangles."""
    u = outlines(spark, sf_dir)
    moved = lambda p: F.struct((p.x + F.col("ord") % 7 + F.when(F.col("ord") % 20 == 9, 5000).otherwise(0)).alias("x"), (p.y + F.col("ord") % 5).alias("y"))
    others = u.select("ord", F.transform("ring", moved).alias("ring"))
    return overlap.neighbour_blockers(others, u.select("ring"), "ord", S).select("ord", F.bround("covered", 4).alias("covered"))


#: A road past the second row of houses.
PAST = [(0.0, 24.0), (150.0, 30.0), (300.0, 24.0)]


@query()
def units_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units near the first 200 m of a bent road that are also among the ids asked for; the first 20 of them."""
    u = outlines(spark, sf_dir)
    ids = u.where("ord % 3 > 0").select(F.when(F.col("ord") % 3 == 1, F.col("building_id")).otherwise(F.col("unit_id")).alias("id"))
    return shapes.select_units(u, ids, PAST, 6.0, 200.0, 20).select("unit_id", "building_id")
