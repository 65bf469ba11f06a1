"""Street queries: stretches, points for pictures, gaps between fronts, assignment of units, names by likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.functions.text import alike_candidates, digits, name_key, similar_keys
from gablewise.model import Settings
from gablewise.operators import network, streets
from gablewise.operators.grid import boxes_within, nearest
from gablewise.plans.records import KEYS_SQL, spellings
from gablewise.plans.registry import query
from gablewise.sources import bindings as B

S = Settings()
#: Lanes are level or upright, so that a crossing is where one's place meets the other's range.
CUTS_SQL = """ln as (select *, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) as len from lanes), cx as (select distinct a.road_fid, case when a.y0 = a.y1 then b.x0 - a.x0 else b.y0 - a.y0 end as cut
 from ln a join ln b on (a.y0 = a.y1) <> (b.y0 = b.y1) and case when a.y0 = a.y1 then b.x0 between a.x0 and a.x1 and a.y0 between b.y0 and b.y1 else b.y0 between a.y0 and a.y1 and a.x0 between b.x0 and b.x1 end),
ck as (select c.road_fid, cut from cx c join ln using (road_fid) where cut > 1 and cut < len - 1 union all select road_fid, 0e0 from ln union all select road_fid, len from ln),
pc as (select road_fid, cut as a, lead(cut) over (partition by road_fid order by cut) as b, row_number() over (partition by road_fid order by cut) - 1 as n from ck),
st as (select road_fid, road_name, n, x0 + (x1 - x0) * (a / len) as x0, y0 + (y1 - y0) * (a / len) as y0, x0 + (x1 - x0) * (b / len) as x1, y0 + (y1 - y0) * (b / len) as y1 from pc join ln using (road_fid) where b - a >= 10),
si as (select *, concat('S', left(sha1(concat('[(', round_even(x0, 0)::bigint, ', ', round_even(y0, 0)::bigint, '), (', round_even(x1, 0)::bigint, ', ', round_even(y1, 0)::bigint, ')]|', round_even((x0 + x1) / 2, 0)::bigint, ',', round_even((y0 + y1) / 2, 0)::bigint)), 6)) as stretch_id,
 round_even(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)), 1) as length_m from st)"""


def stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = B.lanes(spark, sf_dir)
    return streets.split_lines(lanes, streets.junction_cuts(lanes, S.junction), S.junction, S.min_stretch)


@query(f"{B.with_views('lanes')}, {CUTS_SQL} select stretch_id, road_fid, length_m from si")
def stretches_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stretches(spark, sf_dir).select("stretch_id", "road_fid", "length_m")


PICTURES_SQL = """pk as (select *, greatest(1, round_even(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) / 50, 0))::int as k, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) as len from si),
pp as (select stretch_id, n::int as n, (n - 0.5e0) * len / k as along, len, x0, y0, x1, y1 from (select * exclude (n) from pk), unnest(range(1, k + 1)) r(n))"""


@query(f"{B.with_views('lanes')}, {CUTS_SQL}, {PICTURES_SQL} select stretch_id, n, round_even(along, 1) as along_m, round_even(x0 + (x1 - x0) * (along / len), 3) as x, round_even(y0 + (y1 - y0) * (along / len), 3) as y, case when y0 = y1 then 90e0 else 0e0 end as heading from pp")
def picture_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = streets.points_along(stretches(spark, sf_dir), "stretch_id", S.picture_step)
    return p.select("stretch_id", "n", "along_m", F.bround("x", 3).alias("x"), F.bround("y", 3).alias("y"), F.bround("heading", 6).alias("heading"))


def with_paths(lines: DataFrame) -> DataFrame:
    """Straight lines as paths."""
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return lines.withColumn("path", F.array(point("x0", "y0"), point("x1", "y1")))


def with_rings(rects: DataFrame) -> DataFrame:
    """Rectangles as outlines."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return rects.withColumn("ring", F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1")))


@query(f"""{B.with_views('units', 'lanes')}, {CUTS_SQL}, gk as (select *, x1 - x0 + y1 - y0 as len, y0 = y1 as level from si),
gs as (select stretch_id, n, level, case when level then x0 + (5e0 + n * 10e0) else x0 end as x, case when level then y0 else y0 + (5e0 + n * 10e0) end as y from (select * exclude (n) from gk), unnest(range(greatest(0, ceil((len - 5e0) / 10e0)::int))) r(n)),
gl as (select stretch_id, n, round(case when level then x else y end, 3) as w, case when level then y else x end as z, level from gs),
ul as (select true as level, x0 as lo, x1 as hi, y0 as near, y1 as far from units union all select false, y0, y1, x0, x1 from units),
gh as (select stretch_id, n, min(case when far >= z then greatest(0, near - z) end) as up, min(case when near <= z then greatest(0, z - far) end) as down from gl join ul on ul.level = gl.level and lo <= w and hi >= w and near <= z + 25 and far >= z - 25 group by all)
select stretch_id, count(*) as samples, count(up + down) as both, round_even(median(up + down), 1) as median_m, round_even(min(up + down), 1) as min_m from gl left join gh using (stretch_id, n) group by stretch_id""")
def stretch_gap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps between the fronts on both sides of each stretch, sampled half a step from its start and then every step."""
    return network.front_gaps(with_paths(stretches(spark, sf_dir)), "stretch_id", with_rings(B.units(spark, sf_dir)), S.gap_step, S.gap_reach)


@query()
def street_picture_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each picture point in turn the newest, then nearest panorama on this stretch that it hasn't taken yet; null if there is none."""
    s = with_paths(stretches(spark, sf_dir)).withColumn("piece", F.concat_ws("/", "road_fid", "n"))  # two stretches may share an id
    x = network.choose_pictures(s, B.panos(spark, sf_dir), "piece", S)
    return x.join(s.select("piece", "stretch_id"), "piece").select("stretch_id", "n", "pick")


@query(f"""{B.with_views('units', 'lanes')}, {CUTS_SQL}, d as (select unit_id, stretch_id, sqrt(power(greatest(least(s.x0, s.x1) - u.x1, 0, u.x0 - greatest(s.x0, s.x1)), 2) + power(greatest(least(s.y0, s.y1) - u.y1, 0, u.y0 - greatest(s.y0, s.y1)), 2)) as dist from units u, si s),
n as (select *, row_number() over (partition by unit_id order by dist, stretch_id) as nth from d where dist <= 30) select unit_id, stretch_id, case when dist <= 15 then 'seen' else 'cannot see' end as role from n where nth = 1""")
def unit_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each unit's nearest stretch, and whether a camera on it is near enough to see the unit."""
    s = stretches(spark, sf_dir).select("stretch_id", F.least("x0", "x1").alias("r0"), F.least("y0", "y1").alias("s0"), F.greatest("x0", "x1").alias("r1"), F.greatest("y0", "y1").alias("s1"))
    x = boxes_within(B.units(spark, sf_dir), s, S.back_lot_reach, streets.LINE, ("r0", "s0", "r1", "s1"), 60.0)
    x = nearest(x, ["unit_id"], ["dist", "stretch_id"])
    return x.select("unit_id", "stretch_id", F.when(F.col("dist") <= S.camera_reach, "seen").otherwise("cannot see").alias("role"))


def alike_keys(keys: DataFrame) -> DataFrame:
    """(a, b): pairs of different keys of one street, as far as spelling tells.

    Keys are compared only where they share their digits and have letters enough in common.
    """
    pairs = alike_candidates(keys.select(F.col("key").alias("name")), F.col("name"), digits(F.col("name")))
    return pairs.where(similar_keys(F.col("a"), F.col("b")))


@query()
def fuzzy_street_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street names whose keys are a slip apart, with one letter of some lost."""
    u = B.units(spark, sf_dir).select(name_key(F.col("road")).alias("key"), "ord")
    cut = F.when(F.col("ord") % 50 == 0, F.concat(F.substring("key", 1, 4), F.substring(F.col("key"), F.lit(6), F.length("key")))).otherwise(F.col("key"))
    return alike_keys(u.select(cut.alias("key")))


@query(f"""{B.with_views('units')}, {KEYS_SQL}, c as (select key, road, count(*) as n, min(ord) as first from k group by all), b as (select *, row_number() over (partition by key order by n desc, first, road) as nth from c),
sp as (select key, case when road = upper(road) or road = lower(road) then array_to_string(list_transform(string_split(road, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), ' ') else road end as spelling from b where nth = 1)
select unit_id, spelling from units join k using (road, ord) join sp using (key)""")
def units_spelled_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each unit with the common spelling of its street."""
    u = B.units(spark, sf_dir)
    s = spellings(u).select("key", "spelling")
    return u.withColumn("key", name_key(F.col("road"))).join(s, "key").select("unit_id", "spelling")
