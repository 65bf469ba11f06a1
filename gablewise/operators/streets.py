"""Street networks: lines split at junctions, points along them, names of stretches.

Lines are axis-aligned segments (road_fid, x0, y0, x1, y1) here; distances along a line start at its first end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions.geo import bearing
from gablewise.operators.grid import boxes_within

LINE = ("x0", "y0", "x1", "y1")
OTHER = ("u0", "v0", "u1", "v1")


def length() -> Column:
    return F.sqrt((F.col("x1") - F.col("x0")) ** 2 + (F.col("y1") - F.col("y0")) ** 2)


def junction_cuts(lines: DataFrame, tolerance: float, side: float = 64.0) -> DataFrame:
    """(road_fid, cut): distances along each line at which another line crosses it, or ends within the tolerance of it."""
    box = lambda a, b, c, d: [F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d)]
    other = lines.selectExpr("road_fid as other", "x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    pairs = boxes_within(lines, other, tolerance, box(*LINE), box(*OTHER), side).where("road_fid <> other")
    dx, dy, ex, ey = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.col("u1") - F.col("u0"), F.col("v1") - F.col("v0")
    det = dx * ey - dy * ex
    t = ((F.col("u0") - F.col("x0")) * ey - (F.col("v0") - F.col("y0")) * ex) / F.nullif(det, F.lit(0.0))
    u = ((F.col("u0") - F.col("x0")) * dy - (F.col("v0") - F.col("y0")) * dx) / F.nullif(det, F.lit(0.0))
    cross = F.when(t.between(0, 1) & u.between(0, 1), t)

    def foot(x: str, y: str) -> Column:
        k = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((F.col(x) - F.col("x0")) * dx + (F.col(y) - F.col("y0")) * dy) / (dx * dx + dy * dy)))
        d2 = (F.col("x0") + dx * k - F.col(x)) ** 2 + (F.col("y0") + dy * k - F.col(y)) ** 2
        return F.when(d2 <= tolerance * tolerance, k)

    cuts = pairs.select("road_fid", F.explode(F.array(cross, foot("u0", "v0"), foot("u1", "v1"))).alias("k"), length().alias("len"))
    return cuts.where("k is not null").select("road_fid", (F.col("k") * F.col("len")).alias("cut"))


def split_lines(lines: DataFrame, cuts: DataFrame, min_gap: float, min_length: float) -> DataFrame:
    """Stretches between the cuts: cuts close to an end, or to the last one kept, don't count; short pieces go.

    The thinning is a fold over one line's cuts. Of stretches at one place the first stays; others may share an id by chance.
    """
    lists = cuts.groupBy("road_fid").agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
    x = lines.join(lists, "road_fid", "left").withColumn("len", length())
    none = F.expr("cast(array() as array<double>)")
    inner = F.filter(F.coalesce("cuts", none), lambda c: (c > min_gap) & (c < F.col("len") - min_gap))
    kept = F.aggregate(inner, none, lambda a, c: F.when((F.size(a) == 0) | (c - F.coalesce(F.element_at(a, -1), c) >= min_gap), F.concat(a, F.array(c))).otherwise(a))
    x = x.withColumn("ends", F.concat(F.array(F.lit(0.0)), kept, F.array("len")))
    x = x.select("road_fid", "road_name", *LINE, "len", "ends", F.posexplode(F.slice("ends", 1, F.size("ends") - 1)).alias("n", "a"))
    x = x.withColumn("b", F.get("ends", F.col("n") + 1)).where(F.col("b") - F.col("a") >= min_length)
    at = lambda p, q, d: F.col(p) + (F.col(q) - F.col(p)) * (F.col(d) / F.col("len"))
    x = x.select("road_fid", "road_name", "n", at("x0", "x1", "a").alias("x0"), at("y0", "y1", "a").alias("y0"), at("x0", "x1", "b").alias("x1"), at("y0", "y1", "b").alias("y1"))
    x = x.withColumns({"place": stretch_place(), "length_m": F.bround(length(), 1)})
    first = F.row_number().over(W.partitionBy("place").orderBy("road_fid", "n"))
    return x.withColumn("nth", first).where("nth = 1").withColumn("stretch_id", stretch_id(F.col("place"))).drop("nth", "place")


def stretch_place() -> Column:
    """Where a stretch is, whichever way it is drawn: its ends in order and its middle, in whole metres."""
    whole = lambda c: F.rint(c).cast("bigint").cast("string")
    point = lambda x, y: F.concat(F.lit("("), whole(F.col(x)), F.lit(", "), whole(F.col(y)), F.lit(")"))
    a, b = F.struct(F.rint("x0"), F.rint("y0")), F.struct(F.rint("x1"), F.rint("y1"))
    ends = F.when(a <= b, F.concat(point("x0", "y0"), F.lit(", "), point("x1", "y1"))).otherwise(F.concat(point("x1", "y1"), F.lit(", "), point("x0", "y0")))
    middle = F.concat(whole((F.col("x0") + F.col("x1")) / 2), F.lit(","), whole((F.col("y0") + F.col("y1")) / 2))
    return F.concat(F.lit("["), ends, F.lit("]|"), middle)


def stretch_id(place: Column) -> Column:
    """A short id of a stretch's place. Of some thousands of stretches two may have the same, so it tells no two apart."""
    return F.concat(F.lit("S"), F.substring(F.sha1(place), 1, 6))


def points_along(lines: DataFrame, key: str, step: float) -> DataFrame:
    """(key, n, along_m, x, y, heading): the middles of equal parts of about step metres."""
    x = lines.withColumn("len", length())
    x = x.withColumn("k", F.greatest(F.lit(1), F.rint(F.col("len") / step)).cast("int"))
    x = x.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("k")))).withColumn("along", (F.col("n") - 0.5) * F.col("len") / F.col("k"))
    at = lambda p, q: F.col(p) + (F.col(q) - F.col(p)) * (F.col("along") / F.col("len"))
    return x.select(key, "n", F.bround("along", 1).alias("along_m"), at("x0", "x1").alias("x"), at("y0", "y1").alias("y"), bearing(*LINE).alias("heading"))
