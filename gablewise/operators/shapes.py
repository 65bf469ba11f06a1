"""Footprints of any outline and roads with bends: distances, containment, sight, and roads split at junctions.

An outline or a road is an array of points (x, y); an outline closes by itself. All that looks into one shape is a column
expression over its few edges; shapes meet points and each other by grid cells of their bounds, with the exact test after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.operators.grid import cell, in_cells, meet

BOUNDS = ("min_x", "min_y", "max_x", "max_y")
EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"


def broken(df: DataFrame, points: str, closed: bool) -> DataFrame:
    """The rows that no operator here takes: outlines of fewer than three points, roads of fewer than two, or none at all."""
    return df.where(F.coalesce(F.size(points), F.lit(0)) < (3 if closed else 2))


def edges(points: Column, closed: bool) -> Column:
    """The edges of an outline or a road: an array of structs (ax, ay, bx, by); none of a shape with too few points."""
    n = F.size(points)
    one = lambda i: F.struct(F.get(points, i).x.alias("ax"), F.get(points, i).y.alias("ay"), F.get(points, (i + 1) % n).x.alias("bx"), F.get(points, (i + 1) % n).y.alias("by"))
    return F.when(n >= (3 if closed else 2), F.transform(F.sequence(F.lit(0), n - (1 if closed else 2)), one)).otherwise(F.array().cast(EDGES))


def bounds(points: Column) -> dict[str, Column]:
    x, y = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return dict(zip(BOUNDS, (F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)), strict=True))


def edge_distance(px: Column, py: Column, e: Column) -> Column:
    """Distance of a point from an edge."""
    dx, dy = e.bx - e.ax, e.by - e.ay
    k = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - e.ax) * dx + (py - e.ay) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-18))))
    fx, fy = e.ax + dx * k - px, e.ay + dy * k - py
    return F.sqrt(fx * fx + fy * fy)


def inside(px: Column, py: Column, es: Column) -> Column:
    """Is a point inside an outline? It is if a ray from it crosses an odd number of edges."""
    crossed = lambda e: ((e.ay > py) != (e.by > py)) & (px < (e.bx - e.ax) * (py - e.ay) / (e.by - e.ay) + e.ax)
    return F.size(F.filter(es, crossed)) % 2 == 1


def depth(px: Column, py: Column, es: Column) -> Column:
    """Distance of a point from the nearest edge."""
    return F.array_min(F.transform(es, lambda e: edge_distance(px, py, e)))


def distance(px: Column, py: Column, es: Column) -> Column:
    """Distance of a point from a footprint: 0 inside."""
    return F.when(inside(px, py, es), 0.0).otherwise(depth(px, py, es))


def millimetres(c: Column) -> Column:
    return F.floor(c * 1000 + F.lit(0.5)).cast("long")


def turning(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """1, 0 or -1: c is to the left of the line from a to b, on it, or to its right. Whole numbers, so exact up to some 2,000 km in millimetres."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def touches(px: Column, py: Column, qx: Column, qy: Column, e: Column) -> Column:
    """Do the segment from p to q and an edge have a point in common, ends included? Decided in whole millimetres, without rounding."""
    px, py, qx, qy, ax, ay, bx, by = (millimetres(c) for c in (px, py, qx, qy, e.ax, e.ay, e.bx, e.by))
    across = turning(px, py, qx, qy, ax, ay) * turning(px, py, qx, qy, bx, by) <= 0
    along = turning(ax, ay, bx, by, px, py) * turning(ax, ay, bx, by, qx, qy) <= 0
    near = (F.least(px, qx) <= F.greatest(ax, bx)) & (F.greatest(px, qx) >= F.least(ax, bx)) & (F.least(py, qy) <= F.greatest(ay, by)) & (F.greatest(py, qy) >= F.least(ay, by))
    return near & across & along


def strictly_inside(px: Column, py: Column, es: Column) -> Column:
    """Is a point inside an outline and not on it? In whole millimetres, without rounding."""
    px, py = millimetres(px), millimetres(py)
    of = lambda e: [millimetres(c) for c in (e.ax, e.ay, e.bx, e.by)]

    def crossed(e: Column) -> Column:
        ax, ay, bx, by = of(e)
        return ((ay > py) != (by > py)) & (turning(ax, ay, bx, by, px, py) == F.when(by > ay, 1).otherwise(-1))

    def on(e: Column) -> Column:
        ax, ay, bx, by = of(e)
        return (turning(ax, ay, bx, by, px, py) == 0) & px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))

    return (F.size(F.filter(es, crossed)) % 2 == 1) & ~F.exists(es, on)


def with_lengths(es: Column) -> Column:
    """The edges with the distances along the shape at which they start and end: structs (a, b, ax, ay, bx, by)."""
    none = F.expr("cast(array() as array<struct<a:double,b:double,ax:double,ay:double,bx:double,by:double>>)")

    def add(done: Column, e: Column) -> Column:
        at = F.coalesce(F.try_element_at(done, F.lit(-1)).b, F.lit(0.0))
        dx, dy = e.bx - e.ax, e.by - e.ay
        return F.concat(done, F.array(F.struct(at.alias("a"), (at + F.sqrt(dx * dx + dy * dy)).alias("b"), e.ax.alias("ax"), e.ay.alias("ay"), e.bx.alias("bx"), e.by.alias("by"))))

    return F.aggregate(es, none, add)


def point_along(ls: Column, at: Column) -> Column:
    """The point (x, y) at a distance along a shape, from its edges with lengths."""
    e = F.coalesce(F.get(F.filter(ls, lambda e: e.b > at), F.lit(0)), F.try_element_at(ls, F.lit(-1)))
    k = (at - e.a) / F.greatest(e.b - e.a, F.lit(1e-12))
    return F.struct((e.ax + (e.bx - e.ax) * k).alias("x"), (e.ay + (e.by - e.ay) * k).alias("y"))


def points_near(shapes: DataFrame, points: DataFrame, radius: float, outline: str = "ring", tiles: tuple[float, int] | None = None) -> DataFrame:
    """Pairs of a footprint and a point (px, py) at most radius apart, with dist (0 inside) and depth. Pairs come once.

    Outlines of fewer than three points are near nothing. With tiles, their side and a number of tasks, pairs keep the cell_x and cell_y of the
    point's tile and lie in so many parts by them.
    """
    side = tiles[0] if tiles else max(radius, 1.0)
    s = shapes.where(F.size(outline) >= 3).withColumn("es", edges(F.col(outline), True)).withColumns(bounds(F.col(outline)))
    s = in_cells(s, BOUNDS, side, radius).drop("first_x", "first_y")
    p = points.withColumns({"cell_x": cell("px", side), "cell_y": cell("py", side)})
    px, py, far = F.col("px"), F.col("py"), radius + 0.001  # most that meet in a cell are told apart by the bounds alone
    box = px.between(F.col("min_x") - far, F.col("max_x") + far) & py.between(F.col("min_y") - far, F.col("max_y") + far)
    if tiles:
        s, p = (d.repartition(tiles[1], "cell_x", "cell_y") for d in (s, p))
    x = meet(s, p).where(box)
    x = x if tiles else x.drop("cell_x", "cell_y")
    d = depth(F.col("px"), F.col("py"), F.col("es"))
    x = x.withColumns({"depth": d, "inside": inside(F.col("px"), F.col("py"), F.col("es"))})
    return x.withColumn("dist", F.when(F.col("inside"), 0.0).otherwise(F.col("depth"))).where(F.col("dist") <= radius)


def path_segments(roads: DataFrame) -> DataFrame:
    """(road_fid, seg, a, b, ax, ay, bx, by, starts, ends): each road's edges; whether they hold an end of the road."""
    x = roads.where(F.size("path") >= 2).select("road_fid", F.posexplode(with_lengths(edges(F.col("path"), False))).alias("seg", "e"), (F.size("path") - 2).alias("last"))
    return x.select("road_fid", "seg", "e.*", (F.col("seg") == 0).alias("starts"), (F.col("seg") == F.col("last")).alias("ends"))


def path_cuts(roads: DataFrame, tolerance: float, side: float = 64.0) -> DataFrame:
    """(road_fid, cut): distances along each road at which another one crosses it, or ends within the tolerance of it."""
    seg = path_segments(roads)
    box = lambda p: [F.least(F.col(f"{p}ax"), F.col(f"{p}bx")), F.least(F.col(f"{p}ay"), F.col(f"{p}by")), F.greatest(F.col(f"{p}ax"), F.col(f"{p}bx")), F.greatest(F.col(f"{p}ay"), F.col(f"{p}by"))]
    other = seg.select(*[F.col(c).alias(f"o_{c}") for c in seg.columns])
    l = in_cells(seg, box(""), side, tolerance)  # noqa: E741
    r = in_cells(other, box("o_"), side).withColumnsRenamed({"first_x": "other_x", "first_y": "other_y"})
    once = (F.col("cell_x") == F.greatest("first_x", "other_x")) & (F.col("cell_y") == F.greatest("first_y", "other_y"))
    x = meet(l, r).where(once & (F.col("road_fid") != F.col("o_road_fid")))
    dx, dy, ex, ey = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("o_bx") - F.col("o_ax"), F.col("o_by") - F.col("o_ay")
    det = F.nullif(dx * ey - dy * ex, F.lit(0.0))
    t = ((F.col("o_ax") - F.col("ax")) * ey - (F.col("o_ay") - F.col("ay")) * ex) / det
    u = ((F.col("o_ax") - F.col("ax")) * dy - (F.col("o_ay") - F.col("ay")) * dx) / det
    cross = F.when(t.between(0, 1) & u.between(0, 1), t)

    def foot(end: str, at: str) -> Column:
        px, py = F.col(f"o_{at}x"), F.col(f"o_{at}y")
        k = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - F.col("ax")) * dx + (py - F.col("ay")) * dy) / F.greatest(dx * dx + dy * dy, F.lit(1e-18))))
        near = F.hypot(F.col("ax") + dx * k - px, F.col("ay") + dy * k - py) <= tolerance
        return F.when(F.col(f"o_{end}") & near, k)

    k = x.select("road_fid", "a", "b", F.explode(F.array(cross, foot("starts", "a"), foot("ends", "b"))).alias("k")).where("k is not null")
    return k.select("road_fid", (F.col("a") + F.col("k") * (F.col("b") - F.col("a"))).alias("cut"))


def split_paths(roads: DataFrame, cuts: DataFrame, min_gap: float, min_length: float) -> DataFrame:
    """Stretches (road_fid, road_name, n, path, length_m, stretch_id) of roads (road_fid, road_name, path) between the cuts.

    Cuts close to an end, or to the last one kept, don't count; short pieces go. A piece keeps the bends between its ends. Of
    equal stretches the first stays. The thinning is a fold over one road's cuts. Roads of fewer than two points have no stretches.
    """
    roads = roads.where(F.size("path") >= 2)
    lists = cuts.groupBy("road_fid").agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
    x = roads.join(lists, "road_fid", "left").withColumn("ls", with_lengths(edges(F.col("path"), False))).withColumn("len", F.element_at("ls", -1).b)
    none = F.expr("cast(array() as array<double>)")
    inner = F.filter(F.coalesce("cuts", none), lambda c: (c > min_gap) & (c < F.col("len") - min_gap))
    kept = F.aggregate(inner, none, lambda a, c: F.when((F.size(a) == 0) | (c - F.coalesce(F.try_element_at(a, F.lit(-1)), c) >= min_gap), F.concat(a, F.array(c))).otherwise(a))
    x = x.withColumn("stops", F.concat(F.array(F.lit(0.0)), kept, F.array("len")))
    x = x.select("road_fid", "road_name", "ls", "stops", F.posexplode(F.slice("stops", 1, F.size("stops") - 1)).alias("n", "a")).withColumn("b", F.get("stops", F.col("n") + 1))
    x = x.where(F.col("b") - F.col("a") >= min_length)
    bends = F.transform(F.filter("ls", lambda e: (e.b > F.col("a")) & (e.b < F.col("b"))), lambda e: F.struct(e.bx.alias("x"), e.by.alias("y")))
    path = F.concat(F.array(point_along(F.col("ls"), F.col("a"))), bends, F.array(point_along(F.col("ls"), F.col("b"))))
    x = x.withColumns({"path": path, "length_m": F.bround(F.col("b") - F.col("a"), 1), "middle": point_along(F.col("ls"), (F.col("a") + F.col("b")) / 2)})
    x = x.withColumn("stretch_id", path_id(F.col("path"), F.col("middle")))
    first = F.row_number().over(W.partitionBy("stretch_id").orderBy("road_fid", "n"))
    return x.withColumn("nth", first).where("nth = 1").select("road_fid", "road_name", "n", "path", "length_m", "stretch_id")


def path_id(path: Column, middle: Column) -> Column:
    """An id that a stretch keeps whichever way it is drawn: from its ends in order and its middle, in whole metres."""
    whole = lambda c: F.rint(c).cast("bigint")
    point = lambda p: F.struct(whole(p.x).alias("x"), whole(p.y).alias("y"))
    text = lambda p: F.concat(F.lit("("), p.x, F.lit(", "), p.y, F.lit(")"))
    a, b = point(F.get(path, F.lit(0))), point(F.element_at(path, -1))
    m = point(middle)
    return F.concat(F.lit("S"), F.substring(F.sha1(F.concat(F.lit("["), text(F.least(a, b)), F.lit(", "), text(F.greatest(a, b)), F.lit("]|"), m.x, F.lit(","), m.y)), 1, 6))


def select_units(units: DataFrame, ids: DataFrame | None = None, path: list[tuple[float, float]] | None = None, reach: float = 20.0, first_m: float | None = None, limit: int | None = None) -> DataFrame:
    """units (unit_id, building_id, ring, ord) that are asked for by all selectors given: ids (id) of units or buildings, at
    most `reach` from a road, of which perhaps only the first metres count; then the first `limit` in order."""
    x = units
    if ids is not None:
        asked = ids.select("id").distinct()
        hit = x.join(asked, F.col("unit_id") == F.col("id"), "left_semi").unionByName(x.join(asked, F.col("building_id") == F.col("id"), "left_semi"))
        x = hit.dropDuplicates(["unit_id"])
    if path is not None:
        x = x.where(path_distance(edges(F.col("ring"), True), cut_path(path, first_m)) <= reach)
    return x if limit is None else x.orderBy("ord").limit(limit)


def cut_path(path: list[tuple[float, float]], first_m: float | None) -> list[tuple[float, float]]:
    """The first metres of a road, all if it is shorter."""
    left, out = float("inf") if first_m is None else first_m, [path[0]]
    for (ax, ay), (bx, by) in zip(path, path[1:], strict=False):
        d = ((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5
        k = min(1.0, left / d) if d else 1.0
        out.append((ax + (bx - ax) * k, ay + (by - ay) * k))
        left -= d
        if left <= 0:
            break
    return out


def path_distance(es: Column, path: list[tuple[float, float]]) -> Column:
    """Distance of a footprint from a road: 0 if an edge touches it or the road is inside, else from the nearest ends."""
    def piece(p: list[Column]) -> Column:
        line = F.struct(*[c.alias(n) for c, n in zip(p, ("ax", "ay", "bx", "by"), strict=True)])
        ends = lambda e: F.least(edge_distance(p[0], p[1], e), edge_distance(p[2], p[3], e), edge_distance(e.ax, e.ay, line), edge_distance(e.bx, e.by, line))
        near = F.array_min(F.transform(es, lambda e: F.when(touches(*p, e), 0.0).otherwise(ends(e))))
        return F.when(inside(p[0], p[1], es), 0.0).otherwise(near)

    out = [piece([F.lit(float(v)) for v in (*a, *b)]) for a, b in zip(path, path[1:], strict=False)]
    return out[0] if len(out) == 1 else F.least(*out)
