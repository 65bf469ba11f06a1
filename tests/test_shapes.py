"""Outlines of any form and roads with bends, against plain Python."""

import math
import random

from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import looks, outlook, selection, shapes
from gablewise.sources import files

RING = "unit_id string, building_id string, ord long, ring array<struct<x:double,y:double>>"
PANOS = "pano_id string, pano_date string, pano_ord long, px double, py double"


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d)]


def plain_inside(p, ring):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > p[1]) != (by > p[1]) and p[0] < (bx - ax) * (p[1] - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def plain_depth(p, ring):
    def one(a, b):
        d2 = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
        k = min(1, max(0, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / d2))
        return math.hypot(a[0] + (b[0] - a[0]) * k - p[0], a[1] + (b[1] - a[1]) * k - p[1])

    return min(one(a, b) for a, b in zip(ring, ring[1:] + ring[:1]))


def test_points_near_any_outline(spark):
    r = random.Random(1)
    rings = []
    for i in range(12):
        cx, cy, n, turn = r.uniform(0, 120), r.uniform(0, 120), r.randrange(3, 9), r.random()
        rings.append([(cx + m * math.cos(2 * math.pi * (k / n + turn)), cy + m * math.sin(2 * math.pi * (k / n + turn))) for k in range(n) for m in [r.uniform(2, 14)]])
    points = [(f"p{i}", "2026", i, r.uniform(-20, 140), r.uniform(-20, 140)) for i in range(150)]
    u = spark.createDataFrame([(f"u{i}", "b", i, ring) for i, ring in enumerate(rings)], RING)
    got = {(x.unit_id, x.pano_id): (round(x.dist, 6), x.inside) for x in shapes.points_near(u, spark.createDataFrame(points, PANOS), 15.0).collect()}
    want = {}
    for i, ring in enumerate(rings):
        for name, _, _, x, y in points:
            within, d = plain_inside((x, y), ring), plain_depth((x, y), ring)
            if within or d <= 15:
                want[f"u{i}", name] = (0.0 if within else round(d, 6), within)
    assert got == want and any(w for _, w in want.values())


def test_sight_of_a_row_of_houses(spark):
    """As rectangles have it; and a slanted wall in front hides what is behind it."""
    s = Settings()
    rows = [("A", box(0, 2, 10, 12)), ("B", box(12, 2, 22, 12)), ("C", box(24, 2, 34, 12)), ("BACK", box(12, 14, 22, 24))]
    u = spark.createDataFrame([(k, k, i, [(float(x), float(y)) for x, y in ring]) for i, (k, ring) in enumerate(rows)], RING)
    panos = spark.createDataFrame([("p0", "2026", 1, 17.0, -3.0)], PANOS)
    pairs = shapes.points_near(u, panos, 30.0)
    seen_by = outlook.outline_looks(pairs, u, s)
    c = {x.unit_id: x for x in looks.candidates(seen_by, s).collect()}
    assert "BACK" not in c and abs(c["B"].dist_near - 5) < 0.3 and 8 <= c["B"].apparent_m <= 11
    assert sorted((round(c["B"].left_x), round(c["B"].right_x))) == [12, 22]
    wall = spark.createDataFrame([("W", "W", 9, [(10.0, -1.0), (24.0, 0.5), (24.0, 1.0), (10.0, -0.5)])], RING)
    hidden = looks.outline_sights(outlook.outline_looks(pairs, u.unionByName(wall), s))
    assert hidden.where("unit_id = 'B' and visible").count() == 0
    notched = spark.createDataFrame([("N", "N", 1, [(10.0, 2.0), (24.0, 2.0), (24.0, 12.0), (20.0, 12.0), (20.0, 6.0), (14.0, 6.0), (14.0, 12.0), (10.0, 12.0)])], RING)
    seen = looks.outline_sights(outlook.outline_looks(shapes.points_near(notched, panos, 30.0), notched, s)).where("visible").agg(F.max("qy"), F.count("*")).first()
    assert seen[0] < 6 and seen[1] > 20  # nothing of the notch behind the front


def test_bent_roads_split_at_junctions(spark):
    schema = "road_fid long, road_name string, path array<struct<x:double,y:double>>"
    roads = spark.createDataFrame([(0, "r", [(0.0, 0.0), (100.0, 0.0)]), (1, "c", [(50.0, -40.0), (50.0, 40.0)]), (2, "e", [(80.0, 0.6), (80.0, 30.0)])], schema)
    split = lambda r: shapes.split_paths(r, shapes.path_cuts(r, 1.0), 1.0, 10.0)
    assert sorted(x.length_m for x in split(roads).collect()) == [20.0, 29.4, 30.0, 40.0, 40.0, 50.0]
    bent = spark.createDataFrame([(0, "b", [(0.0, 0.0), (30.0, 40.0), (90.0, 40.0), (90.0, 0.0)]), (1, "c", [(60.0, 0.0), (60.0, 80.0)]), (2, "d", [(90.0, 20.5), (130.0, 20.5)])], schema)
    got = sorted((x.road_fid, x.n, x.length_m, len(x.path)) for x in split(bent).collect())
    assert got == [(0, 0, 80.0, 3), (0, 1, 49.5, 3), (0, 2, 20.5, 2), (1, 0, 40.0, 2), (1, 1, 40.0, 2), (2, 0, 40.0, 2)]
    back = bent.select("road_fid", "road_name", F.reverse("path").alias("path"))
    ids = lambda r: {x.stretch_id for x in split(r).collect()}
    assert ids(bent) == ids(back) and len(ids(bent)) == 6


def test_units_selected_by_all_selectors(spark):
    u = spark.createDataFrame([(k, k.split("_")[0], i, [(float(x), float(y)) for x, y in ring]) for i, (k, ring) in enumerate([("A", box(0, 2, 10, 12)), ("B_p1", box(12, 2, 22, 12)), ("B_p2", box(12, 14, 22, 24)), ("C", box(24, 2, 34, 12))])], RING)
    pick = lambda **k: sorted(x.unit_id for x in shapes.select_units(u, **k).collect())
    line = [(0.0, -3.0), (40.0, -3.0)]
    ids = spark.createDataFrame([("B",), ("C",)], "id string")
    assert pick(path=line, reach=6.0) == ["A", "B_p1", "C"] and pick(path=line, reach=6.0, first_m=5.0) == ["A"]
    assert pick(ids=ids) == ["B_p1", "B_p2", "C"] and pick(ids=ids, path=line, reach=6.0) == ["B_p1", "C"]
    assert pick(limit=2) == ["A", "B_p1"] and pick() == ["A", "B_p1", "B_p2", "C"]
    assert pick(path=[(5.0, 5.0), (6.0, 5.0)], reach=0.0) == ["A"]  # a road inside a footprint


def test_extra_views_and_the_middle_picture(spark):
    r = random.Random(3)
    rows = [(k, [(float(r.randrange(30)), float(r.randrange(30)), n) for n in range(12)]) for k in range(20)]
    d = spark.createDataFrame(rows, "k int, c array<struct<px:double,py:double,n:int>>").withColumn("taken", F.slice("c", 1, 2))
    for x in d.withColumn("more", selection.further(F.col("c"), F.col("taken"), 3, 4, 6.0)).collect():
        taken = [*x.c[:2]]
        for c in x.c:
            if len(taken) < min(2 + 3, 4) and all(math.hypot(c.px - t.px, c.py - t.py) >= 6 for t in taken):
                taken.append(c)
        assert [m.n for m in x.more] == [t.n for t in taken[2:]]
    p = spark.createDataFrame([(1, 1, True), (1, 2, False), (1, 5, True), (2, 1, False), (2, 2, False), (3, 4, True)], "k int, n int, clear boolean")
    assert {x.k: x.n for x in selection.middle_picture(p, "k", "n", F.col("clear")).collect()} == {1: 1, 2: 1, 3: 4}


def test_roads_summary_and_latest_result(spark, tmp_path):
    import json

    rows = [(1, '{"type":"LineString","coordinates":[[0,0],[3,4]]}', " A "), (2, '{"type":"MultiLineString","coordinates":[[[0,0],[1,0]],[[5,5],[6,6],[7,7]]]}', "  "), (3, '{"type":"Point","coordinates":[1,2]}', "x"), (4, None, "y"), (5, "broken", None)]
    got = files.load_roads(spark.createDataFrame(rows, "fid int, g string, name string"), "fid", "g", "name").collect()
    assert sorted((x.road_fid, x.part, x.road_name, [(p.x, p.y) for p in x.path]) for x in got) == [(1, 1, "A", [(0, 0), (3, 4)]), (2, 1, None, [(0, 0), (1, 0)]), (2, 2, None, [(5, 5), (6, 6), (7, 7)])]
    for n in (1, 2):
        files.write_summary(spark.createDataFrame([("a", 1.5), ("b", float(n))], "k string, v double"), "k", "v", str(tmp_path / "summary.json"))
        assert json.loads((tmp_path / "summary.json").read_text()) == {"a": 1.5, "b": float(n)}
    names = spark.createDataFrame([("r", "result.gpkg"), ("r", "result_10.gpkg"), ("r", "result_9.gpkg"), ("s", "result.gpkg"), ("s", "result_x.gpkg"), ("t", "other.gpkg")], "run string, name string")
    assert {x.run: x.latest for x in files.latest_result(names, ["run"], "name").collect()} == {"r": "result_10.gpkg", "s": "result.gpkg"}
