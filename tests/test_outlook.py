"""Sight on outlines, cameras moved out of footprints, and shared areas, against plain Python."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import looks, outlook, overlap, selection, shapes

S = Settings()
RING = "unit_id string, building_id string, ord long, ring array<struct<x:double,y:double>>"
PANOS = "pano_id string, pano_date string, pano_ord long, px double, py double, own boolean"


def box(a, b, c, d):
    return [(float(x), float(y)) for x, y in ((a, b), (c, b), (c, d), (a, d))]


def star(r, cx, cy, big, turned=True):
    """A concave ring about a point, either way round."""
    n, turn = r.randrange(3, 9), r.random()
    ring = [(cx + m * math.cos(2 * math.pi * (k / n + turn)), cy + m * math.sin(2 * math.pi * (k / n + turn))) for k in range(n) for m in [r.uniform(big / 4, big)]]
    return ring[::-1] if turned and r.random() < 0.5 else ring


def units(spark, rings):
    return spark.createDataFrame([(k, k.split("_")[0], i, ring) for i, (k, ring) in enumerate(rings)], RING)


def cameras(spark, places, own=True):
    return spark.createDataFrame([(f"p{i}", "2026", i, float(x), float(y), own) for i, (x, y) in enumerate(places)], PANOS)


ROW = [("A", box(0, 2, 10, 12)), ("B", box(12, 2, 22, 12)), ("C", box(24, 2, 34, 12)), ("BACK", box(12, 14, 22, 24))]


def test_touching_is_exact():
    """Ends, corners and stretches in common touch; a millimetre beside doesn't."""
    walls = np.array([[0.0, 0.0, 10.0, 0.0], [0.0, 0.0, 0.0, 10.0]])
    at = lambda px, py, tx, ty: bool(outlook.hidden(px, py, np.array([tx]), np.array([ty]), walls)[0])
    assert at(5.0, -5.0, 5.0, 0.0) and not at(5.0, -5.0, 5.0, -0.001)
    assert at(-5.0, 5.0, 5.0, -5.0)  # through the corner
    assert at(-3.0, 0.0, 0.0, 0.0) and not at(-3.0, 0.0, -0.001, 0.0)  # along the wall's line
    assert at(2.0, 0.0, 4.0, 0.0) and not at(11.0, 0.0, 14.0, 0.0)
    assert at(1e6, 1.0, -1e6, 1.0) and not at(1e6, -0.001, -1e6, -0.001)


def test_shapes_of_too_few_points(spark):
    odd = units(spark, [*ROW, ("none", []), ("dot", [(5.0, 0.0)]), ("line", [(5.0, 0.0), (9.0, 0.0)])])
    panos = cameras(spark, [(17, -3)])
    assert shapes.broken(odd, "ring", True).count() == 3
    pairs = shapes.points_near(odd, panos, 30.0)
    assert {x.unit_id for x in pairs.collect()} == {"A", "B", "C", "BACK"}
    assert {x.unit_id: x.run for x in outlook.outline_looks(pairs, odd, S).collect()}.keys() == {"A", "B", "C", "BACK"}
    assert outlook.usable_panoramas(panos, odd, S).count() == 1
    assert overlap.neighbour_blockers(odd.select("ord", "ring"), units(spark, ROW), "ord", S).count() == 0
    assert overlap.neighbour_blockers(odd.select("ord", "ring"), units(spark, ROW).limit(0), "ord", S).count() == 0
    roads = spark.createDataFrame([(1, "r", []), (2, "r", [(0.0, 0.0)]), (3, "r", [(0.0, 0.0), (30.0, 0.0)])], "road_fid long, road_name string, path array<struct<x:double,y:double>>")
    assert shapes.broken(roads, "path", False).count() == 2
    assert [x.road_fid for x in shapes.split_paths(roads, shapes.path_cuts(roads, 1.0), 1.0, 10.0).collect()] == [3]


def test_cameras_leave_footprints(spark):
    houses = units(spark, ROW)
    x = {r.pano_id: r for r in outlook.usable_panoramas(cameras(spark, [(17, -3), (17, 3), (17, 7), (5, 2), (0, 2)]), houses, S).collect()}
    assert set(x) == {"p0", "p1", "p3", "p4"} and not x["p0"].snapped and not x["p3"].snapped and not x["p4"].snapped
    assert x["p1"].snapped and (x["p1"].px, round(x["p1"].py, 6)) == (17.0, 1.5)
    assert outlook.usable_panoramas(cameras(spark, [(17, -3)], own=False), houses, S).count() == 0
    # half a metre out is inside the next one, a metre isn't; and one behind which there is no room
    two = units(spark, [("A", box(0, 0, 10, 10)), ("B", box(10.2, 0, 10.8, 10)), ("C", box(0, 30, 10, 40)), ("D", box(10, 30, 20, 40))])
    x = {r.pano_id: r for r in outlook.usable_panoramas(cameras(spark, [(9, 5), (9, 35)]), two, S).collect()}
    assert set(x) == {"p0"} and round(x["p0"].px, 6) == 11.0
    turned = units(spark, [("T", [(0.0, 0.0), (8.0, 6.0), (2.0, 14.0), (-6.0, 8.0)])])
    (one,) = outlook.usable_panoramas(cameras(spark, [(4 - 0.6, 3 + 0.8)]), turned, S).collect()
    assert (round(one.px, 6), round(one.py, 6)) == (4.3, 2.6)


def plain_look(ring, cam, walls):
    """The points of a ring that a camera sees, and the cosine for those seen squarely; and the longest run."""
    pairs = lambda r: list(zip(r, r[1:] + r[:1], strict=True))
    mm = lambda v: math.floor(v * 1000 + 0.5)
    length = sum(math.dist(a, b) for a, b in pairs(ring))
    n = max(8, int(length / S.outline_step))
    points, done, todo = [], 0.0, pairs(ring)
    for i in range(n):
        at = i * length / n
        while len(todo) > 1 and at >= done + math.dist(*todo[0]):
            done += math.dist(*todo.pop(0))
        (ax, ay), (bx, by) = todo[0]
        k = (at - done) / math.dist(*todo[0])
        points.append((ax + (bx - ax) * k, ay + (by - ay) * k))
    area = sum(a[0] * b[1] - b[0] * a[1] for a, b in pairs(ring))
    side = lambda a, b, c: (lambda v: (v > 0) - (v < 0))((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))

    def meet(p, q, a, b):
        close = all(min(p[i], q[i]) <= max(a[i], b[i]) and max(p[i], q[i]) >= min(a[i], b[i]) for i in (0, 1))
        return close and side(p, q, a) * side(p, q, b) <= 0 and side(a, b, p) * side(a, b, q) <= 0

    seen, good = [], {}
    for i, (x, y) in enumerate(points):
        d = max(math.dist((x, y), cam), 1e-9)
        k = min(1, max(0, (d - S.sight_stop) / d))
        end = (mm(cam[0] + (x - cam[0]) * k), mm(cam[1] + (y - cam[1]) * k))
        seen.append(not any(meet((mm(cam[0]), mm(cam[1])), end, (mm(a[0]), mm(a[1])), (mm(b[0]), mm(b[1]))) for w in walls for a, b in pairs(w)))
        (ax, ay), (bx, by) = points[i - 1], points[(i + 1) % n]
        tx, ty = (bx - ax) / max(math.dist((ax, ay), (bx, by)), 1e-9), (by - ay) / max(math.dist((ax, ay), (bx, by)), 1e-9)
        cos = ((cam[0] - x) / d * ty - (cam[1] - y) / d * tx) * (1 if area > 0 else -1)
        if seen[-1] and cos >= S.square_on_cos:
            good[i] = cos
    turned = [(k + seen.index(False)) % n for k in range(n)] if False in seen else list(range(n))
    best, run = [], []
    for i in turned:
        run = [*run, i] if seen[i] else []
        best = run if len(run) > len(best) else best
    return points, seen, good, best


def test_looks_at_random_outlines(spark):
    r = random.Random(5)
    rings = [(f"u{i}", star(r, r.uniform(0, 90), r.uniform(0, 90), 9)) for i in range(12)]
    places = [(r.uniform(-10, 100), r.uniform(-10, 100)) for _ in range(25)]
    u, p = units(spark, rings), cameras(spark, places)
    got = outlook.outline_looks(shapes.points_near(u, p, 30.0), u, S).collect()
    assert len(got) > 60
    of = dict(rings)
    for x in got:
        points, seen, good, run = plain_look(of[x.unit_id], places[int(x.pano_id[1:])], [w for _, w in rings])
        assert x.n == len(points) and np.allclose(x.qx, [q[0] for q in points]) and list(x.visible) == seen and x.run == len(run)
        assert list(x.good or []) == list(good) and np.allclose(x.cos or [], list(good.values()))
        if run:
            cam = places[int(x.pano_id[1:])]
            assert math.isclose(x.near, min(math.dist(points[i], cam) for i in run))


def test_views_of_a_corner_plot(spark):
    """Two sides of a house get a view each, whichever way its ring is drawn."""
    for ring in (box(0, 2, 10, 12), box(0, 2, 10, 12)[::-1]):
        u = units(spark, [("A", ring)])
        seen = outlook.outline_looks(shapes.points_near(u, cameras(spark, [(5, -4), (11, -4), (-6, 7)]), 30.0), u, S)
        chosen = {x.pano_id for x in selection.choose_views(looks.candidates(seen, S), S).collect()}
        assert {"p0", "p2"} <= chosen


# ---------------------------------------------------------------------------------------------- shared areas


def sliced_area(a, b):
    """By level slices between all corners and crossings, in which widths change evenly."""
    pairs = lambda r: list(zip(r, r[1:] + r[:1], strict=True))
    ys = {y for _, y in a + b}
    for (p, q) in pairs(a):
        for (u, v) in pairs(b):
            det = (q[0] - p[0]) * (v[1] - u[1]) - (q[1] - p[1]) * (v[0] - u[0])
            if det:
                t = ((u[0] - p[0]) * (v[1] - u[1]) - (u[1] - p[1]) * (v[0] - u[0])) / det
                if 0 <= t <= 1:
                    ys.add(p[1] + (q[1] - p[1]) * t)

    def spans(ring, y):
        xs = sorted(p[0] + (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) for p, q in pairs(ring) if (p[1] > y) != (q[1] > y))
        return list(zip(xs[::2], xs[1::2], strict=True))

    ys, total = sorted(ys), 0.0
    for lo, hi in zip(ys, ys[1:], strict=False):
        middle = (lo + hi) / 2
        total += (hi - lo) * sum(max(0.0, min(p[1], q[1]) - max(p[0], q[0])) for p in spans(a, middle) for q in spans(b, middle))
    return total


def test_shared_areas():
    r = random.Random(6)
    a = [star(r, 0, 0, 10) for _ in range(200)]
    b = [star(r, r.uniform(-8, 8), r.uniform(-8, 8), 10) for _ in range(200)]
    same = [box(0, 0, 4, 4), box(0, 0, 4, 4), box(0, 0, 4, 4), [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0)], [(0.0, 0.0)], [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]]
    other = [box(0, 0, 4, 4)[::-1], box(4, 0, 8, 4), box(1, 1, 3, 3), box(0, 0, 4, 4), box(0, 0, 1, 1), box(0, 0, 1, 1)]
    ring = lambda x: [np.array(k).reshape(-1, 2) for k in x]
    got = overlap.shared(ring(a + same), ring(b + other))
    assert np.allclose(got[:200], [sliced_area(x, y) for x, y in zip(a, b, strict=True)], atol=1e-9) and (got[:200] > 1).sum() > 100
    assert np.allclose(got[200:], [16, 0, 4, 7, 0, 0])
    far = overlap.shared([np.array(box(700_000, 1_200_000, 700_010, 1_200_010))], [np.array(box(700_005, 1_200_005, 700_015, 1_200_015))])
    assert abs(far[0] - 25) < 1e-6


def test_rings_of_many_corners(monkeypatch):
    monkeypatch.setattr(overlap, "AT_ONCE", 64)
    circle = lambda cx, n: np.array([(cx + math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)])
    want = 2 * math.acos(0.5) - 0.5 * math.sqrt(3)
    assert np.allclose(overlap.shared([circle(0, 150)] * 3, [circle(1, 140), circle(3, 9), circle(0, 150)]), [want, 0, math.pi], atol=5e-3)


def test_second_drawings_are_dropped(spark):
    own = units(spark, ROW)
    others = spark.createDataFrame(
        [
            (1, [(1.0, 3.0), (11.0, 3.0), (11.0, 13.0), (1.0, 13.0)]),  # A again, a metre off
            (2, [(0.0, -20.0), (10.0, -20.0), (10.0, -10.0), (0.0, -10.0)]),  # across the street
            (3, [(9.0, 2.0), (13.0, 2.0), (13.0, 12.0), (11.0, 90.0), (9.0, 12.0)]),  # a fifth at most
            (4, [(300.0, 0.0), (310.0, 0.0), (310.0, 9.0)]),  # far away
            (5, [(-500.0, -500.0), (500.0, -500.0), (500.0, 500.0), (-500.0, 500.0)]),  # around all
            (6, [(34.0, 92.0), (114.0, 92.0), (114.0, 172.0)]),  # behind the grown box but for a corner of its bounds
            (7, [(100.0, 104.0), (114.0, 104.0), (114.0, 90.0), (130.0, 130.0)]),  # touches the box's corner
        ],
        "ord long, ring array<struct<x:double,y:double>>",
    )
    got = {x.ord: x.covered for x in overlap.neighbour_blockers(others, own, "ord", S).collect()}
    assert set(got) == {2, 3, 5, 6, 7} and got[2] == 0 and abs(got[5] - 400) < 1e-6 and abs(got[3] - 30 + 70 / 39) < 1e-6
    assert [round(x.a, 6) for x in others.where("ord in (1, 4)").orderBy("ord").select(overlap.area(F.col("ring")).alias("a")).collect()] == [100.0, 45.0]


def plain_choice(cands):
    """Views in turn, each that which adds most wall times quality; ties by score, then order."""
    chosen, covered = [], {}
    gain = lambda c: sum(max(0.0, v - covered.get(i, 0.0)) for i, v in c["wall"].items()) * 0.5
    while len(chosen) < S.max_views:
        free = [c for c in cands if c not in [k for k, _ in chosen] and all(math.dist(c["at"], k["at"]) >= S.views_apart for k, _ in chosen)]
        if not chosen:
            free = [c for c in free if c["near"] <= S.near_view_dist] or free
        if not free:
            break
        best = min(free, key=lambda c: (-round(gain(c) * c["quality"], 1), -c["score"], c["ord"]))
        new = round(gain(best), 1)
        if chosen and new < S.min_new_wall:
            break
        chosen.append((best, new))
        for i, v in best["wall"].items():
            covered[i] = max(covered.get(i, 0.0), v)
    return [(c["ord"], new) for c, new in chosen]


def test_views_are_chosen_in_turn(spark):
    r = random.Random(21)
    rows, want = [], {}
    for u in range(40):
        cands = []
        for o in range(r.randrange(1, 9)):
            wall = {i: r.choice([0.42, 0.6, 0.8, 1.0]) for i in r.sample(range(60), r.randrange(0, 40))}
            cands.append({"ord": o, "at": (float(r.randrange(20)), float(r.randrange(20))), "near": r.choice([8.0, 15.0, 16.0, 22.0]), "quality": r.choice([0.5, 0.8, 1.0]), "score": float(r.randrange(4)), "wall": wall})
        want[f"u{u}"] = plain_choice(cands)
        rows += [(f"u{u}", f"p{c['ord']}", c["ord"], *c["at"], c["near"], c["quality"], c["score"], list(c["wall"]), list(c["wall"].values()), 0.5) for c in cands]
    schema = "unit_id string, pano_id string, pano_ord long, px double, py double, dist_near double, quality double, score double, i array<int>, cos array<double>, step double"
    got = {}
    for x in selection.choose_views(spark.createDataFrame(rows, schema), S).orderBy("unit_id", "nth").collect():
        got.setdefault(x.unit_id, []).append((int(x.pano_id[1:]), x.new_wall_m))
    assert got == want and any(len(v) > 2 for v in want.values())


def test_pairs_of_one_plan_and_asked_columns_only(spark):
    """A pair is made once, stays without walls around it, and leaves unasked columns in the task; far walls are exact as well."""
    u = units(spark, ROW[:1])
    p, none = shapes.points_near(u, cameras(spark, [(5, -4)]), 30.0), u.where("false")
    x = outlook.outline_looks(p, none, S, unasked=("qx", "qy", "visible"))
    assert not {"qx", "qy", "visible"} & set(x.columns) and [r.run for r in x.collect()] == [r.n for r in x.collect()]
    plan = outlook.outline_looks(p, u, S)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # pairs, and their walls
    r = np.random.default_rng(17)
    for far in (0.0, 700_000.0):  # the camera in the middle of the walls, or so far off that products are no exact floats
        walls, t = r.integers(-40, 40, (30, 4)).astype(float), r.integers(-40, 40, (50, 2)).astype(float)
        got = outlook.hidden(far, -far, t[:, 0], t[:, 1], walls)
        want = [any(touching((far, -far), tuple(q), tuple(w)) for w in walls) for q in t]
        assert got.tolist() == want
    assert not outlook.hidden(0.0, 0.0, t[:, 0], t[:, 1], np.empty((0, 4))).any()


def touching(p, q, w):
    """The same in whole numbers of any size."""
    (px, py), (qx, qy), (ax, ay, bx, by) = ([round(v * 1000) for v in t] for t in (p, q, w))
    side = lambda x0, y0, x1, y1, x, y: (d := (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0)) and (1 if d > 0 else -1)
    near = min(px, qx) <= max(ax, bx) and max(px, qx) >= min(ax, bx) and min(py, qy) <= max(ay, by) and max(py, qy) >= min(ay, by)
    return near and side(px, py, qx, qy, ax, ay) * side(px, py, qx, qy, bx, by) <= 0 and side(ax, ay, bx, by, px, py) * side(ax, ay, bx, by, qx, qy) <= 0


def test_pairs_are_looked_at_together(monkeypatch):
    """Pairs of rings with equally many points are described at once, each as it is alone, whatever the others' edges, walls and order."""
    r, calls = random.Random(5), []
    ring = lambda points: np.array([(*a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)])
    rings = [ring(box(0, 0, 6 + i % 3, 8)) if i % 2 else ring(star(r, 0, 0, 9.0)) for i in range(40)]
    px, py = (np.array([r.uniform(-20, 20) for _ in rings]) for _ in "xy")
    walls = [np.concatenate([e, *(ring(star(r, r.uniform(-15, 15), r.uniform(-15, 15), 4.0)) for _ in range(i % 4))]) if i % 5 else np.empty((0, 4)) for i, e in enumerate(rings)]
    one = outlook.describe
    monkeypatch.setattr(outlook, "describe", lambda *a: calls.append(len(a[0])) or one(*a))
    got = outlook.look(rings, px, py, walls, looks.NAMES, S)
    assert sum(calls) == 40 and max(calls) > 3
    for i in range(40):
        alone = outlook.look([rings[i]], px[i : i + 1], py[i : i + 1], [walls[i]], looks.NAMES, S)
        assert all(np.array_equal(got[c][i], alone[c][0], equal_nan=got[c].dtype == float) for c in looks.NAMES), i


def test_units_choose_views_in_rows(spark):
    """No frame is made for each unit: tasks read their units one after the other, whichever batch they are in."""
    row = lambda u, k: (f"u{u}", f"p{k}", k, 10.0 * k, 0.0, 9.0, 1.0, 5.0 - k, [0, 1 + k], [0.5, 0.9], 0.5)
    c = spark.createDataFrame([row(u, k) for k in range(3) for u in range(5)], "unit_id string, pano_id string, pano_ord long, px double, py double, dist_near double, quality double, score double, i array<int>, cos array<double>, step double")
    x = selection.choose_views(c, S)
    assert "FlatMapGroupsInPandas" not in x._jdf.queryExecution().optimizedPlan().toString()
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)  # units lie across batches
    try:
        got = sorted(tuple(v) for v in x.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert {u for u, *_ in got} == {f"u{u}" for u in range(5)} and all([v[1:] for v in got if v[0] == u] == [v[1:] for v in got if v[0] == "u0"] for u in ("u1", "u4"))
    assert got[0][:3] == ("u0", 1, "p0") and got[0][3] == 0.7
