"""Joins, sight, choices, rules, merges and streets on small cases."""

import contextlib
import io
import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators import grid, looks, merge, names, network, rules, selection, sight, streets
from gablewise.plans import streets as street_plans
from gablewise.sources import files
from gablewise.streaming import clicks

S = Settings()
HOUSES = [("A", 0.0, 2.0, 10.0, 12.0), ("B", 12.0, 2.0, 22.0, 12.0), ("C", 24.0, 2.0, 34.0, 12.0), ("BACK", 12.0, 14.0, 22.0, 24.0)]
UNIT = "unit_id string, x0 double, y0 double, x1 double, y1 double"
PANO = "pano_id string, pano_date string, pano_ord long, px double, py double"


def look(spark, points):
    units = spark.createDataFrame(HOUSES, UNIT)
    panos = spark.createDataFrame([(f"p{i}", "2026-02", i, float(x), float(y)) for i, (x, y) in enumerate(points)], PANO)
    return sight.outline_looks(sight.sight_pairs(units, panos, 30.0), units, S)


def test_sight_of_a_row_of_houses(spark):
    seen = look(spark, [(17, -3)])
    assert {r.unit_id for r in looks.outline_sights(seen).where("visible").collect()} == {"A", "B", "C"}
    c = {r.unit_id: r for r in looks.candidates(seen, S).collect()}
    assert c["B"].dist_near == pytest.approx(5, abs=0.3)
    assert 8 <= c["B"].apparent_m <= 11
    assert sorted((c["B"].left_x, c["B"].right_x)) == pytest.approx([12, 22], abs=0.6)
    assert c["B"].visible_m < 20


def test_longest_run_wraps_around_the_ring():
    run = lambda *flags: looks.longest_run(np.array(flags, bool)).tolist()
    assert run(1, 1, 0, 1, 0, 1, 1) == [5, 6, 0, 1]
    assert run(1, 1, 1) == [0, 1, 2] and run(0, 0, 0) == [] and run(0, 1, 0, 1) == [1] and run(1, 0, 1, 0) == [2]
    assert run(1, 0, 0, 1, 1, 0, 1) == [3, 4]  # of two runs of two the first after the first hidden place


def test_views_go_to_other_walls(spark):
    x = look(spark, [(5, -4), (5, -4.5), (-6, 7)])
    chosen = selection.choose_views(looks.candidates(x, S), S)
    got = [r.pano_id for r in chosen.where("unit_id = 'A'").orderBy("nth").collect()]
    assert "p2" in got and len(set(got) & {"p0", "p1"}) == 1


def test_distance_joins_equal_brute_force(spark):
    import random

    r = random.Random(4)
    rects = [(i, x := r.uniform(-80, 80), y := r.uniform(-80, 80), x + r.uniform(0, 90), y + r.uniform(0, 20)) for i in range(60)]
    points = [(i, r.uniform(-90, 90), r.uniform(-90, 90)) for i in range(80)]
    dist = lambda a, b: (max(a[0] - b[2], 0, b[0] - a[2]) ** 2 + max(a[1] - b[3], 0, b[1] - a[3]) ** 2) ** 0.5
    a = spark.createDataFrame(rects, "i long, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame(points, "j long, px double, py double")
    got = sorted((x.i, x.j) for x in grid.points_within(a, p, 12.0).collect())
    assert got == sorted((i, j) for i, *b in rects for j, px, py in points if dist(b, (px, py, px, py)) <= 12)
    b = a.toDF("j", "u0", "v0", "u1", "v1")
    got = sorted((x.i, x.j) for x in grid.boxes_within(a, b, 5.0, ("x0", "y0", "x1", "y1"), ("u0", "v0", "u1", "v1"), 20.0).collect())
    assert got == sorted((i, j) for i, *c in rects for j, *d in rects if dist(c, d) <= 5)


def test_spread_prefers_other_sides(spark):
    c = [(1.0, 1, 0.0), (2.0, 2, 10.0), (3.0, 3, 180.0), (4.0, 4, 90.0), (5.0, 5, 270.0), (6.0, 6, 45.0)]
    df = spark.createDataFrame([(c,)], "c array<struct<dist:double,ord:long,side:double>>")
    assert [k.ord for k in df.select(selection.spread(F.col("c"), 4, 60.0).alias("x")).first().x] == [1, 3, 4, 5]
    df = spark.createDataFrame([(c[:2],)], "c array<struct<dist:double,ord:long,side:double>>")
    assert [k.ord for k in df.select(selection.spread(F.col("c"), 4, 60.0).alias("x")).first().x] == [1, 2]


def test_choices_in_turn_take_nothing_twice(spark):
    df = spark.createDataFrame([("s", 1, [(0, 1.0, 7), (1, 1.0, 8)]), ("s", 2, [(0, 2.0, 7), (1, 3.0, 9)]), ("s", 3, [(0, 1.0, 7)])], "k string, n int, cands array<struct<new:int,dist:double,ord:long>>")
    assert [(r.n, r.pick) for r in selection.choose_in_turn(df, "k").orderBy("n").collect()] == [(1, 7), (2, 9), (3, None)]


def test_clicks_as_of(spark):
    t0 = datetime(2026, 1, 1)
    marks = spark.createDataFrame([(t0 + timedelta(seconds=s), u) for s, u in ((0, 1), (60, 2), (120, 3))], "ts timestamp, u long")
    shots = spark.createDataFrame([(n, t0 + timedelta(seconds=s)) for n, s in (("a", 15), ("b", 30), ("c", 61), ("d", 150), ("e", 420), ("f", -5), ("g", 62), ("h", 360))], "name string, ts timestamp")
    for width in (50, 3600):
        got = {r.name: (r.reason, r.mark) for r in merge.as_of(shots, marks, "ts", "u", 2, 240, width).collect()}
        assert got == {"a": ("ok", 1), "b": ("ok", 1), "c": ("too soon", None), "d": ("ok", 3), "e": ("too long", None), "f": ("before first", None), "g": ("ok", 2), "h": ("ok", 3)}


def test_streamed_clicks_equal_batch(spark, tmp_path):
    t0 = datetime(2026, 1, 1)
    ev = [(i, t0 + timedelta(seconds=37 * i), i % 5, "click" if i % 3 == 0 else "view") for i in range(60)]
    spark.createDataFrame(ev, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").parquet(str(tmp_path / "in"))
    m = clicks.candidate_matches(stream.where("event_type <> 'click'"), stream.where("event_type = 'click'"), S)
    q = m.writeStream.format("memory").queryName("matches").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.event_id, r.mark) for r in clicks.last_click(spark.table("matches"), S).collect()}
    e = spark.createDataFrame(ev, "event_id long, ts timestamp, user_id long, event_type string")
    want = merge.as_of(e.where("event_type <> 'click'").select("event_id", "ts"), e.where("event_type = 'click'").select("ts", "user_id"), "ts", "user_id", 2, 240, 600)
    assert got == {(r.event_id, r.mark) for r in want.where("reason = 'ok'").collect()}


def test_latest_answers_note_disagreement(spark):
    rows = [("B", 1, 1, "R1", "yes"), ("B", 2, 2, "R2", "no"), ("A", 1, 3, "R1", "yes"), ("A", 2, 4, "R1", "no")]
    df = spark.createDataFrame(rows, "u string, t int, o int, by string, ident string")
    got = {r.u: r for r in merge.latest_answers(df, "u", "t", "o", "by", ("ident",)).collect()}
    assert got["B"].ident == "no" and got["B"].note == "earlier answer by R1: yes"
    assert got["A"].ident == "no" and got["A"].note is None


def test_carry_over_keeps_the_last_that_says_something(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    edits = spark.createDataFrame([("a", 1, "x", None), ("a", 2, " ", None), ("c", 3, "z", None)], "k string, p int, note string, s string")
    assert sorted((r.k, r.note) for r in merge.carry_over(rows, edits, ["k"], ["note", "s"], "p").collect()) == [("a", "x"), ("b", None)]


def test_verdict_order(spark):
    base = {"access": "street-facing", "error": None, "n_runs": 1, "n_usable": 2, "n_agree": 2, "ref_marks": "yes", "aerial": "yes", "core_ok": True, "second_required": False, "hidden_by": "tree", "own_hits": "", "neighbour_hits": "", "features_both": False, "viewer_placed": False, "moved_away": None, "n_usable2": 2, "n_agree2": 2, "ref_marks2": "yes", "aerial2": "yes", "features_both2": False}
    cases = [({}, "Verified"), ({"access": "not visible"}, "Not visible"), ({"n_runs": 0, "error": "x"}, "Unsure"), ({"n_runs": 0}, "Pending"), ({"n_usable": 0}, "Not visible"), ({"neighbour_hits": "1 is X", "own_hits": "2"}, "Unsure"), ({"own_hits": "2", "n_agree": 1}, "Verified"), ({"n_agree": 1}, "Unsure"), ({"second_required": True}, "Unsure"), ({"n_runs": 2}, "Verified"), ({"n_runs": 2, "n_agree2": 1}, "Unsure"), ({"core_ok": False}, "Unsure"), ({"aerial": "no"}, "Unsure"), ({"aerial": "no", "features_both": True}, "Verified"), ({"viewer_placed": True, "n_agree": 1, "n_usable": 1}, "Verified"), ({"viewer_placed": True, "moved_away": "off"}, "Unsure"), ({"viewer_placed": True, "neighbour_hits": "1 is X"}, "Unsure")]
    schema = "i int, access string, error string, n_runs int, n_usable int, n_agree int, ref_marks string, aerial string, core_ok boolean, second_required boolean, hidden_by string, own_hits string, neighbour_hits string, features_both boolean, viewer_placed boolean, moved_away string, n_usable2 int, n_agree2 int, ref_marks2 string, aerial2 string, features_both2 boolean"
    df = spark.createDataFrame([(i, *(base | c).values()) for i, (c, _) in enumerate(cases)], schema)
    said, _ = rules.verdict({c: F.col(c) for c in df.columns})
    assert [r.v for r in df.select("i", said.alias("v")).orderBy("i").collect()] == [w for _, w in cases]


def test_the_named_reference_counts(spark):
    """The reference view is the one that the reading names; if that one is hidden, nothing can be concluded."""
    v = [(1, 1, "clear", None, "yes", "yes"), (1, 2, "clear", None, "yes", "no, two"), (1, 3, "hidden", "tree", "no", "yes")]
    views = spark.createDataFrame(v, "k int, view int, target_visible string, hidden_by string, same_as_ref string, between_marks string")
    for named, want in ((None, (1, "yes", 2)), (2, (2, "no, two", 2)), (3, (None, None, 0)), (9, (None, None, 0))):
        r = rules.view_summary(views, "k", spark.createDataFrame([(1, named)], "k int, reference_view int")).first()
        assert (r.ref_view, r.ref_marks, r.n_agree) == want
    assert rules.view_summary(views, "k").first().ref_view == 1
    x = spark.createDataFrame([(1, 1, "Mixed", "mixed."), (1, 1, "Mixed", "Office"), (1, 2, "Mixed", "Mixed"), (None, None, "", "")], "a int, b int, u string, w string")
    assert [r.v for r in x.select(rules.runs_agree(*map(F.col, "abuw")).alias("v")).collect()] == [True, False, False, True]


def test_stretches_that_share_a_short_id_all_stay(spark):
    lines = spark.range(0, 12_000).selectExpr("id as road_fid", "0e0 as x0", "id * 24e0 as y0", "100e0 as x1", "id * 24e0 as y1", "'r' as road_name")
    again = lines.where("road_fid < 3").selectExpr("road_fid + 20000 as road_fid", "x1 as x0", "y1 as y0", "x0 as x1", "y0 as y1", "road_name")
    none = spark.createDataFrame([], "road_fid long, cut double")
    got = streets.split_lines(lines.unionByName(again), none, 1.0, 10.0).select("stretch_id", "road_fid").collect()
    assert len({x.stretch_id for x in got}) < 12_000  # by chance
    assert sorted(x.road_fid for x in got) == list(range(12_000))


def test_split_lines(spark):
    lines = spark.createDataFrame([(0, "r", 0.0, 0.0, 100.0, 0.0), (1, "c", 50.0, -40.0, 50.0, 40.0), (2, "e", 80.0, 0.6, 80.0, 30.0)], "road_fid long, road_name string, x0 double, y0 double, x1 double, y1 double")
    s = streets.split_lines(lines, streets.junction_cuts(lines, 1.0), 1.0, 10.0)
    assert sorted(r.length_m for r in s.collect()) == [20.0, 29.4, 30.0, 40.0, 40.0, 50.0]
    p = streets.points_along(spark.createDataFrame([("s", 0.0, 0.0, 0.0, 230.0)], "k string, x0 double, y0 double, x1 double, y1 double"), "k", 50.0)
    assert [r.along_m for r in p.orderBy("n").collect()] == [23, 69, 115, 161, 207]
    assert {r.heading for r in p.collect()} == {0.0}


def test_front_gaps(spark):
    line = spark.createDataFrame([("s", 0.0, 0.0, 100.0, 0.0)], "k string, x0 double, y0 double, x1 double, y1 double")
    boxes = spark.createDataFrame([(0.0, 4.0, 100.0, 14.0), (0.0, -20.0, 50.0, -5.0)], "x0 double, y0 double, x1 double, y1 double")
    g = network.front_gaps(street_plans.with_paths(line), "k", street_plans.with_rings(boxes), 10.0, 25.0).first()
    assert (g.samples, g.both, g.median_m, g.min_m) == (10, 5, 9.0, 9.0)


def test_names_are_decided_by_rule(spark):
    schema = "s int, ord int, name string, kind string, unit_id string, dist_m double"
    board, shop = "street_name_board", "shop_address"
    e = [
        (1, 1, "Gandhi Street", board, "a", 1.0), (2, 1, "Nehru Road", board, "a", 1.0), (3, 1, "Nehru Road", shop, "a", 1.0), (3, 2, "Nehru Rd", shop, "b", 1.0),
        (4, 1, "Nehru Road", board, "a", 1.0), (4, 2, "Kamaraj Street", board, "b", 1.0), (6, 1, "Nehru Road", shop, "a", 1.0), (6, 2, "Nehru Road", shop, "a", 1.0), (7, 1, "Anna Salai", "other", "a", 1.0),
    ]
    c = [(1, "Gandi Street"), (2, "Gandhi Street"), (3, None), (4, None), (5, "Lonely Lane"), (6, None), (7, None)]
    got = {r.s: (r.name, r.rule, r.fix) for r in names.decide_names(spark.createDataFrame(e, schema), spark.createDataFrame(c, "s int, candidate string"), "s").collect()}
    assert got[1] == ("Gandhi Street", "a", False)
    assert got[2] == ("Nehru Road", "b", True)
    assert got[3] == ("Nehru Road", "c", False)
    assert got[4][1] == "conflict" and got[5] == ("Lonely Lane", "d", False)
    assert got[6] == ("Nehru Road", "none", False) and got[7] == ("Anna Salai", "none", False)


def test_names_that_come_again_are_not_compared_again(monkeypatch):
    """Groups are those of a loop over all; each two names are compared once, however often they come."""
    compared, matcher = [], names.difflib.SequenceMatcher
    monkeypatch.setattr(names.difflib, "SequenceMatcher", lambda _, a, b: compared.append((a, b)) or matcher(None, a, b))
    every = ["Gandhi Road", "Gandi Road", "Gandhii Roadd", "Nehru Street", "gandhi road", "Gandhi Roaddd"] * 50
    at, heads = names.first_groups(every, [None] * len(every))
    assert at == [0, 0, 0, 1, 0, 0] * 50 and heads == ["Gandhii Roadd", "Nehru Street"]
    assert len(compared) == len(set(compared)) < 20


def test_layers_are_published_whole(spark, tmp_path):
    path = str(tmp_path / "layer")
    assert files.publish(spark.range(5).toDF("a"), path) == 5
    assert files.publish(spark.range(7).toDF("a"), path) == 7
    assert files.read_or_empty(spark, path, "a long").count() == 7
    assert files.read_or_empty(spark, str(tmp_path / "none"), "a long").count() == 0


def test_settings(tmp_path):
    p = tmp_path / "s.toml"
    p.write_bytes(b"\xef\xbb\xbfmax_links = 3\n")
    assert Settings.load(p).max_links == 3
    p.write_text("nothing_known = 1\n")
    with pytest.raises(ValueError, match="nothing_known"):
        Settings.load(p)


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_joins_by_cells_send_no_table_to_all_tasks(spark, small):
    from gablewise.plans import catalogue

    for name in ("join_units_panos_30m", "neighbour_letters", "zoom_view", "access_class", "outline_access"):
        assert "BroadcastHashJoin" not in plan_of(catalogue.QUERIES[name](spark, small)), name


def test_search_points_meet_where_their_cell_is(spark):
    from gablewise.plans.spatial import points_around

    boxes = [(0.0, 0.0, 12.0, 9.0), (30.0, 4.0, 41.0, 17.0), (-200.0, -3.0, -190.0, 8.0)]
    got = points_around(spark.createDataFrame(boxes, "x0 double, y0 double, x1 double, y1 double"), 5.0, 40.0)
    assert "hashpartitioning(px" not in plan_of(got)
    gap = lambda x, y: min(math.hypot(max(a - x, 0, x - c), max(b - y, 0, y - d)) for a, b, c, d in boxes)
    want = {(x * 5.0, y * 5.0) for x in range(-60, 30) for y in range(-20, 20) if 0 < gap(x * 5.0, y * 5.0) < 40}
    assert sorted((r.x, r.y) for r in got.collect()) == sorted(want)


def test_sides_of_rays_are_named_by_where_they_point(spark):
    path = "array(struct(x0 as x, y0 as y), struct(x1 as x, y1 as y))"
    roads = spark.createDataFrame([("k", 0.0, 0.0, 30.0, 0.0), ("k", 1000.0, 0.0, 1000.0, 30.0)], "key string, x0 double, y0 double, x1 double, y1 double").selectExpr("key", f"{path} as path")
    walls = spark.createDataFrame([(0.0, 5.0, 30.0, 9.0), (1003.0, 0.0, 1009.0, 30.0)], "x0 double, y0 double, x1 double, y1 double")
    x = network.front_gaps(roads, "key", street_plans.with_rings(walls), 10.0, 25.0).first()
    assert (x.samples, x.both) == (6, 0)  # one side, above and to the right


def test_spread_is_one_fold(spark):
    """The chosen ones are not found anew for each of the others; equal numbers don't come twice."""
    df = spark.createDataFrame([([(1.0, 1, 0.0), (2.0, 2, 10.0), (3.0, 3, 90.0), (4.0, 2, 20.0), (5.0, 5, 15.0)],)], "c array<struct<dist:double,ord:long,side:double>>")
    x = df.select(selection.spread(F.col("c"), 4, 60.0).alias("x"))
    assert x._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [k.ord for k in x.first().x] == [1, 3, 2, 2]
