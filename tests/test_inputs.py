"""What an audit takes in: footprints of several parts, readings in codes, places in degrees, the text of signs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gablewise.functions import geo
from gablewise.model import Settings
from gablewise.operators import names, parts, readings
from gablewise.plans.signs import extracted
from gablewise.sources import files

BUILDINGS = "building_id string, road string, usage string, storeys double, parts array<array<struct<x:double,y:double>>>"


def square(x, y, side):
    return [(float(x), float(y)), (float(x + side), float(y)), (float(x + side), float(y + side)), (float(x), float(y + side))]


def test_units_of_several_parts(spark):
    notch = [(0.0, 0.0), (6.0, 0.0), (6.0, 3.0), (3.0, 3.0), (3.0, 6.0), (0.0, 6.0)]  # 27 m2
    rows = [
        ("A", " r ", " Mixed ", 2.0, [square(0, 0, 3), square(50, 0, 4), notch[::-1]]),  # 9, 16 and 27 m2
        ("B", None, None, None, [square(0, 90, 2)]),  # small, but the largest
        ("C", "r", "x", 1.0, [square(0, 0, 4), square(9, 9, 4), [(0.0, 0.0), (1.0, 1.0)]]),  # equally large; a line is no part
        ("D", "r", "x", 1.0, []), ("E", "r", "x", 1.0, None), ("F", "r", "x", 0.0, [[], square(700_000, 1_200_000, 5)]),
    ]
    got = {r.unit_id: r for r in parts.load_units(spark.createDataFrame(rows, BUILDINGS), Settings()).collect()}
    assert {k: (r.part, r.n_parts, round(r.area, 6)) for k, r in got.items()} == {"A_p1": (1, 2, 27.0), "A_p2": (2, 2, 16.0), "B": (1, 1, 4.0), "C_p1": (1, 2, 16.0), "C_p2": (2, 2, 16.0), "F": (1, 1, 25.0)}
    assert (got["A_p1"].road, got["A_p1"].usage, got["A_p1"].storeys) == (" r ", "Mixed", 2) and got["B"].usage is None
    assert got["C_p1"].ring[0].x == 0 and got["C_p2"].ring[0].x == 9
    assert parts.load_units(spark.createDataFrame([], BUILDINGS), Settings()).count() == 0


def test_repeated_unit_ids_are_an_error(spark):
    twice = spark.createDataFrame([("A", "r", "x", 1.0, [square(0, 0, 9)]), ("A", "r", "x", 1.0, [square(20, 0, 9)])], BUILDINGS)
    with pytest.raises(Exception, match="repeated unit id A"):
        parts.load_units(twice, Settings()).collect()


NOTES = "u string, v array<struct<vis:string,same:string,between:string,what:string,hidden_by:string,boards:array<string>>>"


def test_readings_are_expanded_and_checked(spark):
    view = lambda vis, same, between="y", by=None, boards=None: (vis, same, between, "a house", by, boards)
    rows = [
        ("fine", [view("c", "r", boards=["SHOP"]), view("p", "y", "n2"), view("h", "?", "?", "tree"), view("h", "n", "np")]),
        ("hidden", [view("h", "r"), view("h", "r")]), ("none", [view("c", "y")]), ("two", [view("c", "r"), view("c", "r")]),
        ("behind", [view("h", "r"), view("c", "y")]), ("code", [view("z", "r")]), ("null", [view("c", "r", None)]), ("more", [view("c", "r")]), ("stray", [view("c", "r")]), ("empty", None),
    ]
    plan = [("fine", 4), ("hidden", 2), ("none", 1), ("two", 2), ("behind", 2), ("code", 1), ("null", 1), ("more", 3), ("empty", 0), ("unread", 1)]
    checked = readings.validated(spark.createDataFrame(rows, NOTES), spark.createDataFrame(plan, "u string, n_views int"), "u")
    valid, rejected = readings.split(checked)
    assert {r.u: r.reason for r in rejected.collect()} == {
        "none": "0 reference views", "two": "2 reference views", "behind": "the reference view is hidden", "code": "unknown code", "null": "unknown code", "more": "1 views in the note, 3 planned", "stray": "not planned",
    }
    got = {r.u: r for r in valid.collect()}
    assert set(got) == {"fine", "hidden", "empty"} and got["hidden"].reference_view is None and got["empty"].views == []
    f = got["fine"]
    assert (f.reference_view, f.based_on) == (1, [1, 2])
    assert [(v.view, v.target_visible, v.hidden_by, v.one_building_between_marks, v.same_building_as_reference, v.boards_read) for v in f.views] == [
        (1, "clear", "nothing", "yes", "this is the reference view", ["SHOP"]), (2, "partly hidden", "nothing", "no, more than one", "yes", []),
        (3, "hidden", "tree", "cannot tell", "cannot tell", []), (4, "hidden", "other", "no, only part of a larger building", "no", []),
    ]


def test_metres_and_degrees(spark):
    r = random.Random(3)
    places = [(711679.6, 1219908.4)] + [(r.uniform(170_000, 830_000), r.uniform(0, 9_000_000)) for _ in range(300)]
    d = spark.createDataFrame(places, "x double, y double").withColumn("d", geo.utm_to_degrees(F.col("x"), F.col("y"))).withColumn("m", geo.degrees_to_utm(F.col("d.lat"), F.col("d.lon")))
    rows = d.collect()
    assert all(math.dist((q.x, q.y), (q.m.x, q.m.y)) < 1e-4 for q in rows)
    assert str(rows[0].d.lat).startswith("11.029") and str(rows[0].d.lon).startswith("76.937")
    # along the middle of a zone the length of the meridian is known: a quarter of it has 10,001,965.729 m
    pole = spark.range(1).select(geo.degrees_to_utm(F.lit(90.0), F.lit(75.0)).alias("m"), geo.degrees_to_utm(F.lit(0.0), F.lit(78.0)).alias("o")).first()
    assert abs(pole.m.y - 0.9996 * 10_001_965.729) < 0.01 and abs(pole.m.x - 500_000) < 1e-6 and abs(pole.o.y) < 1e-6
    path = spark.createDataFrame([([(711679.6, 1219908.4), (711700.0, 1219950.0)],)], "p array<struct<x:double,y:double>>")
    there = path.select(geo.path_in_metres(geo.path_in_degrees(F.col("p"))).alias("p")).first().p
    assert [(round(q.x, 4), round(q.y, 4)) for q in there] == [(711679.6, 1219908.4), (711700.0, 1219950.0)]


def test_what_signs_say(spark):
    def read(lines, panel=None):
        return extracted(spark.createDataFrame([(1, lines, panel)], "k int, lines array<string>, panel array<string>"), "k").first()

    board = read(["Coimbatore City Municipal Corporation", "NSR ROAD", "Ward 44"])
    assert (board.kind, board.roads) == ("street_name_board", "NSR Road")
    shop = read(["K.R. BAKES", "No. 12/3, N.S.R. Road, Saibaba Colony", "Coimbatore - 641 011"])
    assert (shop.kind, shop.doors, shop.pins) == ("shop_address", "12/3", "641011") and shop.roads.startswith("N.S.R. Road")
    # of names that mean one road the longest stays, and a street comes before a colony whatever its length
    several = read(["Gandhinagar Housing Colony", "Ramasamy Street", "Ramaswamy Street", "4th Cross", "Nehru Street", "Old Mill Lane"])
    assert several.roads.split("; ")[0] == "Ramaswamy Street" and "Ramasamy" not in several.roads and len(several.roads.split("; ")) == 3
    assert read(["OPEN", "SALE 50%"]).roads == "" and read([]).roads == "" and read([]).google_address is None
    own = read(["Search Google Maps", "SAI NUTS"], ["Dec 2022", "9 Ramasamy St", "Other Road"])
    assert (own.roads, own.google_address, own.shops) == ("", "9 Ramasamy Street", "SAI NUTS")


def test_a_decision_has_a_status(spark):
    e = [
        (1, 0, "N.S.R. Road", "street_name_board", "A", 10.0), (2, 0, "NSR Road", "street_name_board", "A", 10.0), (3, 0, "NSR Road", "street_name_board", "A", 10.0),
        (4, 0, "Mill Street 3", "street_name_board", "A", 1.0), (4, 1, "Mill Street 4", "street_name_board", "B", 2.0), (5, 0, "Mill Street", "shop_address", "A", 1.0), (5, 1, "Mill St", "shop_address", "B", 1.0),
        (6, 0, "Mill Street", "shop_address", "A", 1.0), (7, 0, "Mill Street", "shop_address", "A", 1.0),
    ]
    c = [(1, "NSR Road"), (2, "Main_road"), (3, None), (6, "Hill Street"), (8, None)]
    d = names.decide_names(spark.createDataFrame(e, "s int, ord int, name string, kind string, unit_id string, dist_m double"), spark.createDataFrame(c, "s int, candidate string"), "s")
    assert {r.s: r.status for r in d.collect()} == {
        1: "Accepted - board confirms", 2: "Board overrides road layer", 3: "Accepted - board (no road layer name)", 4: "Conflict - needs review", 5: "Accepted - shop addresses agree",
        6: "Unverified - road layer only", 7: "Unverified - single sign only", 8: "No name found",
    }


def test_last_notes_and_vanished_ones(spark, tmp_path):
    for n, lines in enumerate((['{"u":"A","t":"old"}', '{"u":"B","t":"only"}'], ['{"u":"A","t":"new"}', '{"u":"A","t":"last"}'])):
        (tmp_path / f"notes_{n}.json").write_text("\n".join(lines))
    got = files.last_notes(spark, str(tmp_path), "u string, t string", "u")
    assert {r.u: r.t for r in got.collect()} == {"A": "last", "B": "only"}


def test_pictures_of_units(spark):
    units = spark.createDataFrame([("44WN1", "44WN1", 1), ("44WN2_p1", "44WN2", 1), ("44WN2_p2", "44WN2", 2), ("7", "7", 1)], "unit_id string, building_id string, part int")
    names = ["44WN1.png", "44wn1_2.PNG", "44wn1-3.jpeg", "44WN2.jpg", "44wn2_P2.webp", "44WN2_p2_4.png", "7.png", "44WN9.png", "notes.txt", "44WN1", "cat.png", "44WN1_2_3.png", "", None]
    got = {r["name"]: (r.unit_id, r.n) for r in parts.match_files(spark.createDataFrame([(n,) for n in names], "name string"), units).collect()}
    assert got == {
        "44WN1.png": ("44WN1", 1), "44wn1_2.PNG": ("44WN1", 2), "44wn1-3.jpeg": ("44WN1", 3), "44WN2.jpg": ("44WN2_p1", 1), "44wn2_P2.webp": ("44WN2_p2", 1), "44WN2_p2_4.png": ("44WN2_p2", 4),
        "7.png": ("7", 1), "44WN9.png": (None, None), "cat.png": (None, None), "44WN1_2_3.png": (None, None),
    }
