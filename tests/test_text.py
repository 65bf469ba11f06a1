import pytest
from pyspark.sql import functions as F

from gablewise.functions import signs, text


def each(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_doors(spark):
    given = ["No. 4-1", "door no: 62 / 2", "16-Jul", "Jan-13", "#7", " 12a ", "D.No.5", "NORTH 5"]
    assert each(spark, text.norm_door, given) == ["4/1", "62/2", "16/7", "1/13", "7", "12A", "5", "RTH5"]


def test_zones(spark):
    assert each(spark, text.norm_zone, ["ZONE-B", "zone a", "C", "#N/A", "0", None]) == ["B", "A", "C", None, None, None]


def test_name_keys(spark):
    keys = each(spark, text.name_key, ["Chinnamal street", "CHINNAMMAL STREET", "Chinnammal St", "Chinthamani St-3", "Chinthamanistreet 3"])
    assert len(set(keys[:3])) == 1
    assert keys[3] == keys[4]


@pytest.mark.parametrize(("a", "b", "want"), [("alagana", "alaganan", True), ("x3", "x4", False), ("raman3", "raman4", False), ("abc", "abc", True), ("kannan", "muthu", False)])
def test_similar_keys(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(text.similar_keys(F.col("a"), F.col("b")).alias("x")).first().x is want


def test_road_names(spark):
    assert each(spark, signs.normal_name, ["nsr main rd", "N.S.R. ROAD", "first st", "No. 12/3, gandhi st", "", "காந்தி தெரு"]) == ["Nsr Main Road", "N.S.R. Road", "1st Street", "Gandhi Street", None, "காந்தி தெரு"]


def sign(spark, lines):
    df = spark.createDataFrame([(lines,)], "lines array<string>")
    t = signs.sign_text(F.col("lines"))
    return df.select(signs.sign_kind(F.col("lines")).alias("kind"), signs.doors(t).alias("doors"), signs.pins(t).alias("pins"), signs.raw_roads(F.col("lines")).alias("roads"), signs.shop_lines(F.col("lines")).alias("shops")).first()


def test_signs(spark):
    board = sign(spark, ["Coimbatore City Municipal Corporation", "Gandhi Street"])
    assert board.kind == "street_name_board"
    shop = sign(spark, ["Ram Stores", "No. 12/3, Gandhi Street", "641 001", "Google Street View"])
    assert (shop.kind, shop.doors, shop.pins) == ("shop_address", ["12/3"], ["641001"])
    assert shop.shops == ["Ram Stores"]
    assert sign(spark, ["GST No: 33CHPPR1234", "Ph No 98765"]).doors == []
    assert sign(spark, ["hello"]).kind == "other"


@pytest.mark.parametrize(("a", "b", "want"), [("Gandhi Street", "GANDHI STREET", True), ("Gandhi Street", "Gandi Street", True), ("3rd Street", "4th Street", False), ("Main Road", "NSR Main Road", False), (None, "x", False)])
def test_same_road(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(signs.same_road(F.col("a"), F.col("b")).alias("x")).first().x is want
