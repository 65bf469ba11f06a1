"""Camera and plane geometry, against worked cases and plain arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from gablewise.functions import geo


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("to", "want"), [((0, 1), 0), ((1, 0), 90), ((0, -1), 180), ((-1, 0), 270), ((-1, 1), 315)])
def test_bearing(spark, to, want):
    assert one(spark, geo.bearing(F.lit(0.0), F.lit(0.0), F.lit(float(to[0])), F.lit(float(to[1])))) == pytest.approx(want)


def test_relative_and_middle(spark):
    assert one(spark, geo.relative(F.lit(10.0), F.lit(350.0))) == pytest.approx(20)
    assert one(spark, geo.relative(F.lit(350.0), F.lit(10.0))) == pytest.approx(-20)
    assert one(spark, geo.middle(F.lit(350.0), F.lit(20.0))) == pytest.approx(5)


@pytest.mark.parametrize(("deg", "want"), [(0, "N"), (22.4, "N"), (22.5, "NE"), (181, "S"), (350, "N"), (-90, "W")])
def test_compass(spark, deg, want):
    assert one(spark, geo.compass(F.lit(float(deg)))) == want


def test_projection(spark):
    c = one(spark, geo.project(F.lit(0.0), F.lit(10.0), F.lit(0.0), F.lit(90.0), F.lit(0.0), 640))
    assert (c.px, c.py) == pytest.approx((320, 320))
    right = one(spark, geo.project(F.lit(45.0), F.lit(10.0), F.lit(0.0), F.lit(90.0), F.lit(0.0), 640))
    assert right.px == pytest.approx(640)
    assert one(spark, geo.project(F.lit(180.0), F.lit(10.0), F.lit(0.0), F.lit(90.0), F.lit(0.0), 640)) is None


def test_core_span_shrinks_and_vanishes(spark):
    def core(half):
        left, right = (math.degrees(math.atan2(-half, 10)) % 360, math.degrees(math.atan2(half, 10)) % 360)
        return one(spark, geo.core_span(*[F.lit(float(v)) for v in (0, 0, -half, 10, half, 10, left, right)], 2.0)), left

    wide, left = core(4)
    assert (wide.left - left) % 360 > 0
    assert core(1.5)[0] is None


def test_degrees_of_a_known_place(spark):
    d = one(spark, geo.utm_to_degrees(F.lit(711679.6), F.lit(1219908.4)))
    assert d.lat == pytest.approx(11.029, abs=1e-3)
    assert d.lon == pytest.approx(76.937, abs=1e-3)


def test_segment_touches_rectangle(spark):
    hit = lambda *v: one(spark, geo.segment_hits_rect(*[F.lit(float(x)) for x in v]))
    assert hit(0, 0, 10, 0, 4, -1, 6, 1)
    assert not hit(0, 0, 3.9, 0, 4, -1, 6, 1)
    assert hit(0, 0, 4, 0, 4, -1, 6, 1)
    assert not hit(0, 0, 10, 0, 4, 1, 6, 2)
    assert hit(5, 0, 0, 5, 4, 1, 6, 2)
