"""Plane geometry and camera geometry as column expressions. x is east, y north; bearings are compass degrees."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gablewise.model import COMPASS


def col(c: Column | str | float) -> Column:
    return F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(float(c))


def turn(angle: Column) -> Column:
    """An angle in 0..360; Spark's % would keep the sign."""
    return F.pmod(angle, F.lit(360.0))


def bearing(x: Column | str, y: Column | str, to_x: Column | str, to_y: Column | str) -> Column:
    return turn(F.degrees(F.atan2(col(to_x) - col(x), col(to_y) - col(y))))


def relative(angle: Column, ref: Column) -> Column:
    """angle as seen from ref, in -180..180; positive is clockwise."""
    return turn(angle - ref + 180) - 180


def middle(left: Column, right: Column) -> Column:
    """The bearing halfway from left to right, clockwise."""
    return turn(left + turn(relative(right, left)) / 2)


def compass(deg: Column) -> Column:
    i = F.pmod(F.floor((turn(deg) + 22.5) / 45), F.lit(8)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in COMPASS]), i + 1)


def point_rect(x: Column | str, y: Column | str, x0: Column | str, y0: Column | str, x1: Column | str, y1: Column | str) -> Column:
    """Distance of a point from an axis-aligned rectangle, 0 inside."""
    dx = F.greatest(col(x0) - col(x), F.lit(0.0), col(x) - col(x1))
    dy = F.greatest(col(y0) - col(y), F.lit(0.0), col(y) - col(y1))
    return F.sqrt(dx * dx + dy * dy)


def rect_rect(a: Sequence[Column | str], b: Sequence[Column | str]) -> Column:
    """Distance of two axis-aligned rectangles (x0, y0, x1, y1)."""
    dx = F.greatest(col(b[0]) - col(a[2]), F.lit(0.0), col(a[0]) - col(b[2]))
    dy = F.greatest(col(b[1]) - col(a[3]), F.lit(0.0), col(a[1]) - col(b[3]))
    return F.sqrt(dx * dx + dy * dy)


def overlap_area(a: Sequence[Column | str], b: Sequence[Column | str]) -> Column:
    w = F.least(col(a[2]), col(b[2])) - F.greatest(col(a[0]), col(b[0]))
    h = F.least(col(a[3]), col(b[3])) - F.greatest(col(a[1]), col(b[1]))
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def segment_hits_rect(px: Column, py: Column, dx: Column, dy: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Does the segment from p by (dx, dy) touch the rectangle? By the parameters at which it is between the sides."""

    def span(p: Column, d: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
        inside = (p >= lo) & (p <= hi)
        enter = F.when(d != 0, F.least((lo - p) / d, (hi - p) / d)).otherwise(F.when(inside, F.lit(0.0)).otherwise(F.lit(2.0)))
        leave = F.when(d != 0, F.greatest((lo - p) / d, (hi - p) / d)).otherwise(F.when(inside, F.lit(1.0)).otherwise(F.lit(-1.0)))
        return enter, leave

    ex, lx = span(px, dx, x0, x1)
    ey, ly = span(py, dy, y0, y1)
    return F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))


def project(delta: Column, dist: Column, height: Column, fov: Column, pitch: Column, size: float) -> Column:
    """(px, py) of a point in a perspective picture; null behind the camera."""
    d, p = F.radians(delta), F.radians(pitch)
    x, y = dist * F.sin(d), dist * F.cos(d)
    depth = y * F.cos(p) + height * F.sin(p)
    up = height * F.cos(p) - y * F.sin(p)
    f = (size / 2) / F.tan(F.radians(fov) / 2)
    return F.when(depth > 0.05, F.struct((size / 2 + f * x / depth).alias("px"), (size / 2 - f * up / depth).alias("py")))


def aim(span: Column, near: Column, left: Column, right: Column, storeys: Column, camera_height: float) -> Column:
    """A struct (heading, fov, pitch, height) that holds the visible part of a building; the height is at least 12 m."""
    height = F.greatest(F.lit(12.0), (storeys + 1) * 3.2)
    d = F.greatest(near, F.lit(1.0))
    top, bottom = F.degrees(F.atan((height - camera_height) / d)), F.degrees(F.atan(-F.lit(camera_height) / d))
    vertical = top - bottom + 6
    fov = F.least(F.lit(120.0), F.greatest(F.lit(40.0), span + 16, vertical))
    pitch = F.when(vertical > 120, top - fov / 2 + 3).otherwise((top + bottom) / 2)
    return F.struct(F.bround(middle(left, right), 2).alias("heading"), F.bround(fov, 1).alias("fov"), F.bround(pitch, 1).alias("pitch"), height.alias("height"))


def aim_zoom(span: Column, left: Column, right: Column) -> Column:
    fov = F.least(F.lit(45.0), F.greatest(F.lit(25.0), span + 6))
    return F.struct(F.bround(middle(left, right), 2).alias("heading"), F.bround(fov, 1).alias("fov"), F.lit(0.0).alias("pitch"), F.lit(0.0).alias("height"))


def core_span(px: Column, py: Column, lx: Column, ly: Column, rx: Column, ry: Column, left: Column, right: Column, shift: float) -> Column:
    """A struct (left, right): bearings that stay on the building when the camera is off sideways; null if none do."""
    mid = F.radians(middle(left, right))
    tx, ty = F.cos(mid), -F.sin(mid)
    lefts, rights = [], []
    for s in (-shift, 0.0, shift):
        cx, cy = px + tx * s, py + ty * s
        lefts.append(relative(bearing(cx, cy, lx, ly), left))
        rights.append(relative(bearing(cx, cy, rx, ry), left))
    lo, hi = F.greatest(*lefts), F.least(*rights)
    return F.when(hi > lo, F.struct(turn(left + lo).alias("left"), turn(left + hi).alias("right")))


#: The ellipsoid WGS 84 and the scale of UTM.
AXIS, FLATTENING, SCALE = 6378137.0, 1 / 298.257223563, 0.9996
_N = FLATTENING / (2 - FLATTENING)
#: Radius of the rectifying sphere, and the coefficients of the series in the third flattening, to its fourth power (Krueger 1912, Kawase 2011).
RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
TO_PLANE = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
TO_SPHERE = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
TO_LATITUDE = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)


def _series(start: Column, coefficients: Sequence[float], term: Callable[[int], Column]) -> Column:
    for j, c in enumerate(coefficients, 1):
        start = start + c * term(2 * j)
    return start


def utm_to_degrees(x: Column, y: Column, zone: int = 43) -> Column:
    """A struct (lat, lon) of a point of the northern UTM zone on WGS 84."""
    u, v = y / (SCALE * RADIUS), (x - 500000) / (SCALE * RADIUS)
    back = [-c for c in TO_SPHERE]
    u1, v1 = _series(u, back, lambda k: F.sin(u * k) * F.cosh(v * k)), _series(v, back, lambda k: F.cos(u * k) * F.sinh(v * k))
    sphere = F.asin(F.sin(u1) / F.cosh(v1))
    lat = _series(sphere, TO_LATITUDE, lambda k: F.sin(sphere * k))
    return F.struct(F.degrees(lat).alias("lat"), (F.degrees(F.atan2(F.sinh(v1), F.cos(u1))) + (zone * 6 - 183)).alias("lon"))


def degrees_to_utm(lat: Column, lon: Column, zone: int = 43) -> Column:
    """A struct (x, y), in metres of the northern UTM zone, of a place on WGS 84."""
    e = 2 * _N**0.5 / (1 + _N)
    sine, away = F.sin(F.radians(lat)), F.radians(lon - (zone * 6 - 183))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    u, v = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    y, x = _series(u, TO_PLANE, lambda k: F.sin(u * k) * F.cosh(v * k)), _series(v, TO_PLANE, lambda k: F.cos(u * k) * F.sinh(v * k))
    return F.struct((x * (SCALE * RADIUS) + 500000).alias("x"), (y * (SCALE * RADIUS)).alias("y"))


def path_in_metres(path: Column, zone: int = 43) -> Column:
    """A line or outline whose points have longitude as x and latitude as y, as layers have them, in metres."""
    return F.transform(path, lambda p: degrees_to_utm(p.y, p.x, zone))


def path_in_degrees(path: Column, zone: int = 43) -> Column:
    """A line or outline in metres, as layers have it: longitude as x and latitude as y."""

    def one(p: Column) -> Column:
        d = utm_to_degrees(p.x, p.y, zone)
        return F.struct(d.lon.alias("x"), d.lat.alias("y"))

    return F.transform(path, one)
