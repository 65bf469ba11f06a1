"""Areas that footprints of any outline share, and the neighbours' footprints that aren't second drawings of own ones.

An outline is a signed sum of the triangles from its first corner, so two outlines share the signed sum of what their triangles share; a
triangle is clipped by the sides of another. So bays, notches, turned and clockwise outlines need no cases of their own.
Outlines don't cross themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablewise.functions.geo import segment_hits_rect
from gablewise.model import Settings
from gablewise.operators.grid import in_cells, meet
from gablewise.operators.shapes import BOUNDS, bounds, edges, inside

#: Pairs of triangles that are clipped at once.
AT_ONCE = 1 << 15


def cross(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def fan(ring: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The triangles of a ring from its first corner, anticlockwise, and their signs, which sum up to the ring's inside."""
    t = np.stack([np.broadcast_to(ring[0], (len(ring) - 2, 2)), ring[1:-1], ring[2:]], 1)
    area = cross(t[:, 0], t[:, 1], t[:, 2])
    t, sign = np.where((area < 0)[:, None, None], t[:, ::-1], t), np.sign(area) * (np.sign(area.sum()) or 1)
    return t[sign != 0], sign[sign != 0]


def clipped(polygons: np.ndarray, counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of convex polygons (rows padded to one width) to the left of the lines from a to b."""
    n, width, _ = polygons.shape
    at = np.arange(width)
    following = np.take_along_axis(polygons, np.where(at + 1 < counts[:, None], at + 1, 0)[..., None], 1)
    here, there = cross(a[:, None], b[:, None], polygons), cross(a[:, None], b[:, None], following)
    real = at < counts[:, None]
    crosses = real & ((here > 0) & (there < 0) | (here < 0) & (there > 0))
    part = here / np.where(crosses, here - there, 1)
    out = np.stack([polygons, polygons + (following - polygons) * part[..., None]], 2).reshape(n, 2 * width, 2)
    keep = np.stack([real & (here >= 0), crosses], 2).reshape(n, 2 * width)
    order = np.argsort(~keep, axis=1, kind="stable")[:, : width + 1]
    return np.take_along_axis(out, order[..., None], 1), keep.sum(1)


def areas(polygons: np.ndarray, counts: np.ndarray) -> np.ndarray:
    at = np.arange(polygons.shape[1])
    first = polygons[:, :1]
    p = np.where((at < counts[:, None])[..., None], polygons, first)
    q = np.roll(p, -1, 1)
    return np.where(counts >= 3, ((p[..., 0] - first[..., 0]) * (q[..., 1] - first[..., 1]) - (q[..., 0] - first[..., 0]) * (p[..., 1] - first[..., 1])).sum(1) / 2, 0.0)


def shared(rings: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """The area that each ring shares with the other of its number; of fewer than three corners, none."""
    total = np.zeros(len(rings))
    t, u, sign, pair = [], [], [], []

    def add() -> None:
        if not pair:
            return
        p, q, w, k = np.concatenate(t), np.concatenate(u), np.concatenate(sign), np.concatenate(pair)
        counts = np.full(len(p), 3)
        for side in range(3):
            p, counts = clipped(p, counts, q[:, side], q[:, (side + 1) % 3])
        np.add.at(total, k, w * areas(p, counts))
        for x in (t, u, sign, pair):
            x.clear()

    held = 0
    for k, (a, b) in enumerate(zip(rings, others, strict=True)):
        if len(a) < 3 or len(b) < 3:
            continue
        (ta, sa), (tb, sb) = fan(a - a[0]), fan(b - a[0])
        for i in range(0, len(ta), max(1, AT_ONCE // max(1, len(tb)))):  # rings of many corners in parts
            some, signs = ta[i : i + max(1, AT_ONCE // max(1, len(tb)))], sa[i : i + max(1, AT_ONCE // max(1, len(tb)))]
            t.append(np.repeat(some, len(tb), 0))
            u.append(np.tile(tb, (len(some), 1, 1)))
            sign.append(np.repeat(signs, len(tb)) * np.tile(sb, len(some)))
            pair.append(np.full(len(some) * len(tb), k))
            held += len(pair[-1])
            if held >= AT_ONCE:
                add()
                held = 0
    add()
    return np.maximum(total, 0.0)


@F.pandas_udf(T.DoubleType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    ring = lambda v: np.asarray(v, np.float64).reshape(-1, 2)
    return pd.Series(shared([ring(v) for v in a], [ring(v) for v in b]))


def flat(ring: Column) -> Column:
    return F.flatten(F.transform(ring, lambda p: F.array(p.x, p.y)))


def shared_area(a: Column, b: Column) -> Column:
    """The area that two outlines, arrays of points (x, y), share. Null if either is."""
    return F.when(a.isNotNull() & b.isNotNull(), _shared(F.coalesce(flat(a), F.array().cast("array<double>")), F.coalesce(flat(b), F.array().cast("array<double>"))))


def area(ring: Column) -> Column:
    """The area of an outline, by the shoelace sum about its first corner."""
    o = F.get(ring, F.lit(0))
    one = lambda s, e: s + (e.ax - o.x) * (e.by - o.y) - (e.bx - o.x) * (e.ay - o.y)
    return F.abs(F.aggregate(edges(ring, True), F.lit(0.0), one)) / 2


def overlaps(left: DataFrame, right: DataFrame, key: str, side: float = 32.0) -> DataFrame:
    """(key, area): for each pair of a footprint of left (key, ring) and one of right (ring) whose bounds meet, what they share."""
    l = left.where(F.size("ring") >= 3).select(key, "ring", *[c.alias(f"l_{n}") for n, c in bounds(F.col("ring")).items()])  # noqa: E741
    r = right.where(F.size("ring") >= 3).select(F.col("ring").alias("other"), *[c.alias(n) for n, c in bounds(F.col("ring")).items()])
    l = in_cells(l, [f"l_{n}" for n in BOUNDS], side)  # noqa: E741
    r = in_cells(r, BOUNDS, side).withColumnsRenamed({"first_x": "other_x", "first_y": "other_y"})
    once = (F.col("cell_x") == F.greatest("first_x", "other_x")) & (F.col("cell_y") == F.greatest("first_y", "other_y"))
    meets = (F.col("min_x") <= F.col("l_max_x")) & (F.col("max_x") >= F.col("l_min_x")) & (F.col("min_y") <= F.col("l_max_y")) & (F.col("max_y") >= F.col("l_min_y"))
    return meet(l, r).where(once & meets).select(key, shared_area(F.col("ring"), F.col("other")).alias("area"))


def meets_box(ring: Column, box: list[Column]) -> Column:
    """Does an outline have a point in common with a box (min_x, min_y, max_x, max_y)?"""
    es = edges(ring, True)
    return F.exists(es, lambda e: segment_hits_rect(e.ax, e.ay, e.bx - e.ax, e.by - e.ay, *box)) | inside(box[0], box[1], es)


def neighbour_blockers(others: DataFrame, own: DataFrame, key: str, s: Settings) -> DataFrame:
    """others (key, ring) that block sights besides own (ring), with covered: the area that own footprints cover.

    Those that meet the bounds of all own footprints, grown by the margin, and of which own ones cover a share at most. Outlines of
    fewer than three points block nothing. Without own footprints there is no such box, so none.
    """
    b = own.where(F.size("ring") >= 3).select(*[c.alias(n) for n, c in bounds(F.col("ring")).items()])
    grown = b.agg(*[(F.min(n) - s.blocker_margin if n.startswith("min") else F.max(n) + s.blocker_margin).alias(n) for n in BOUNDS])
    box = [grown.select(n).scalar() for n in BOUNDS]
    x = others.where(F.size("ring") >= 3)
    x = x.withColumns(dict(zip(("w0", "w1", "w2", "w3"), box, strict=True)))
    x = x.where(meets_box(F.col("ring"), [F.col(c) for c in ("w0", "w1", "w2", "w3")])).drop("w0", "w1", "w2", "w3")
    covered = overlaps(x.select(key, "ring"), own, key).groupBy(key).agg(F.sum("area").alias("covered"))
    x = x.join(covered, key, "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))
    return x.where(F.col("covered") <= s.blocker_overlap * area(F.col("ring")))
