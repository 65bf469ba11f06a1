"""Line of sight from panoramas to outlines of buildings, and what a camera sees of each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablewise.model import Settings
from gablewise.operators.grid import cell, in_cells, meet, points_within
from gablewise.operators.looks import LOOK, NAMES, describe, together

RECT = ("x0", "y0", "x1", "y1")


def outline(step: float) -> dict[str, Column]:
    """Number of outline points of a rectangle, and their distance apart."""
    length = 2 * (F.col("x1") - F.col("x0") + F.col("y1") - F.col("y0"))
    n = F.greatest(F.lit(8), F.floor(length / step)).cast("int")
    return {"n": n, "step": length / n}


def sight_pairs(units: DataFrame, panos: DataFrame, radius: float) -> DataFrame:
    return points_within(units.select("unit_id", *RECT), panos.select("pano_id", "pano_date", "pano_ord", "px", "py"), radius)


def hidden_points(rects: np.ndarray, cameras: np.ndarray, n: np.ndarray, step: np.ndarray, blockers: list[np.ndarray], stop: float) -> tuple[np.ndarray, ...]:
    """For each pair of a rectangle and a camera, its n outline points, their distances, and whether it sees each past its blockers: a place a point.

    All pairs are tested at once: each outline point with each blocker of its pair.
    """
    pair = np.repeat(np.arange(len(n)), n)
    at = (np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)) * step[pair]
    x0, y0, x1, y1 = rects[pair].T
    px, py = cameras[pair].T
    w, h = x1 - x0, y1 - y0
    qx = np.select([at < w, at < w + h, at < w + h + w], [x0 + at, x1, x1 - (at - w - h)], x0)
    qy = np.select([at < w, at < w + h, at < w + h + w], [y0, y0 + (at - w), y1], y1 - (at - w - h - w))
    d = np.maximum(np.sqrt((qx - px) ** 2 + (qy - py) ** 2), 1e-9)
    k = np.minimum(1.0, np.maximum(0.0, (d - stop) / d))
    dx, dy = (qx - px) * k, (qy - py) * k
    many = np.array([len(b) for b in blockers])
    first = np.cumsum(many) - many
    times = many[pair]
    point = np.repeat(np.arange(len(pair)), times)
    which = np.arange(len(point)) - np.repeat(np.cumsum(times) - times, times) + first[pair][point]
    walls = np.concatenate(blockers)[which].T

    def span(p: np.ndarray, v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between which parameters the sight line is between two sides of a blocker."""
        with np.errstate(divide="ignore", invalid="ignore"):
            a, b = (lo - p) / v, (hi - p) / v
        within = (p >= lo) & (p <= hi)
        return np.where(v != 0, np.minimum(a, b), np.where(within, 0.0, 2.0)), np.where(v != 0, np.maximum(a, b), np.where(within, 1.0, -1.0))

    ex, lx = span(px[point], dx[point], walls[0], walls[2])
    ey, ly = span(py[point], dy[point], walls[1], walls[3])
    hit = np.maximum(np.maximum(ex, ey), 0.0) <= np.minimum(np.minimum(lx, ly), 1.0)
    return qx, qy, d, np.bincount(point, hit, len(pair)) == 0


def outline_looks(pairs: DataFrame, blockers: DataFrame, s: Settings, side: float = 32.0, points: bool = True) -> DataFrame:
    """(unit_id, pano_id, pano_date, pano_ord, px, py, and the columns of looks.LOOK) for each pair of a rectangle and a camera.

    A sight line stops a little short of its point, and any footprint that it touches hides the point; the target is a
    footprint too. Only footprints that meet the box around the camera and the target can: those few are gathered into one
    array a pair, the only shuffle after the join by cells; behind it batches of pairs are looked at at once. Without points, the outline
    points and which are visible stay in the task.
    """
    box = (F.least("x0", "px"), F.least("y0", "py"), F.greatest("x1", "px"), F.greatest("y1", "py"))
    p = in_cells(pairs, box, side)
    b = in_cells(blockers.selectExpr("x0 as b0", "y0 as b1", "x1 as b2", "y1 as b3"), ("b0", "b1", "b2", "b3"), side).withColumnsRenamed({"first_x": "other_x", "first_y": "other_y"})
    once = (F.col("cell_x") == F.greatest("first_x", "other_x")) & (F.col("cell_y") == F.greatest("first_y", "other_y"))
    touch = (F.col("b0") <= box[2]) & (F.col("b2") >= box[0]) & (F.col("b1") <= box[3]) & (F.col("b3") >= box[1])
    near = meet(p, b).where(once & touch)
    keep = ["pano_date", "pano_ord", "px", "py", *RECT]
    walls = F.flatten(F.collect_list(F.array("b0", "b1", "b2", "b3"))).alias("walls")
    x = near.groupBy("unit_id", "pano_id").agg(walls, *[F.first(c).alias(c) for c in keep]).withColumns(outline(s.outline_step))
    own = ["unit_id", "pano_id", "pano_date", "pano_ord", "px", "py"]
    some = 500  # pairs at once
    inner = () if points else ("qx", "qy", "visible")
    kept = [name for name in NAMES if name not in inner]

    def looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), some):
                x = pdf.iloc[i : i + some]
                walls = [np.asarray(w, np.float64).reshape(-1, 4) for w in x.walls]
                n, step, px, py = (x[c].to_numpy() for c in ("n", "step", "px", "py"))
                every = hidden_points(x[list(RECT)].to_numpy(np.float64), x[["px", "py"]].to_numpy(np.float64), n, step, walls, s.sight_stop)
                first = np.cumsum(n) - n

                def described(m: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:  # rings of equally many points
                    k = np.flatnonzero(n == m)
                    qx, qy, d, visible = (v[first[k, None] + np.arange(m)] for v in every)
                    return k, describe(qx, qy, step[k], px[k], py[k], d, visible, np.ones(len(k), bool), kept, s)

                yield x[own].assign(**together(len(x), map(described, np.unique(n))))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.select(*own).schema)
    return x.mapInPandas(looks, ", ".join([kinds, *(c for c in LOOK.split(", ") if c.split()[0] not in inner)]))


def access_class(units: DataFrame, cands: DataFrame, s: Settings) -> DataFrame:
    """(unit_id, access, n_candidates) for every unit."""
    c = cands.groupBy("unit_id").agg(F.count("*").alias("n"), F.min("dist_near").alias("near"))
    x = units.select("unit_id").join(c, "unit_id", "left")
    access = F.when(F.col("n").isNull(), "not visible").when(F.col("near") > s.near_view_dist, "not street-facing").otherwise("street-facing")
    return x.select("unit_id", access.alias("access"), F.coalesce("n", F.lit(0)).alias("n_candidates"))


def inside_rects(points: DataFrame, rects: DataFrame, side: float = 32.0) -> DataFrame:
    """Pairs of a point and a rectangle that it is strictly inside of, with the depth."""
    r = in_cells(rects, RECT, side).drop("first_x", "first_y")
    p = points.withColumns({"cell_x": cell("px", side), "cell_y": cell("py", side)})
    x = meet(p, r).drop("cell_x", "cell_y")
    x = x.where((F.col("px") > F.col("x0")) & (F.col("px") < F.col("x1")) & (F.col("py") > F.col("y0")) & (F.col("py") < F.col("y1")))
    return x.withColumn("depth", F.least(F.col("px") - F.col("x0"), F.col("x1") - F.col("px"), F.col("py") - F.col("y0"), F.col("y1") - F.col("py")))
