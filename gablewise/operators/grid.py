"""Spatial joins as equi-joins on grid cells, with an exact test after. No pair is made outside a cell.

A cell's side is at least the join's radius. One side's boxes, grown by the radius, are copied into the cells that they
touch; a pair that meets in several cells counts only in the first one that both have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions.geo import point_rect, rect_rect


def cell(c: Column | str, side: float) -> Column:
    return F.floor((F.col(c) if isinstance(c, str) else c) / F.lit(float(side))).cast("long")


def meet(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("cell_x", "cell_y"), how: str = "inner") -> DataFrame:
    """A join that shuffles and sorts both sides. Tables are small as files and large by cells, so neither is ever sent whole to the driver and all tasks."""
    return left.join(right.hint("merge"), list(keys), how)


def parts(df: DataFrame, rows: int) -> int:
    """Into how many parts of about so many rows a table falls. A number given to repartition stays; without one, tasks are merged by the bytes that they
    read, however many rows these become."""
    return max(1, -(-df.count() // rows))


def in_cells(df: DataFrame, box: Sequence[Column | str], side: float, grow: float = 0.0) -> DataFrame:
    """A row for each cell that the grown box touches, with cell_x, cell_y and the first cell's numbers first_x, first_y."""
    b = [F.col(c) if isinstance(c, str) else c for c in box]
    lo_x, lo_y, hi_x, hi_y = cell(b[0] - grow, side), cell(b[1] - grow, side), cell(b[2] + grow, side), cell(b[3] + grow, side)
    x = df.withColumns({"first_x": lo_x, "first_y": lo_y})
    return x.withColumn("cell_x", F.explode(F.sequence("first_x", hi_x))).withColumn("cell_y", F.explode(F.sequence("first_y", hi_y)))


def points_within(rects: DataFrame, points: DataFrame, radius: float, rect: Sequence[str] = ("x0", "y0", "x1", "y1"), point: Sequence[str] = ("px", "py"), side: float | None = None) -> DataFrame:
    """Pairs of a rectangle and a point at most radius apart, with dist. A point is in one cell, so pairs come once."""
    side = side or max(radius, 1.0)
    left = in_cells(rects, rect, side, radius).drop("first_x", "first_y")
    right = points.withColumns({"cell_x": cell(point[0], side), "cell_y": cell(point[1], side)})
    pairs = meet(left, right).drop("cell_x", "cell_y")
    return pairs.withColumn("dist", point_rect(*point, *rect)).where(F.col("dist") <= radius)


def boxes_within(left: DataFrame, right: DataFrame, radius: float, a: Sequence[str], b: Sequence[str], side: float) -> DataFrame:
    """Pairs of boxes at most radius apart, with dist. The column names of the two sides must differ."""
    l = in_cells(left, a, side, radius)  # noqa: E741
    r = in_cells(right, b, side).withColumnsRenamed({"first_x": "other_x", "first_y": "other_y"})
    pairs = meet(l, r)
    once = (F.col("cell_x") == F.greatest("first_x", "other_x")) & (F.col("cell_y") == F.greatest("first_y", "other_y"))
    pairs = pairs.where(once).drop("cell_x", "cell_y", "first_x", "first_y", "other_x", "other_y")
    return pairs.withColumn("dist", rect_rect(a, b)).where(F.col("dist") <= radius)


def nearest(pairs: DataFrame, key: Sequence[str], order: Sequence[Column | str], ties: bool = False) -> DataFrame:
    """Of the pairs of a key the first in the order; with ties, all that are alike in it."""
    w = W.partitionBy(*key).orderBy(*order)
    rank = F.rank().over(w) if ties else F.row_number().over(w)
    return pairs.withColumn("nth", rank).where("nth = 1").drop("nth")
