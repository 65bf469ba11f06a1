"""Exact top-k by inner product with a dual-tree search over cover trees.

Vectors fall into cells around centres from a bounded sample, and large cells into blocks. Each query first searches the block
that it lies in, which gives it a k-th score to beat; then it goes to those cells alone whose centre and covering radius allow
that score. In a task, the data of a block and the queries that come to it each get a cover tree: a node of level i covers its
points within 2 ** i of its centre, its children lie one level lower, and their centres are further than 2 ** (i - 1) apart.
For nodes with centres p, q and radii r, s no inner product exceeds <p, q> + r |q| + s |p| + r s; a pair whose bound is below
the worst k-th score of its queries is skipped. What the tasks find is merged to the k best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import save, small_batches

K, SCALE, EVERY = 10, 1024, 100
#: Vectors of a data block and queries of a task; points of a leaf of either tree, and children of a node, at most.
DATA_BLOCK, QUERY_BLOCK, LEAF, QUERY_LEAF, CHILDREN = 8192, 2048, 256, 32, 64
#: Centres of the cells, at most: vectors of the sample.
CENTRES = 1024
EXACT = 2.0**52


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    level: int
    points: np.ndarray
    children: list[Node] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.norm = float(np.linalg.norm(self.centre))


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(1))


def cover_tree(x: np.ndarray, points: np.ndarray, leaf: int = LEAF, children: int = CHILDREN) -> Node:
    """A cover tree over the rows of x that points names, the first of which is the centre.

    Levels at which a node has one child are skipped. A node whose points would need more children than allowed stays a leaf:
    they are all about as far from each other as from the centre, and there a tree tells nothing.
    """
    d = distances(x[points], x[points[0]])
    radius = float(d.max())
    level = int(np.ceil(np.log2(radius))) if radius > 0 else 0
    node = Node(x[points[0]], radius, level, points)
    if len(points) <= leaf or radius == 0:
        return node
    reach = 2.0 ** (level - 1)
    owner, centres = np.where(d <= reach, 0, -1), [0]
    while (owner < 0).any():
        if len(centres) == children:
            return node
        far = int((owner < 0).argmax())
        owner[(owner < 0) & (distances(x[points], x[points[far]]) <= reach)] = len(centres)
        centres.append(far)
    for k, c in enumerate(centres):
        own = np.flatnonzero(owner == k)
        node.children.append(cover_tree(x, points[np.concatenate([[c], own[own != c]])], leaf, children))
    return node


class Search:
    """The k best of a data block for each query that comes to it: rows, ids and vectors of both, and scores to reach."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, query_rows: np.ndarray, floor: np.ndarray, k: int):
        self.x, self.rows_of, self.ids, self.q, self.query_rows, self.floor, self.k = x, rows, ids, q, query_rows, floor, k
        self.scores = np.full((len(q), k), -np.inf)
        self.found = np.full((len(q), k), -1)
        self.compared = 0
        self.big = len(x) and len(q) and float(np.linalg.norm(x, axis=1).max()) * float(np.linalg.norm(q, axis=1).max()) >= EXACT
        if len(x) and len(q) and not self.big:
            self.visit(cover_tree(q, np.arange(len(q)), QUERY_LEAF), cover_tree(x, np.arange(len(x))))

    def bound(self, a: Node, b: Node) -> float:
        top = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return top + 1e-9 * abs(top) + 1e-6

    def worst(self, a: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[a, -1], self.floor[a])

    def visit(self, a: Node, b: Node) -> None:
        if self.bound(a, b) < self.worst(a.points).min():  # an equal score with a smaller id may still come in
            return
        if not a.children and not b.children:
            self.compare(a.points, b.points)
            return
        if a.children and (not b.children or a.radius > b.radius):
            for child in a.children:
                self.visit(child, b)
            return
        for child in sorted(b.children, key=lambda c: -self.bound(a, c)):
            self.visit(a, child)

    def compare(self, a: np.ndarray, b: np.ndarray) -> None:
        self.compared += len(a) * len(b)
        s = self.q[a] @ self.x[b].T
        s[self.query_rows[a][:, None] == self.rows_of[b][None, :]] = -np.inf
        # only queries for which something may come in are sorted anew
        change = (s >= self.worst(a)[:, None]).any(1)
        a, s = a[change], s[change]
        if not len(a):
            return
        scores, at = np.hstack([self.scores[a], s]), np.hstack([self.found[a], np.broadcast_to(b, s.shape)])
        order = np.lexsort((np.where(at < 0, np.iinfo(np.int64).max, self.ids[at]), -scores), axis=1)[:, : self.k]
        self.scores[a], self.found[a] = np.take_along_axis(scores, order, 1), np.take_along_axis(at, order, 1)

    def exact_rows(self) -> Iterator[tuple[int, int, int]]:
        """Query by query in whole numbers: for components so large that floats don't hold the scores."""
        x = [[int(c) for c in v] for v in self.x]
        for row, v in zip(self.query_rows, self.q, strict=True):
            v = [int(c) for c in v]
            every = [(-min(max(sum(map(int.__mul__, v, w)), -(1 << 63)), (1 << 63) - 1), int(i)) for w, i, r in zip(x, self.ids, self.rows_of, strict=True) if r != row]
            yield from ((int(row), i, -s) for s, i in sorted(every)[: self.k])

    def rows(self) -> pd.DataFrame:
        if self.big:
            return pd.DataFrame(list(self.exact_rows()), columns=["row", "vec_id", "score"])
        i, j = np.nonzero(np.isfinite(self.scores))
        return pd.DataFrame({"row": self.query_rows[i], "vec_id": self.ids[self.found[i, j]], "score": self.scores[i, j].astype(np.int64)})


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


FOUND = "row long, vec_id long, score long"


def search_blocks(data: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(row, vec_id, score) of the queries (row, v, floor) that come to blocks of data (row, vec_id, v), by keys."""

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"row": [], "vec_id": [], "score": []}).astype("int64")
        arrays = (x.to_numpy(np.int64) for x in (left.row, left.vec_id))
        return Search(_matrix(left.v), *arrays, _matrix(right.v), right.row.to_numpy(np.int64), right.floor.to_numpy(np.float64), k).rows()

    return data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, FOUND)


def exact_top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with the other rows of vectors.

    vectors: (vec_id long, embedding array, any others). Components become floor(1024 x), at most what a long holds. Queries
    are the rows whose vec_id is divisible by `every`; a query's own row is no candidate, another row of the same vec_id is.
    Ties go to the smaller vec_id; with fewer candidates all are given. Vectors that are null or empty, or hold a null or a
    component that isn't finite, take no part, nor do null vec_ids; vectors of unequal length never meet. Scores are exact;
    those that a long can't hold count as its greatest or least value. No rows give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double")).alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = x.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("double")).alias("v"))
    x = save(x.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "topk-vectors")
    n = x.count()
    centres: dict[int, np.ndarray] = {}
    for r in x.select("dim", "v", F.xxhash64("row").alias("h")).orderBy("h").limit(min(CENTRES, n // DATA_BLOCK + 1)).collect():
        centres[r.dim] = np.vstack([*([centres[r.dim]] if r.dim in centres else []), np.array(r.v)])
    model = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cell, far = np.full(len(b), -1, np.int32), np.full(len(b), np.inf)
            for dim, at in b.groupby("dim").indices.items():
                if dim in model.value:
                    c, v = model.value[dim], _matrix(b.v.iloc[at])
                    d = (v**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * v @ c.T
                    cell[at] = d.argmin(1)
                    far[at] = np.sqrt(((v - c[cell[at]]) ** 2).sum(1))
            yield b.assign(cell=cell, far=far)

    x = x.mapInPandas(assign, "vec_id long, v array<double>, row long, dim int, cell int, far double")
    x = save(x, "topk-cells")
    cells = {(r.dim, r.cell): (r.radius, r.blocks) for r in x.groupBy("dim", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / DATA_BLOCK).cast("int").alias("blocks")).collect()}
    sizes = spark.createDataFrame([(*key, blocks) for key, (_, blocks) in cells.items()], "dim int, cell int, blocks int")
    x = x.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    queries = x.where(F.col("vec_id") % every == 0).select("dim", "cell", "block", "row", F.col("vec_id").alias("query_id"), "v")
    data = x.select("dim", "cell", "block", "row", "vec_id", "v")

    keys = ["dim", "cell", "block", "part"]

    def visit(q: DataFrame, parts: int, name: str) -> DataFrame:
        """The search of the blocks that queries come to, a block's queries in so many parts."""
        q = save(q.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")), "topk-queries")
        copies = data.join(save(q.select(*keys).distinct(), "topk-parts"), ["dim", "cell", "block"])
        return save(search_blocks(copies, q, keys, k), name)

    # first the own block, which holds few queries
    own = visit(queries.drop("query_id").withColumn("floor", F.lit(float("-inf"))), 1, "topk-own")
    floors = own.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor"))
    todo = queries.drop("query_id").join(floors, "row", "left").fillna({"floor": float("-inf")})

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query once for every block but its own that may hold a score as high as its floor."""
        names = sorted(cells)
        dims, blocks = np.array([d for d, _ in names]), np.array([cells[c][1] for c in names])
        radius = np.array([cells[c][0] for c in names])
        for b in batches:
            out = []
            for dim, cell, block, row, v, floor in b[["dim", "cell", "block", "row", "v", "floor"]].itertuples(index=False):
                at = np.flatnonzero(dims == dim)
                known = at[np.isfinite(radius[at])]
                v = np.asarray(v)
                top = np.full(len(names), np.inf)
                if len(known):
                    top[known] = model.value[dim][[names[i][1] for i in known]] @ v + radius[known] * np.linalg.norm(v)
                for i in at[top[at] + 1e-9 * np.abs(top[at]) + 1e-6 >= floor]:
                    out += [(dim, names[i][1], j, row, v, floor) for j in range(blocks[i]) if (names[i][1], j) != (cell, block)]
            yield pd.DataFrame(out, columns=["dim", "cell", "block", "row", "v", "floor"])

    todo = todo.mapInPandas(reach, "dim int, cell int, block int, row long, v array<double>, floor double")
    found = own.unionByName(visit(todo, queries.count() // QUERY_BLOCK + 1, "topk-others"))
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("row", "query_id"), "row").select("query_id", "rank", "vec_id", "score")
