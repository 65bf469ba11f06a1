"""An exact similarity join of documents by the Jaccard similarity of their word shingles, in metric-space regions.

Jaccard distance is a metric. In a region, pivots are chosen far apart and split the documents into Voronoi cells. A document
is copied into another pivot's cell if it is at most two radii further from that pivot than from its own: by the triangle
inequality only such a document can be within the radius of one there. Cells are split again by pivots of their own until few
documents are left, which are compared. What is within the radius of a pivot is linked to it, and a cell whose documents are
connected already is done. A region that fits in a task is split there; larger ones are split by Spark first.

Regions start from a coarse filter that loses no link, since a pivot of the whole corpus would tell nothing: different texts
are all at a distance of almost 1 from each other, so that its window would hold every document. Documents with equal sets
become one class. Within a band of sizes the universe of shingles is cut into more slices than two linked sets can have
differences, so that linked sets agree on several whole slices. Each document leaves out as many of its slices, those that most
documents have, as still leave it one of these. Documents joined by equal slices, directly or through others, form a region,
and there distances spread from 0 to 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, forget, id_again, id_columns, mix, packed, save, shingle_set, small_batches, tidied
from gablewise.llm.components import connected_components


@dataclass(frozen=True)
class Settings:
    #: Words a shingle, and the least similarity in hundredths.
    k: int = 3
    percent: int = 90
    #: Sizes of a band, the largest over the smallest.
    ratio: float = 1.5
    #: Slices that linked sets agree on beyond the one that they need: so many, and one more for so many differences.
    spare: int = 2
    spare_each: int = 8
    #: Documents of two blocks that are compared in one task.
    blocks: int = 1_000
    #: Documents and bytes of sets of a region that one task splits alone; pivots of a split; documents that are compared at once.
    region: int = 250
    region_bytes: int = 32 << 20
    pivots: int = 8
    leaf: int = 2
    #: Splits by Spark before the rest is compared in blocks.
    depth: int = 6
    seed: int = 1

    def pays(self, squares: float, m: int) -> bool:
        """Whether cells are worth a split of m documents: the sum of their squared sizes is well below m squared.

        Else the windows hold nearly everything, pivots don't tell the documents apart, and these are compared as they are.
        """
        return squares < 0.7 * m * m


def linked(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def band_of(n: int, s: Settings) -> int:
    """Bands of set sizes from 1 up: band b starts at ratio ** b."""
    b = int(np.floor(np.log(max(n, 1)) / np.log(s.ratio)))
    while start_of(b + 1, s) <= n:
        b += 1
    while start_of(b, s) > n:
        b -= 1
    return b


def start_of(b: int, s: Settings) -> int:
    return int(np.ceil(s.ratio**b))


def bands(h: np.ndarray, s: Settings) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a set, for each band that it may meet linked sets in: the band, d, the number of slices, the values of those that aren't empty, and the order
    of the shingles by slice with the places where slices begin.

    Sets of sizes m <= n that are linked have a union of at most 100 m / percent, so at most d = m (100 - percent) / percent
    differences. A band's number of slices is over d for its largest m, and by `spare` more, so that spare + 1 slices agree.
    The larger set looks up the bands of all sizes that m may have.
    """
    for b in range(band_of(-(-len(h) * s.percent // 100), s), band_of(len(h), s) + 1) if len(h) else ():
        d = (start_of(b + 1, s) - 1) * (100 - s.percent) // s.percent
        if d == 0:
            continue
        slices = d + 1 + s.spare + d // s.spare_each
        at = (mix(h + np.uint64(1000003 * (b + 1))) % np.uint64(slices)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        which = at[order][starts].astype(np.uint64)
        yield b, d, slices, mix(np.add.reduceat(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))[order], starts) + mix(which * np.uint64(4096) + np.uint64(b))), order, starts


def prefix(h: np.ndarray, b: int, d: int) -> np.ndarray:
    """The d + 1 first shingles of a set in the order of their hashes: those of linked sets meet."""
    return mix(np.sort(mix(h + np.uint64(7)))[: d + 1] ^ mix(np.uint64(1 << 40) + np.array([b], np.uint64)))


def counted_slices(h: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slices of a set, the group of each, and how many of its group may be left out: linked, unequal sets then still share one.

    A group is a band. Of the spare + 1 slices on which linked sets agree there, as many may be empty as one of them has empty ones; of the others all
    but one may be left out, if they are left out in one order of all slices: the first of the common slices stays in both sets. A set with more than
    `spare` empty slices gives its prefix, a group of its own, as well, of which nothing may be left out.
    """
    values, group, left_out = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for b, d, slices, sums, _, starts in bands(h, s):
        empty, spare = slices - len(starts), slices - d - 1
        found = [(sums, 2 * b, max(0, spare - empty)), *([(prefix(h, b, d), 2 * b + 1, 0)] if empty > spare else [])]
        for v, g, n in found:
            values.append(v)
            group.append(np.full(len(v), g))
            left_out.append(np.full(len(v), n))
    return np.concatenate(values), np.concatenate(group), np.concatenate(left_out)


def signatures(h: np.ndarray, s: Settings, frequent: np.ndarray | None = None) -> np.ndarray:
    """The slices of a set where they can't be counted: linked, unequal sets share one at least.

    Slices that are empty or hold frequent shingles only (sorted hashes; passages that very many texts share) are left out if
    there are no more than spare of them: then one that agrees is given by both sets. A set with more of them gives all slices
    that aren't empty; with too many empty ones also its prefix.
    """
    telling = np.ones(len(h), np.int64)
    if len(h) and frequent is not None and len(frequent):
        telling = (frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] != h).astype(np.int64)
    out: list[np.ndarray] = []
    for b, d, slices, sums, order, starts in bands(h, s):
        tells, spare = np.add.reduceat(telling[order], starts) > 0, slices - d - 1
        if slices - int(tells.sum()) <= spare:
            out.append(sums[tells])
            continue
        out += [sums, *([prefix(h, b, d)] if slices - len(starts) > spare else [])]
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def profiles(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, n, a, b): the set's size and 128 bits that name the set."""
    small_batches(docs.sparkSession)

    @tidied
    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            sets = [shingle_set(t, s.k) for t in x.text]
            yield pd.DataFrame({
                "id": x.id, "no_id": x.no_id, "n": [len(h) for h in sets],
                "a": np.array([mix(h).sum(dtype=np.uint64) for h in sets], np.uint64).view(np.int64),
                "b": np.array([mix(h ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) for h in sets], np.uint64).view(np.int64),
            })

    found = docs.select(*id_columns(F.col("doc_id")), "text").mapInPandas(profile, "id long, no_id boolean, n long, a long, b long")
    return found.select(id_again().alias("doc_id"), "n", "a", "b")


def all_slices(docs: DataFrame, s: Settings) -> DataFrame:
    """(id, slice, group, left_out): the slices of each document, a row each."""
    small_batches(docs.sparkSession)

    @tidied
    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            got = [counted_slices(shingle_set(t, s.k), s) for t in x.text]
            of = np.repeat(np.arange(len(got)), [len(v) for v, _, _ in got])
            v, group, left_out = (np.concatenate([g[i] for g in got] or [np.empty(0, np.int64)]) for i in range(3))
            yield pd.DataFrame({"id": x.id.to_numpy(np.int64)[of], "slice": v.view(np.int64), "group": group.astype(np.int32), "left_out": left_out.astype(np.int32)})

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text")
    return rows.mapInPandas(slices, "id long, slice long, group int, left_out int")


class Unions:
    """Disjoint sets of the documents of one region."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """The sizes of all intersections, by products of incidence matrices over the values that two sets have at least."""
    n = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
    names, at, times = np.unique(values, return_inverse=True, return_counts=True)
    place = np.full(len(names), -1)
    shared = np.flatnonzero(times > 1)
    place[shared] = np.arange(len(shared))
    at = place[at]
    at, owner = at[at >= 0], owner[at >= 0]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for start in range(0, len(shared), columns):
        lo, hi = np.searchsorted(at, [start, start + columns])
        m = np.zeros((n, min(columns, len(shared) - start)), np.float32)
        m[owner[lo:hi], at[lo:hi] - start] = 1
        out += m @ m.T
    return out.astype(np.int64)


class Region:
    """The links of a region that is split inside one task: a spanning forest of the link graph.

    balls: sets of one ball (if it is not -1) are known to be connected. cells and copies count the Voronoi cells that were
    formed, and the documents that windows copied into a second one.
    """

    def __init__(self, ids: list[int], sets: list[np.ndarray], balls: list[int], s: Settings):
        self.ids, self.sets, self.s = ids, sets, s
        self.size = np.array([len(x) for x in sets])
        self.links: list[tuple[int, int]] = []
        self.u = Unions(len(ids))
        self.cells = self.copies = 0
        first: dict[int, int] = {}
        for i, ball in enumerate(balls):
            if ball >= 0:
                self.u.join(first.setdefault(ball, i), i)

    def link(self, x: int, y: int) -> None:
        if self.u.join(x, y):
            self.links.append((self.ids[x], self.ids[y]))

    def split(self, part: np.ndarray) -> None:
        """Voronoi cells of the documents that part names, with their windows, each split again."""
        if len({self.u.top(i) for i in part.tolist()}) < 2:
            return
        if len(part) <= self.s.leaf:
            self.compare(part)
            return
        pivots, d = self.far_apart(part)
        window = d <= d.min(1)[:, None] + two_radii(self.s)
        self.cells += len(pivots)
        self.copies += int(window.sum()) - len(part)
        if not self.s.pays(float((window.sum(0).astype(np.float64) ** 2).sum()), len(part)):
            self.compare(part)
            return
        for j in range(len(pivots)):
            self.split(part[window[:, j]])

    def far_apart(self, part: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Pivots, each the furthest document from those before, and all distances to them. Linked documents are joined."""
        pivots, columns = [int(part[0])], []
        while True:
            p = pivots[-1]
            common = np.array([overlap(self.sets[i], self.sets[p]) for i in part.tolist()])
            union = self.size[part] + self.size[p] - common
            columns.append(1 - common / union)
            for i in part[100 * common >= self.s.percent * union].tolist():
                self.link(p, i)
            nearest = np.min(columns, axis=0)
            if len(pivots) == self.s.pivots or nearest.max() == 0:
                return pivots, np.stack(columns, 1)
            pivots.append(int(part[nearest.argmax()]))

    def compare(self, part: np.ndarray, left: int | None = None) -> None:
        """All links of a part; left: only those of its first `left` documents with the others."""
        common, size = overlaps([self.sets[i] for i in part.tolist()]), self.size[part]
        link = np.triu(100 * common >= self.s.percent * (size[:, None] + size[None, :] - common), 1)
        if left is not None:
            link[:left, :left] = link[left:, left:] = False
        for x, y in zip(*(part[z].tolist() for z in np.nonzero(link)), strict=True):
            self.link(x, y)


def two_radii(s: Settings) -> float:
    return 2 * (1 - s.percent / 100) + 1e-9


EDGES = "a long, b long"


def _edges(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")


def _sets(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(bytes(x), np.uint64) for x in pdf["set"]]


def task_links(members: DataFrame, s: Settings) -> DataFrame:
    """(a, b): the links of regions that fit in a task, which takes its regions one after the other."""

    @tidied
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: list[pd.DataFrame]) -> list[tuple[int, int]]:
            x = pd.concat(rows).sort_values("id")
            r = Region(x.id.tolist(), _sets(x), x.ball.tolist(), s)
            r.split(np.arange(len(x)))
            return r.links

        held: list[pd.DataFrame] = []
        for x in batches:
            out = []
            for region, rows in x.groupby("region", sort=False):
                if held and held[0].region.iloc[0] != region:
                    out += done(held)
                    held = []
                held.append(rows)
            yield _edges(out)
        yield _edges(done(held) if held else [])

    dealt = members.select("region", "id", "set", "ball").repartition("region").sortWithinPartitions("region")
    return dealt.mapInPandas(join, EDGES)


def tasks(docs: int, s: Settings) -> Column:
    """How many tasks of at most so many documents a region (m, bytes) needs."""
    return F.greatest(F.ceil(F.col("m") / docs), F.ceil(F.col("bytes") / s.region_bytes)).cast("int")


def region_links(members: DataFrame, s: Settings) -> DataFrame:
    """(a, b): a spanning forest of the links inside regions, from (region long, id long, set binary, ball long).

    Every region is split by pivots into Voronoi cells with their windows, again and again: one that fits in a task there,
    larger ones by Spark until their cells fit. A region whose windows hold nearly all of it, however often it is split, is
    compared exactly in blocks, each pair of blocks in a task.
    """
    found: list[DataFrame] = []
    todo = save(members, "join-members")
    for depth in range(s.depth + 1):
        sizes = todo.groupBy("region").agg(F.count("*").alias("m"), F.min("id").alias("first_id"), F.sum(F.octet_length("set")).alias("bytes"))
        sizes = save(sizes, "join-sizes")
        fits = (F.col("m") <= s.region) & (F.col("bytes") <= s.region_bytes)
        found.append(save(task_links(todo.join(broadcast_if_small(sizes.where(fits & (F.col("m") > 1))), "region"), s), "join-links"))
        large = sizes.where(~fits & (F.col("m") > 1)).withColumns({"parts": tasks(s.region, s), "blocks": tasks(s.blocks, s)})
        if not large.take(1):
            break
        rest = todo.join(broadcast_if_small(large), "region")
        if depth == s.depth:
            found.append(block_links(rest.withColumn("parts", F.col("blocks")), s))
            break
        cells, near = voronoi(rest, s, depth)
        found.append(near)
        # a region whose cells aren't worth the split goes to the blocks at once
        grown = cells.groupBy("region", "was").agg(F.count("*").alias("c"), F.max("m").alias("m"))
        grown = grown.groupBy("was").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("squares"), F.max("m").alias("m"))
        grown = save(grown.where(~s.pays(F.col("squares"), F.col("m").cast("double"))).select("was"), "join-stuck")
        if grown.take(1):
            stuck = cells.join(broadcast_if_small(grown), "was", "left_semi").select(F.col("was").alias("region"), "id", "set", "ball")
            stuck = stuck.join(broadcast_if_small(large.select("region", F.col("blocks").alias("parts"))), "region")
            found.append(block_links(stuck.dropDuplicates(["region", "id", "set"]), s))
            cells = cells.join(broadcast_if_small(grown), "was", "left_anti")
        before, todo = todo, save(cells.select("region", "id", "set", "ball"), "join-members")
        forget(before)
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def voronoi(rest: DataFrame, s: Settings, depth: int) -> tuple[DataFrame, DataFrame]:
    """Cells and windows of large regions, and the links to their pivots.

    A region's documents are dealt over as many tasks as it needs, each with the region's few pivots. A document linked to a
    pivot is connected to it; those documents are connected among each other through it, and go on only to meet documents
    that aren't: so a cell without such a document is done.
    """
    two = two_radii(s)
    chosen = (F.pmod(F.xxhash64("id", F.lit(depth + s.seed)), F.col("m")) < s.pivots) | (F.col("id") == F.col("first_id"))
    pivots = save(rest.where(chosen).select("region", "id", "set", "parts"), "join-pivots")
    dealt = rest.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    copies = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def assign(docs: pd.DataFrame, piv: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            piv = piv.sort_values("id")
            names, ps = list(piv.id), _sets(piv)
            for i, x, was in zip(docs.id, _sets(docs), docs.ball, strict=True):
                common = [overlap(x, p) for p in ps]
                d = [1 - c / (len(x) + len(p) - c) for c, p in zip(common, ps, strict=True)]
                ball = next((p for p, c, q in zip(names, common, ps, strict=True) if linked(c, len(x), len(q), s.percent)), was)
                best = int(np.argmin(d))
                for j in range(len(ps)):
                    if d[j] <= d[best] + two:
                        out.append((docs.region.iloc[0], names[j], i, x.tobytes(), docs.m.iloc[0], docs.parts.iloc[0], ball))
        return pd.DataFrame(out, columns=["was", "pivot", "id", "set", "m", "parts", "ball"])

    cells = dealt.groupBy("region", "part").cogroup(copies.groupBy("region", "part")).applyInPandas(assign, "was long, pivot long, id long, set binary, m long, parts int, ball long")
    cells = save(cells, "join-cells")
    near = cells.where("ball >= 0 AND ball <> id").select(F.col("ball").alias("a"), F.col("id").alias("b")).distinct()
    # documents of one ball are connected: a cell that holds one ball only is done
    open_cells = cells.groupBy("was", "pivot").agg(F.min("ball").alias("x"), F.max("ball").alias("y")).where("x <> y OR x = -1")
    open_cells = broadcast_if_small(save(open_cells.select("was", "pivot"), "join-open"))
    cells = cells.join(open_cells, ["was", "pivot"], "left_semi")
    return cells.withColumn("region", F.xxhash64("was", "pivot", F.lit(depth))), save(near, "join-links")


def block_links(rest: DataFrame, s: Settings) -> DataFrame:
    """Links of regions in blocks of about half of what a task takes: every pair of blocks meets in one task.

    A document is copied as often as there are blocks; so these are larger than what a task splits by pivots.
    """
    n = F.col("parts") * 2
    x = rest.withColumn("block", F.pmod(F.xxhash64("id"), n).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    x = x.select("region", "id", "set", "ball", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "id"])
        r = Region(pdf.id.tolist(), _sets(pdf), pdf.ball.tolist(), s)
        r.compare(np.arange(len(pdf)), None if pdf.block.nunique() == 1 else int((pdf.block == pdf.lo).sum()))
        return _edges(r.links)

    return save(x.groupBy("region", "lo", "hi").applyInPandas(compare, EDGES), "join-links")


def coarse_regions(docs: DataFrame, s: Settings) -> DataFrame:
    """(id, component): the documents that share slices, directly or through others. Documents alone in all their slices have no row.

    Slices are shuffled once and counted where they land; most have one document and go no further. Of the others each document leaves out those that
    most documents have, as many as it may, so that what many texts have in common by chance joins nothing, however large the table. Each
    document pairs with the first of its slice.
    """
    several = all_slices(docs, s).withColumn("many", F.count("*").over(W.partitionBy("slice"))).where("many > 1")
    nth = F.row_number().over(W.partitionBy("id", "group", "left_out").orderBy(F.desc("many"), "slice"))
    kept = several.withColumn("nth", nth).where("nth > left_out").select("id", "slice")
    pairs = kept.withColumn("head", F.first("id").over(W.partitionBy("slice").orderBy("id"))).where("id <> head")
    return save(connected_components(pairs.select(F.col("id").alias("a"), F.col("head").alias("b"))), "join-regions")


def set_classes(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The saved profile (doc_id, n, a, b) of each row, and (rep, n, a, b, component) of each class of equal sets.

    rep is the smallest doc_id of the class, component the smallest that its links reach. Rows without a doc_id take no part.
    """
    every = save(profiles(docs, s), "join-profiles")
    known = every.where("doc_id IS NOT NULL AND n > 0")
    classes = save(known.groupBy("n", "a", "b").agg(F.min("doc_id").alias("rep")), "join-classes")
    regions = coarse_regions(docs, s).join(classes.select(F.col("rep").alias("id")), "id", "left_semi")  # one document a class
    regions = save(regions.withColumn("m", F.count("*").over(W.partitionBy("component"))).where("m > 1").select("id", "component"), "join-regions")

    text = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text")
    text = text.join(broadcast_if_small(regions), "id").select(F.col("component").alias("region"), "id", "text")

    @tidied
    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            x["set"] = [shingle_set(t, s.k).tobytes() for t in x.pop("text")]
            yield x

    members = text.mapInPandas(to_sets, "region long, id long, set binary").where("octet_length(set) > 0")
    links = region_links(members.withColumn("ball", F.lit(-1).cast("long")), s)
    # rows that share a doc_id are one document: their classes belong together
    several = known.select("doc_id", "n", "a", "b").distinct().groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1")
    several = save(several.select("doc_id"), "join-several")
    if several.take(1):
        rows = known.join(broadcast_if_small(several), "doc_id").join(classes.select("n", "a", "b", "rep"), ["n", "a", "b"])
        links = links.unionByName(rows.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    components = save(connected_components(links), "join-components")
    reps = classes.select("n", "a", "b", "rep").join(broadcast_if_small(components.withColumnRenamed("id", "rep")), "rep", "left")
    return every, save(reps.withColumn("component", F.coalesce("component", "rep")), "join-reps")


def jaccard_components(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    Two documents link when percent of their union is at most 100 times their intersection; a component is what links reach.
    A document without words has no shingles, no link, and is its own component. Rows with a null doc_id keep their size and
    have a null component. Rows that share a doc_id count as one document, whose links are those of
    all of them, and give a row each. No rows give no rows.
    """
    every, reps = set_classes(docs, settings or Settings())
    return (
        every.join(broadcast_if_small(reps), ["n", "a", "b"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    )


def one_of_each(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """docs with one document of each group of linked ones, that with the smallest doc_id; all columns as they are.

    Documents without words and rows without a doc_id stay. Of rows that share the kept doc_id, one stays: that of the text
    with the least hash. No rows give no rows.
    """
    c = save(jaccard_components(docs.select("doc_id", "text"), settings), "join-groups")
    gone = save(c.where("doc_id <> component_id").select(F.col("doc_id").alias("key")).distinct(), "join-gone")
    several = save(c.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("key")).count().where("count > 1").select("key"), "join-several")
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("key")).join(broadcast_if_small(gone), "key", "left_anti")
    if several.take(1):
        once = rows.join(broadcast_if_small(several), "key").groupBy("key").agg(F.min_by("row", F.struct(F.xxhash64("row.text"), "row.text")).alias("row"))
        rows = rows.join(broadcast_if_small(several), "key", "left_anti").unionByName(once, allowMissingColumns=True)
    return rows.select("row.*")
