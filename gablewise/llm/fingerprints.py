"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; the high bits choose a bin, and a bin keeps its least hash. An empty bin takes the value of
a full one: of the first that a random sequence of its own meets (optimal densification, so that two documents choose alike).
The fingerprint is the low-order bits of the bins, packed, as hexadecimal digits. Likeness is the share of bins that agree,
corrected for the agreement of unequal bins by chance.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import id_again, id_columns, mix, shingle_set, small_batches, tidied

#: Words a shingle, bins, and bits kept of each; 4 bits are one hexadecimal digit a bin.
SHINGLE, BINS, BITS = 5, 512, 4
NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def probe_sequences(bins: int, tries: int = 64) -> np.ndarray:
    """Of each bin, the random sequence of bins that it looks into when it is empty."""
    at = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(1, tries + 1, dtype=np.uint64)[None, :]
    return (mix(at) % np.uint64(bins)).astype(np.int64)


PROBES = probe_sequences(BINS)


def bin_values(h: np.ndarray, all_probes: np.ndarray = PROBES) -> np.ndarray | None:
    """The values of all bins from a set of shingle hashes; None for the empty set."""
    if not len(h):
        return None
    bins = len(all_probes)
    h = np.sort(mix(h ^ np.uint64(0x1B873593CC9E2D51)))
    which = (h >> np.uint64(64 - (bins - 1).bit_length())).astype(np.int64)  # bins is a power of two
    full, first = np.unique(which, return_index=True)
    values, known = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    values[full], known[full] = mix(h[first]), True
    empty = np.flatnonzero(~known)
    if len(empty):
        probes = all_probes[empty]
        hit = known[probes]
        found = hit.any(1)
        source = probes[np.arange(len(empty)), hit.argmax(1)]
        for i in np.flatnonzero(~found):  # few full bins: go on around
            source[i] = full[np.searchsorted(full, empty[i]) % len(full)]
        values[empty] = values[source]
    return values


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text; the empty string for one without words."""
    values = bin_values(shingle_set(text, SHINGLE))
    return "" if values is None else DIGITS[(values & np.uint64(15)).astype(np.int64)].tobytes().decode()


def likeness(a: str, b: str) -> float:
    """The estimated similarity of the shingle sets of two fingerprints: two empty ones are alike, one is unlike all others."""
    if not a or not b:
        return float(a == b)
    same = float((np.frombuffer(a.encode(), np.uint8) == np.frombuffer(b.encode(), np.uint8)).mean())
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """text with its last third replaced by the beginning of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


@dataclass(frozen=True)
class Ranges:
    """Ranges of rows in descending order of key, and inside a frequent key in ascending order of its texts' hashes.

    bounds: upper ends of the ranges of keys but the last, ascending, in blocks of WIDE. splits: of the ranges of one frequent
    key, the upper ends of its ranges of hashes.
    """

    bounds: list[int]
    splits: dict[int, list[int]]

    def numbers(self) -> dict[int, int]:
        """The number of the first range of each range of keys, in descending order of key."""
        at, out = 0, {}
        for i in range(len(self.bounds), -1, -1):
            out[i] = at
            at += len(self.splits.get(i, [])) + 1
        return out

    def count(self) -> int:
        return len(self.bounds) + 1 + sum(map(len, self.splits.values()))

    def deal(self, rows: DataFrame) -> DataFrame:
        """rows (key, h, ...) with the number of their range. Blocks and splits are as many as ranges, and broadcast."""
        spark, wide = rows.sparkSession, WIDE
        below = lambda values, x: F.size(F.filter(values, lambda b: b < x))
        blocks = [self.bounds[i : i + wide] for i in range(0, len(self.bounds), wide)] or [[]]
        tops = [b[-1] for b in blocks[:-1]]
        block = below(F.array(*map(F.lit, tops)), F.col("key")) if tops else F.lit(0)
        table = spark.createDataFrame(list(enumerate(blocks)), "block int, ends array<long>")
        x = rows.withColumn("block", block).join(F.broadcast(table), "block")
        x = x.withColumn("part", F.col("block") * wide + below(F.col("ends"), F.col("key"))).drop("block", "ends")
        table = spark.createDataFrame([(i, n, self.splits.get(i, [])) for i, n in self.numbers().items()], "part int, first int, ends array<long>")
        x = x.join(F.broadcast(table), "part").withColumn("range", F.col("first") + below(F.col("ends"), F.col("h")))
        return x.drop("part", "first", "ends")


WIDE = 1024
#: Bytes of text of a range, on average.
RANGE_BYTES = 16 << 20


def even_ranges(rows: DataFrame, parts: int) -> Ranges:
    """About so many ranges of rows (key, h), by approximate quantiles. A key that fills several has ranges of its own."""
    shares = [i / parts for i in range(1, parts)]
    ends = rows.agg(F.percentile_approx("key", shares, max(10_000, 20 * parts))).first()[0] if shares else None
    often = {k: n for k, n in Counter(ends or []).items() if n > 1}
    least = -(1 << 63)
    bounds = sorted({*(ends or []), *(k - 1 for k in often if k > least)})
    # a key alone: the range that ends with it, or the last one
    where = {k: bisect_left(bounds, k) for k in often}
    splits: dict[int, list[int]] = {}
    if often:
        most = max(often.values())
        hot = rows.where(F.col("key").isin(list(often))).groupBy("key").agg(F.percentile_approx("h", [i / (most + 1) for i in range(1, most + 1)], 20 * most + 1000).alias("q"))
        for r in hot.collect():
            n = often[r.key]
            splits[where[r.key]] = sorted({r.q[i * most // n] for i in range(n)})
    return Ranges(bounds, splits)


def fingerprint_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of docs.

    The next document is that with the next lower doc_id, after the lowest the highest; rows with the same doc_id stand in
    the order of their texts' hashes and texts, and a null doc_id is the lowest. A null text is an empty one. A single row is
    its own next. Texts are taken whole; other columns of docs don't matter. No rows give no rows.

    The documents are dealt by ranges of doc_id, as many as the bytes of their texts need and each to a task of its own, and
    sorted there, so that each text is shuffled once; of each range only the first document is copied, to the range before
    it. Rows that share a doc_id are dealt by ranges of their texts' hashes if they fill more than one range.
    """
    spark = docs.sparkSession
    small_batches(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = even_ranges(rows, parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES + 1))
    rows = ranges.deal(rows)
    # the first document of each range, and the range before it: one row a range
    tops = rows.groupBy("range").agg(F.max("key").alias("key")).orderBy("range").collect()
    if not tops:
        return spark.createDataFrame([], NEIGHBOURS)
    heads = spark.createDataFrame([(r["range"], r["key"], tops[i - 1]["range"]) for i, r in enumerate(tops)], "range int, key long, before int")
    # of the documents of the highest id, the first by hash and text
    first = rows.join(F.broadcast(heads), ["range", "key"]).groupBy("before").agg(F.min(F.struct("h", "text")).alias("x"))
    first = first.select(F.col("before").alias("range"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("doc_id"), "x.h", "x.text", F.lit(True).alias("last"))
    every = rows.select("range", "key", "doc_id", "h", "text", F.lit(False).alias("last")).unionByName(first)
    every = every.repartitionById(ranges.count(), F.col("range")).sortWithinPartitions("range", "last", F.desc("key"), "h", "text")

    names = [c.split()[0] for c in NEIGHBOURS.split(", ")][1:]

    @tidied
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for x in batches:
            out = []
            for doc, text, last in zip(zip(x.id, x.no_id, strict=True), x.text, x["last"], strict=True):
                own = fingerprint(text)
                if held is not None:
                    was, before, mark = held
                    changed = edited(before, text)
                    other = fingerprint(changed)
                    out.append((*was, len(before), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), mark, other, likeness(mark, other), likeness(mark, own)))
                held = None if last else (doc, text, own)
            yield pd.DataFrame(out, columns=["id", "no_id", *names]).astype({"id": "int64", "no_id": "bool", "n_chars": "int64"})

    walked = every.select(*id_columns(F.col("doc_id")), "text", "last").mapInPandas(walk, NEIGHBOURS.replace("doc_id long", "id long, no_id boolean"))
    return walked.select(id_again().alias("doc_id"), *names)
