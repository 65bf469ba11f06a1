"""Periodic runs of words, and texts without the repetitions in them.

A run's Lyndon root, under one of the two orders of words, is the longest Lyndon word that starts where the root does. So a stack scanned
from right to left under both orders gives, for every place of a text, the only two periods that a run with a root there can have; two
extensions, to the right and to the left, give the run. Comparing and extending need the length of the longest common extension of two
places: rolling hashes of all prefixes bound it by binary search, and the words themselves are compared afterwards. What has been
compared is remembered for each distance, so that a text of one repeated word costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablewise.llm.common import id_again, id_columns, mix, small_batches, tidied

LEAST, TIMES = 24, 3
WORD = r"[^\x20\x09-\x0D]+"
#: A prime under 2**31, so that products of two residues fit a long, and a base. Equal hashes are never the last word.
PRIME, BASE = 2147483647, 1000003
#: Words that a comparison looks at before it asks the hashes.
DIRECT = 12


class Extensions:
    """Longest common extensions in a sequence of numbers from 0 on."""

    def __init__(self, ids: list[int]):
        self.ids, self.n = ids, len(ids)
        self.array = np.array(ids, np.int64)
        self.tables: tuple[np.ndarray, np.ndarray] | None = None
        self.same: dict[int, tuple[int, int]] = {}  # distance: the last stretch found equal to the one so far on, which ends with it

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base, and the hashes of all prefixes."""
        if self.tables is None:
            powers = np.ones(1, np.int64)
            while len(powers) <= self.n:
                powers = np.concatenate([powers, powers * pow(BASE, len(powers), PRIME) % PRIME])
            values = mix(self.array.astype(np.uint64) + np.uint64(1)) % np.uint64(PRIME)
            terms = values.astype(np.int64) * powers[: self.n] % PRIME
            self.tables = powers, np.concatenate([[0], np.cumsum(terms) % PRIME])
        return self.tables

    def reach(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """By the hashes: how many words from i and from j on (i < j) are equal, or up to and without i and j."""
        powers, upto = self.prefixes()
        low, high = np.zeros(len(i), np.int64), np.array(i if back else self.n - j, np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            a, b = (i - middle, i) if back else (i, i + middle)
            d = j - i
            ok = (upto[b] - upto[a]) % PRIME * powers[d] % PRIME == (upto[b + d] - upto[a + d]) % PRIME
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        return low

    def compare(self, i: int, j: int) -> int:
        """How many words from i and from j on (i < j) are equal."""
        ids, k, most, apart = self.ids, 0, self.n - j, j - i
        start, end = self.same.get(apart, (self.n, 0))
        while k < DIRECT:
            if start <= i + k <= end:
                self.same[apart] = (min(start, i), end)
                return end - i
            if k == most or ids[i + k] != ids[j + k]:
                return k
            k += 1
        powers, upto = self.prefixes()
        power, at, to = int(powers[apart]), int(upto[i]), int(upto[j])
        alike = lambda m: (int(upto[i + m]) - at) * power % PRIME == (int(upto[j + m]) - to) % PRIME
        low, step = k, k
        while low + step <= most and alike(low + step):
            low, step = low + step, 2 * step
        high = min(most, low + step - 1)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if alike(middle) else (low, middle - 1)
        return self.verified(i, apart, low)

    def verified(self, i: int, apart: int, length: int) -> int:
        """The length, or less if the words that many places apart differ before."""
        start, end = self.same.get(apart, (0, 0))
        if not i < start <= end <= i + length:
            start = end = i
        for a, b in ((i, start), (end, i + length)):
            differ = np.flatnonzero(self.array[a:b] != self.array[a + apart : b + apart])
            if len(differ):
                length = int(a + differ[0]) - i
                break
        self.same[apart] = (i, i + length)
        return length


def lyndon_ends(ids: list[int], same: Extensions) -> list[int]:
    """Where the longest Lyndon word ends that starts at each place; ids may be negated for the other order, `same` has either."""
    n = len(ids)
    ends = [n] * n
    for i in range(n - 1, -1, -1):
        x, j = ids[i], i + 1
        while j < n:
            y = ids[j]
            if x == y:
                k = same.compare(i, j)
                if j + k == n or ids[i + k] > ids[j + k]:
                    break
            elif x > y:
                break
            j = ends[j]
        ends[i] = j
    return ends


def find_runs(ids: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, period, length) of all runs of at least `least` numbers and `times` (2 or more) periods, in order."""
    n = len(ids)
    if n < max(least, times):
        return []
    same = Extensions(ids)
    padded = np.append(same.array, -1)  # also stands before the first
    at, found = np.arange(n), set()
    for order in (ids, [-x for x in ids]):
        ends = np.array(lyndon_ends(order, same), np.int64)
        # a neighbouring word must agree with the one a period on, and the run must have room
        here = np.flatnonzero((times * (ends - at) <= n) & ((padded[ends] == padded[at]) | (padded[at - 1] == padded[ends - 1])))
        if not len(here):
            continue
        i, j = here, ends[here]
        ahead, behind = same.reach(i, j), same.reach(i, j, back=True)
        length = ahead + behind + j - i
        keep = length >= np.maximum(least, times * (j - i))
        found |= {(s, p, m) for s, p, m in zip((i - behind)[keep].tolist(), (j - i)[keep].tolist(), length[keep].tolist(), strict=True)}
    out = set()
    for s, p, m in found:  # the words themselves
        e, a = s + m, same.array
        if (a[s : e - p] == a[s + p : e]).all() and not (s and a[s - 1] == a[s + p - 1]) and not (e < n and a[e] == a[e - p]):
            out.add((s, p, m))
        else:  # equal hashes of different words: whatever runs of that period there are
            equal = np.concatenate([[False], a[:-p] == a[p:], [False]])
            edges = np.flatnonzero(equal[1:] != equal[:-1]).reshape(-1, 2)
            out |= {(int(x), p, int(y - x) + p) for x, y in edges if y - x + p >= max(least, times * p) and smallest_period(ids[x : y + p]) == p}
    return sorted(out)


def smallest_period(ids: list[int]) -> int:
    """By the table of borders."""
    border, k = [0] * len(ids), 0
    for i in range(1, len(ids)):
        while k and ids[i] != ids[k]:
            k = border[k - 1]
        k += ids[i] == ids[k]
        border[i] = k
    return len(ids) - k


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of docs (doc_id, text).

    runs: an array of structs (start, period, length), in words, of every run of at least `least` words and `times` periods, by start,
    then period. collapsed: the words, joined by a space, that no run contains after its first period. Words are what stands between
    space, tab, LF, VT, FF and CR, compared as they are. A null text is an empty one: no runs, nothing collapsed. Null and repeated
    doc_ids give a row each; other columns of docs don't matter; no rows give no rows. A very long text is one task's work, in time
    that grows with its words times the logarithm of their number.
    """
    small_batches(docs.sparkSession)

    @tidied
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            got = []
            for text in x.pop("text"):
                ws = text.encode("utf-8", "replace").split()
                numbers: dict[bytes, int] = {}
                runs = find_runs([numbers.setdefault(w, len(numbers)) for w in ws], least, times)
                if runs:
                    edges = np.zeros(len(ws) + 1, np.int64)
                    for s, p, m in runs:
                        edges[s + p] += 1
                        edges[s + m] -= 1
                    ws = [ws[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                got.append((*([r[k] for r in runs] for k in range(3)), b" ".join(ws).decode("utf-8")))
            x["start"], x["period"], x["length"], x["collapsed"] = zip(*got, strict=True) if got else ([], [], [], [])
            yield x

    rows = docs.select(*id_columns(F.col("doc_id")), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.mapInPandas(scan, "id long, no_id boolean, start array<long>, period array<long>, length array<long>, collapsed string")
    return rows.select(id_again().alias("doc_id"), F.arrays_zip("start", "period", "length").alias("runs"), "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with a period put into about every tenth text; those without words or without a doc_id stay as they are.

    h is the crc32 of the decimal doc_id and g = floor(h / 10). In a text of n words with h % 10 = 0, each word i from a = g % n on
    becomes word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("ws"))
    chosen = chosen.withColumn("n", F.size("ws")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    n, a = F.col("n"), F.col("a")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    part = F.slice("ws", a + 1, p)
    again = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.array_join(F.concat(F.slice("ws", F.lit(1), a), again), " ")
    return chosen.select("doc_id", F.when(a.isNotNull(), text).otherwise(F.col("text")).alias("text"))


def best_run(runs: Column) -> Column:
    """The first of the runs with the greatest length / period; null without any."""
    better = lambda best, r: F.when(best.isNull() | (r.length * best.period > best.length * r.period), r).otherwise(best)
    return F.aggregate(F.slice(runs, 2, 1 << 30), F.get(runs, F.lit(0)), better)


def run_digests(docs: DataFrame) -> DataFrame:
    """What periodic_runs finds in planted texts: counts, the run of the greatest exponent, and digests."""
    x = periodic_runs(planted(docs)).withColumn("best", best_run(F.col("runs")))
    best = F.col("best")
    line = lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))
    return x.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"), best.period.alias("period"),
        F.floor(1000 * best.length / best.period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
