"""Packing documents into sequences by minimum bin slack.

For each bin, the longest piece that is left goes in first; then a subset-sum dynamic program over bitsets finds the fullest
combination of the lengths that are left, which is removed. All that the program needs is how many pieces each length has: a
table no longer than a sequence, whatever the number of documents. So one combination fills all bins that it can before the
next is sought; the number of combinations is bounded by the harmonic sum of the capacity. The pieces then find their places
by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, id_again, id_columns, packed, save, small_batches, tidied
from gablewise.llm.tokens import cached_encoder

CAPACITY = 1024
END_OF_DOCUMENT = 2
#: Rows of one length that are ranked together, on average: a fourth of a partition's share, and this many at least.
RANKED = 256


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of available lengths that fills the room as far as any can."""
    reach = 1  # bit s: the sum s can be had
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # length, times, sums before it
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, power = min(counts[length], room // length), 1
        while left:
            n = min(power, left)
            steps.append((length, n, reach))
            reach |= (reach << (n * length)) & mask
            left -= n
            power *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, n, before in reversed(steps):
        if total and not before >> total & 1:
            used[length] = used.get(length, 0) + n
            total -= n * length
    return list(used.items())


def bin_plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Which pieces go where: (length, first, per_bin, bins, first_bin, place).

    The pieces of a length with ranks first .. first + per_bin * bins - 1 go to bins first_bin .. first_bin + bins - 1, per_bin
    to each, one after the other from `place` on.
    """
    left = {k: v for k, v in counts.items() if v}
    taken = dict.fromkeys(left, 0)
    rows, next_bin = [], 0
    while left:
        seed = max(left)
        left[seed] -= 1
        combination = dict(fullest(left, capacity - seed))
        left[seed] += 1
        combination[seed] = combination.get(seed, 0) + 1
        bins = min(left[k] // n for k, n in combination.items())
        place = 0
        for k, n in sorted(combination.items(), reverse=True):
            rows.append((k, taken[k], n, bins, next_bin, place))
            taken[k] += n * bins
            left[k] -= n * bins
            place += n * k
            if not left[k]:
                del left[k]
        next_bin += bins
    return pd.DataFrame(rows, columns=["length", "first", "per_bin", "bins", "first_bin", "place"]).astype("int64")


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of docs (doc_id, text), in no order.

    A document is its token ids and an end mark. The first piece has what its length leaves over, the others are full. A null
    text is an empty one: its piece holds the end mark alone.
    """
    small_batches(docs.sparkSession)
    end = int(END_OF_DOCUMENT).to_bytes(4, "little")

    @tidied
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = cached_encoder(vocabulary)
        for x in batches:
            out = []
            for doc, none, text in zip(x.id, x.no_id, x.text, strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                ends = list(range(n % capacity or capacity, n + 1, capacity))
                for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                    out.append((doc, none, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            yield pd.DataFrame(out, columns=["id", "no_id", "piece", "start", "length", "ids_crc32"])
        encode.known.clear()

    rows = docs.select(*id_columns(F.col("doc_id")), "text").mapInPandas(cut, "id long, no_id boolean, piece int, start long, length long, ids_crc32 long")
    return rows.select(id_again().alias("doc_id"), "piece", "start", "length", "ids_crc32")


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to saved rows with a length from 1 to capacity.

    Ranks come from prefix sums in two levels: the rows of a length fall into parts by hash, as many as the length needs, and
    are ranked inside a part after the sizes of the parts before; so a length that most rows have is no one task's work.
    """
    spark = found.sparkSession
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most `capacity` rows
    if not counts:
        return found.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    ranked = max(RANKED, sum(counts.values()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    parts = spark.createDataFrame([(k, v // ranked + 1) for k, v in counts.items()], "length long, parts long")
    rows = found.withColumn("all", packed(found)).join(F.broadcast(parts), "length")
    h = F.xxhash64(*[f"all.{c}" for c in found.columns])
    rows = rows.select("all", "length", F.pmod(h, "parts").alias("part"), h.alias("h"))
    sizes = rows.groupBy("length", "part").count()
    before = F.sum("count").over(W.partitionBy("length").orderBy("part")) - F.col("count")
    before = broadcast_if_small(save(sizes.select("length", "part", before.alias("before")), "pack-parts"))
    order = W.partitionBy("length", "part").orderBy("h", *[f"all.{c}" for c in found.columns])
    rows = rows.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.row_number().over(order) - 1)

    # a range join: of the plan's rows of a length, the one whose ranks hold the row's
    plan = bin_plan(counts, capacity)
    plan = spark.createDataFrame(plan.assign(end=plan["first"] + plan.per_bin * plan.bins)).withColumnRenamed("length", "of")
    rows = rows.join(F.broadcast(plan), (F.col("of") == F.col("length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    of = F.col("rank") - F.col("first")
    sequence = F.col("first_bin") + F.floor(of / F.col("per_bin"))
    return rows.select("all.*", sequence.cast("long").alias("sequence_id"), (F.col("place") + of % F.col("per_bin") * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of docs (doc_id, text).

    Rows with a null or repeated doc_id are packed like any others; a very long text gives as many pieces as it needs. Other
    columns of docs don't matter. No rows give no rows.
    """
    return place(save(pieces(docs, vocabulary, capacity), "pack-pieces"), capacity)
