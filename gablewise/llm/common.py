"""What the corpus operators share: scratch tables, hashing of words and shingles, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: texts may be long, so that a task holds some MB at a time.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
#: A table of at most so many narrow rows may be broadcast; beyond it, joins shuffle.
BROADCAST_ROWS = 200_000

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local session without one gets its own."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _own_dir:
        _own_dir[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-gablewise-")
    return _own_dir[sc.applicationId]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gablewise/{name}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, and survives lost executors.

    The files go when forget() is called, or at the latest when the application ends.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    files, at = _files(spark, path)
    files.deleteOnExit(at)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def forget(*saved: DataFrame) -> None:
    """Removes the files of saved tables that no plan will read again."""
    for df in saved:
        files, at = _files(df.sparkSession, df._saved_at)
        files.delete(at, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in rows and bytes unless the session has bounds of its own.

    They are read when a plan runs, also one that an operator has returned, so they stay set.
    """
    known = spark.conf.getAll
    for name, value in BATCHES.items():
        if name not in known:
            spark.conf.set(name, value)


def tidied(f: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that gives freed memory back to the system when it ends: its worker goes on to other tasks."""

    @wraps(f)
    def g(*args):
        yield from f(*args)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return g


def broadcast_if_small(saved: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the (saved, narrow) table has at most so many rows; else the table as it is, for a shuffle join."""
    return F.broadcast(saved) if saved.limit(rows + 1).count() <= rows else saved


def id_columns(c: Column) -> list[Column]:
    """id and no_id of a column of ids, for Python: pandas would turn ids beside nulls into floats."""
    return [F.coalesce(c.cast("long"), F.lit(0)).alias("id"), c.isNull().alias("no_id")]


def id_again() -> Column:
    return F.when(~F.col("no_id"), F.col("id"))


def packed(df: DataFrame, name: str = "row") -> Column:
    """The whole row as one struct, so that its columns clash with none of the operator's."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def words(text: str | None) -> list[bytes]:
    """The runs of characters other than space, tab, LF, VT, FF and CR, with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """One value for each run of k consecutive values, dependent on their order."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out = mix(out) + h[j : j + n] * np.uint64(0x9E3779B97F4A7C15)
    return mix(out)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the text's k-word runs; of the whole sequence if it has fewer words; none without words."""
    ws = words(text)
    if not ws:
        return np.empty(0, np.uint64)
    h = word_hashes(ws)
    if len(h) >= k:
        return np.unique(run_hashes(h, k))
    return run_hashes(np.append(h, np.uint64(len(h))), len(h) + 1)
