"""Files of a run: inputs that may be missing, answers as JSON, and layers that are published whole or not at all."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ANSWER = "struct<views:array<struct<view:int,target_visible:string,hidden_by:string,same_building_as_reference:string,one_building_between_marks:string,numbers_read:array<string>,boards_read:array<string>>>,zoom_numbers_read:array<string>,reference_view:int,classification:struct<floors_above_ground:int,building_usage:string,possible_shop:boolean>>"


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def settled(df: DataFrame) -> DataFrame:
    """df, computed and kept in the shared folder of spark.checkpoint.dir, with its lineage cut: for loops, and to survive lost executors.

    Only a local session without such a folder gets its own.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        root = sc.getConf().get("spark.checkpoint.dir")
        if not root and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="spark-gablewise-"))
    return df.checkpoint()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path, or one without rows if nothing is there."""
    fs, p = filesystem(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(p) else spark.createDataFrame([], schema)


def last_notes(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines, of which the last of each key counts: by file, then by place in it."""
    lines = spark.read.schema(schema).json(path).withColumns({"file": F.col("_metadata.file_path"), "place": F.monotonically_increasing_id()})
    best = lines.groupBy(key).agg(F.max_by(F.struct(*[c for c in lines.columns if c not in (key, "file", "place")]), F.struct("file", "place")).alias("x"))
    return best.select(key, "x.*")


def parse_answer(text: Column) -> Column:
    """A reading from its JSON, which may stand alone in a list; null if it is broken or has no classification."""
    t = F.trim(text)
    inner = F.when(t.startswith("["), F.get(F.from_json(t, f"array<{ANSWER}>"), F.lit(0))).otherwise(F.from_json(t, ANSWER))
    one = ~t.startswith("[") | (F.json_array_length(t) == 1)
    return F.when(one & inner.classification.isNotNull(), inner)


def publish(df: DataFrame, path: str) -> int:
    """Writes df beside path, checks the number of rows read back, and only then puts it in the place of what was there."""
    spark = df.sparkSession
    fresh, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}.old"
    n = F.count("*")
    seen = Observation()
    df.observe(seen, n.alias("n")).write.parquet(fresh)
    count = spark.read.schema(df.schema).parquet(fresh).count()
    if count != seen.get["n"]:
        raise RuntimeError(f"{path}: {count} rows read back of {seen.get['n']}")
    fs, target = filesystem(spark, path)
    _, source = filesystem(spark, fresh)
    _, aside = filesystem(spark, old)
    if fs.exists(target):
        fs.rename(target, aside)
    if not fs.rename(source, target):
        raise RuntimeError(f"{path}: the new layer is at {fresh}")
    fs.delete(aside, True)
    return count


def to_feature(geometry: Column, properties: Sequence[str]) -> Column:
    """A GeoJSON feature as a line of text; geometry is a struct (type, coordinates)."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")))


def rectangle(x0: str, y0: str, x1: str, y1: str) -> Column:
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def write_features(df: DataFrame, geometry: Column, properties: Sequence[str], path: str) -> None:
    """A layer as line-delimited GeoJSON, one feature a line, in as many files as the data has partitions."""
    df.select(to_feature(geometry, properties).alias("value")).write.mode("overwrite").text(path)


def vanished_notes(notes: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Notes on rows that are there no more, to be kept aside."""
    return notes.join(rows.select(*key).distinct(), list(key), "left_anti")


def latest_result(names: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """(key, latest): of each key's files the newest result: result.gpkg, or of result_<n>.gpkg the one with the highest n."""
    number = F.when(F.col(name) == "result.gpkg", 1).otherwise(F.regexp_extract(name, r"^result_(\d+)\.gpkg$", 1).try_cast("int"))
    x = names.withColumn("number", number).where("number is not null")
    return x.groupBy(*key).agg(F.max_by(name, F.struct("number", name)).alias("latest"))


GEOMETRY = "struct<type:string,coordinates:string>"
POINTS = "array<array<double>>"


def load_roads(rows: DataFrame, fid: str, geometry: str, name: str) -> DataFrame:
    """(road_fid, part, road_name, path) from GeoJSON geometries: single lines of two points at least, each with its points (x, y).

    Lines of several parts give a row each; other shapes, empty ones and nulls none. A blank name is null.
    """
    g = F.from_json(F.col(geometry), GEOMETRY)
    lines = F.when(g.type == "LineString", F.array(F.from_json(g.coordinates, POINTS))).when(g.type == "MultiLineString", F.from_json(g.coordinates, f"array<{POINTS}>"))
    x = rows.select(F.col(fid).alias("road_fid"), F.nullif(F.trim(name), F.lit("")).alias("road_name"), F.posexplode(lines).alias("at", "line")).where(F.size("line") > 1)
    path = F.transform("line", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return x.select("road_fid", (F.col("at") + 1).alias("part"), "road_name", path.alias("path"))


def write_summary(figures: DataFrame, name: str, value: str, path: str) -> None:
    """A small table of figures as one JSON object, put in the place of what was there."""
    one = figures.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(name), F.col(value)))))).alias("text"))
    fs, fresh = filesystem(figures.sparkSession, f"{path}.{uuid.uuid4().hex}")
    _, target = filesystem(figures.sparkSession, path)
    one.coalesce(1).write.text(str(fresh.toString()))
    part = next(x.getPath() for x in fs.listStatus(fresh) if x.getPath().getName().startswith("part-"))
    _, aside = filesystem(figures.sparkSession, f"{path}.{uuid.uuid4().hex}.old")
    if fs.exists(target):  # the old one is there until the new one is in its place
        fs.rename(target, aside)
    if not fs.rename(part, target):
        fs.rename(aside, target)
        raise RuntimeError(f"{path}: the new summary is at {fresh}")
    fs.delete(aside, True)
    fs.delete(fresh, True)
