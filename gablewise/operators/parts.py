"""Units of an audit: footprints of one or several parts, each part a unit of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gablewise.functions.text import norm_unit
from gablewise.model import Settings
from gablewise.operators.overlap import area


def load_units(buildings: DataFrame, s: Settings) -> DataFrame:
    """(unit_id, building_id, part, n_parts, road, usage, storeys, ring, area) from buildings (building_id, road, usage, storeys, parts).

    parts is an array of outlines, each an array of points (x, y). A building's largest part always counts, others from a least area on; they are
    numbered by area, of equal ones in their order. Usage comes trimmed, road as it is. Buildings without parts, or with outlines of fewer than three
    points alone, have no unit. Two units of one id are an error of the plan when it runs, as ids are how everything else is joined.
    """
    x = buildings.select("building_id", "road", F.trim("usage").alias("usage"), F.col("storeys").cast("int").alias("storeys"), "parts", F.monotonically_increasing_id().alias("row"))
    x = x.select("building_id", "road", "usage", "storeys", "row", F.posexplode("parts").alias("at", "ring"))
    x = x.where(F.size("ring") >= 3).withColumn("area", area(F.col("ring")))
    w = W.partitionBy("row")
    x = x.withColumn("nth", F.row_number().over(w.orderBy(F.desc("area"), "at"))).where((F.col("nth") == 1) | (F.col("area") >= s.min_part_area))
    x = x.withColumns({"part": F.row_number().over(w.orderBy("nth")), "n_parts": F.count("*").over(w).cast("int")})
    x = x.withColumn("unit_id", F.when(F.col("n_parts") == 1, F.col("building_id")).otherwise(F.concat("building_id", F.lit("_p"), F.col("part").cast("string"))))
    again = F.count("*").over(W.partitionBy("unit_id"))
    x = x.withColumn("again", again).withColumn("unit_id", F.when(F.col("again") > 1, F.raise_error(F.concat(F.lit("repeated unit id "), "unit_id"))).otherwise(F.col("unit_id")))
    return x.select("unit_id", "building_id", "part", "n_parts", "road", "usage", "storeys", "ring", "area")


# What counts as a picture by its name's end.
PICTURES = ("png", "jpg", "jpeg", "webp")


def match_files(files: DataFrame, units: DataFrame) -> DataFrame:
    """(name, unit_id, n) of each picture of files (name): the unit (unit_id, building_id, part) that its name says, and its number, 1 without one.

    A name is a unit's id in any case, perhaps with _ or - and a number. The id of a building of several parts alone means its first part. Of other
    pictures unit_id and n are null; files that aren't pictures, and null names, have no row.
    """
    x = files.select("name", F.regexp_extract("name", r"^(.*)\.([A-Za-z]+)$", 1).alias("stem"), F.lower(F.regexp_extract("name", r"^(.*)\.([A-Za-z]+)$", 2)).alias("kind")).where(F.col("kind").isin(*PICTURES))
    pattern = r"^([A-Za-z0-9]*[0-9](?:_[pP][0-9]+)?)(?:[_-]([0-9]+))?$"
    x = x.select("name", norm_unit(F.regexp_extract("stem", pattern, 1)).alias("said"), F.coalesce(F.regexp_extract("stem", pattern, 2).try_cast("int"), F.lit(1)).alias("n"))
    alone = units.where("part = 1 and unit_id <> building_id").select(F.col("building_id").alias("said"), "unit_id")
    known = units.select(F.col("unit_id").alias("said"), "unit_id").unionByName(alone)
    return x.join(known, "said", "left").select("name", "unit_id", F.when(F.col("unit_id").isNotNull(), F.col("n")).alias("n"))
