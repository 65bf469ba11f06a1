"""Readings noted in short codes: expanded, checked against the planned views, and sorted into valid and rejected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablewise.model import REFERENCE

# The codes of a note, and what they stand for.
VISIBLE_CODES = {"c": "clear", "p": "partly hidden", "h": "hidden"}
SAME_CODES = {"r": REFERENCE, "y": "yes", "n": "no", "?": "cannot tell"}
BETWEEN_CODES = {"y": "yes", "n2": "no, more than one", "np": "no, only part of a larger building", "?": "cannot tell"}


def said(codes: dict[str, str], code: Column) -> Column:
    """What a code stands for; null if it is unknown or null."""
    out = F.lit(None).cast("string")
    for k, v in codes.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def expand(v: Column) -> Column:
    """The views of a note: from an array of structs (vis, same, between, what, hidden_by, boards) in the order of the planned views."""

    def one(x: Column, i: Column) -> Column:
        by = F.when(F.coalesce(x.hidden_by, F.lit("")) != "", x.hidden_by).when(x.vis != "h", "nothing").otherwise("other")
        return F.struct(
            (i + 1).alias("view"), said(VISIBLE_CODES, x.vis).alias("target_visible"), by.alias("hidden_by"), said(BETWEEN_CODES, x["between"]).alias("one_building_between_marks"),
            x.what.alias("what_is_between_marks"), said(SAME_CODES, x.same).alias("same_building_as_reference"), F.coalesce(x.boards, F.array().cast("array<string>")).alias("boards_read"),
        )

    return F.transform(v, one)


def validated(notes: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """(key, views, reference_view, based_on, reason): each note (key, v) against the plan (key, n_views); reason is null for a valid one.

    Rejected are notes of units that aren't planned, with a code that is unknown, with other views than planned, without exactly one
    reference view, or with one that is hidden. If all views are hidden there is none, whatever the note says. A note without views has
    as many as a plan of none. Of repeated keys each note counts. based_on: the views that show the reference's building.
    """
    none = F.array().cast("array<struct<vis:string,same:string,between:string,what:string,hidden_by:string,boards:array<string>>>")
    x = notes.select(key, expand(F.coalesce("v", none)).alias("views")).join(plan.select(key, "n_views"), key, "left")
    unknown = F.exists("views", lambda w: w.target_visible.isNull() | w.same_building_as_reference.isNull() | w.one_building_between_marks.isNull())
    refs = F.transform(F.filter("views", lambda w: w.same_building_as_reference == REFERENCE), lambda w: w.view)
    seen = F.exists("views", lambda w: w.target_visible != "hidden")
    x = x.withColumns({"refs": refs, "seen": seen, "unknown": unknown})
    first = F.get("refs", F.lit(0))
    reason = (
        F.when(F.col("n_views").isNull(), "not planned").when(F.col("unknown"), "unknown code").when(F.size("views") != F.col("n_views"), F.format_string("%d views in the note, %d planned", F.size("views"), F.col("n_views").cast("int")))
        .when(F.col("seen") & (F.size("refs") != 1), F.format_string("%d reference views", F.size("refs"))).when(F.col("seen") & (F.get("views", first - 1).target_visible == "hidden"), "the reference view is hidden")
    )
    based = F.transform(F.filter("views", lambda w: w.same_building_as_reference.isin(REFERENCE, "yes")), lambda w: w.view)
    return x.select(key, "views", F.when(F.col("seen"), first).alias("reference_view"), based.alias("based_on"), reason.alias("reason"))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid readings, and the rejected ones with their reasons."""
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null").select(checked.columns[0], "reason")
