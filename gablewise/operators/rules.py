"""What a reading of the pictures proves: identity of the building, and agreement with the record. All are CASE columns.

Readings are summaries of a reading's views, made by view_summary: counts and the reference view's findings, so that no list
of views needs to travel with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablewise.functions.text import norm_usage
from gablewise.model import TRADE_USAGES, VISIBLE



def summary_aggregates(run: str = "") -> list[Column]:
    """What one aggregation says of a run's views (columns view, named, and target_visible, same_as_ref, between_marks, hidden_by of the run)."""
    visible, same, marks, by = (F.col(c + run) for c in ("target_visible", "same_as_ref", "between_marks", "hidden_by"))
    usable, yes = visible.isin(*VISIBLE), same == "yes"
    chosen = usable & (F.col("named").isNull() | (F.col("named") == F.col("view")))
    return [
        F.count("*").alias("n_views" + run),
        F.count_if(usable).alias("n_usable" + run),
        F.min(F.when(chosen, F.struct("view", marks.alias("between_marks"), yes.alias("yes")))).alias("reference" + run),
        F.count_if(usable & yes).alias("n_yes" + run),
        F.array_join(F.array_sort(F.collect_set(F.coalesce(by, F.lit("?")))), ", ").alias("hidden_by" + run),
    ]


def with_summary(x: DataFrame, run: str = "") -> DataFrame:
    """ref_view, ref_marks and n_agree of a run, from its aggregates: a reference that says yes of itself counts once."""
    ref, yes = F.col("reference" + run), F.col("n_yes" + run)
    agree = F.when(ref.isNotNull(), 1 + yes - ref.yes.cast("int")).otherwise(0).cast("long")
    return x.withColumns({"ref_view" + run: ref.view, "ref_marks" + run: ref.between_marks, "n_agree" + run: agree}).drop("reference" + run, "n_yes" + run)


def view_summary(views: DataFrame, key: str, named: DataFrame | None = None) -> DataFrame:
    """One row a reading: usable and agreeing views, the reference view's marks, hiding things, boards.

    named: (key, reference_view), the view that a reading names as its reference. That counts if the building is visible in
    it, else no view agrees; without a name the reference is the first usable view. Those that agree are the reference and the
    other usable ones that say yes. One aggregation, whose rows are mostly combined before the shuffle.
    """
    views = views.withColumn("named", F.lit(None).cast("int")) if named is None else views.join(named.withColumnRenamed("reference_view", "named"), key, "left")
    x = with_summary(views.groupBy(key).agg(*summary_aggregates()))
    return x.select(key, "n_views", "n_usable", "ref_view", "ref_marks", "n_agree", "hidden_by")


def two_view_reason(r: dict[str, Column], run: str = "") -> Column:
    """Why two views of a run ("" or "2") don't prove the building; null if they do."""
    n_usable, n_agree, ref_marks, aerial, both = (r[k + run] for k in ("n_usable", "n_agree", "ref_marks", "aerial", "features_both"))
    return (
        F.when(n_usable < 2, F.lit("only one clear view and no door number read"))
        .when(n_agree < 2, F.lit("no second view clearly shows the same building as the closest view"))
        .when(ref_marks.startswith("no"), F.concat(F.lit("marks in the reference view do not hold exactly one building: "), ref_marks))
        .when((aerial != "yes") & ~both, F.lit("views agree but nothing matches the ortho"))
        .when(~r["core_ok"], F.lit("frontage too narrow for the camera position error; needs a door number"))
    )


def viewer_placed_verdict(r: dict[str, Column]) -> tuple[Column, Column]:
    """(verdict, reason) where a person placed the camera: identity rests on them, but the reading must find one building."""
    none, part, away = r["n_agree"] == 0, r["ref_marks"].startswith("no"), r["moved_away"]
    why = (
        F.when(none, "screenshot: the reading could not confirm the building")
        .when(part, F.concat(F.lit("screenshot shows more than one building or only part of one: "), r["ref_marks"]))
        .when(away.isNotNull(), F.concat(F.lit("screenshot taken away from the planned spot: "), away))
        .otherwise("camera placed by the checker at the planned spot; reading confirms one building")
    )
    return F.when(none | part | away.isNotNull(), "Unsure").otherwise("Verified"), why


def verdict(r: dict[str, Column]) -> tuple[Column, Column]:
    """(verdict, reason) in the order in which the rules bind."""
    two, second = two_view_reason(r), two_view_reason(r, "2")
    ok = F.concat(r["n_agree"].cast("string"), F.lit(" views agree and match the ortho"))
    no_answer, once = r["n_runs"] == 0, r["n_runs"] < 2
    placed = viewer_placed_verdict(r)
    steps = [
        (r["access"] == "not visible", "Not visible", F.lit("no panorama has a line of sight")),
        (r["access"] == "not street-facing", "Not street-facing", F.lit("seen only from a distance, through gaps between other buildings")),
        (no_answer & r["error"].isNotNull(), "Unsure", F.concat(F.lit("LLM error: "), r["error"])),
        (no_answer, "Pending", F.lit("images are ready, the LLM has not been asked yet")),
        (r["n_usable"] == 0, "Not visible", F.concat(F.lit("hidden in every view ("), r["hidden_by"], F.lit(")"))),
        (r["neighbour_hits"] != "", "Unsure", F.concat(F.lit("door number read belongs to a neighbour: "), r["neighbour_hits"])),
        (r["own_hits"] != "", "Verified", F.concat(F.lit("door number read: "), r["own_hits"])),
        (r["viewer_placed"], *placed),
        (two.isNotNull(), "Unsure", two),
        (once & r["second_required"], "Unsure", F.lit("second LLM run missing")),
        (once, "Verified", F.concat(ok, F.lit(" (LLM asked once)"))),
        (second.isNotNull(), "Unsure", F.concat(F.lit("the two LLM runs disagree on identity: "), second)),
    ]
    said, why = F.lit("Verified"), F.concat(ok, F.lit(", in both LLM runs"))
    for test, v, reason in reversed(steps):
        test = F.coalesce(test, F.lit(False))
        said, why = F.when(test, v).otherwise(said), F.when(test, reason).otherwise(why)
    return said, why


def needs_second_opinion(r: dict[str, Column]) -> Column:
    """A second run is asked for if the first would verify the building by its views alone."""
    return (r["own_hits"] == "") & (r["neighbour_hits"] == "") & (r["n_usable"] > 0) & two_view_reason(r).isNull()


def runs_agree(floors: Column, floors2: Column, usage: Column, usage2: Column) -> Column:
    """Do two runs say the same floors and, in any spelling, the same usage?"""
    norm = lambda c: norm_usage(F.coalesce(c, F.lit("None")))
    return floors2.eqNullSafe(floors) & (norm(usage) == norm(usage2))


def record_floors(storeys: Column) -> Column:
    """Storeys on record to floors above ground; none on record for vacant land."""
    return F.when(storeys > 0, storeys - 1)


def floor_flag(llm: Column, record: Column) -> Column:
    return F.when(llm.isNull() | record.isNull(), "Cannot tell").when(llm == record, "Same").when(llm > record, "LLM higher").otherwise("LLM lower")


def usage_flag(llm: Column, record: Column) -> Column:
    return F.when(norm_usage(F.coalesce(llm, F.lit(""))) == norm_usage(record), "Same").otherwise("Different")


def overall_flag(floors: Column, usage: Column, runs_agree: Column, possible_shop: Column, newest: Column, old_before: str) -> Column:
    mismatch = floors.isin("LLM higher", "LLM lower") | (usage == "Different")
    old = F.coalesce(newest < old_before, F.lit(False))
    return (
        F.when(F.coalesce(~runs_agree, F.lit(False)), "LLM runs disagree")
        .when(mismatch & old, "Mismatch (old imagery)")
        .when(mismatch, "Mismatch")
        .when(F.coalesce(possible_shop, F.lit(False)), "Possible shop - check")
        .otherwise("Match")
    )


def vs_survey(llm_usage: Column, llm_floors: Column, rec_usage: Column, rec_floors: Column, upper_unseen: Column) -> Column:
    """How the reading differs from the survey, in words."""
    unclear = upper_unseen & (norm_usage(llm_usage) == "commercial") & (norm_usage(rec_usage) == "mixed")
    kind = F.when(norm_usage(llm_usage) != norm_usage(rec_usage), F.when(unclear, "type unclear (upper floors not seen)").otherwise("type differs"))
    floors = F.when(llm_floors != rec_floors, "floors differ")
    said = F.concat_ws(" and ", kind, floors)
    none = llm_usage.isNull() | llm_usage.isin("", "cannot tell")
    return F.when(none, "-").when(said == "", "same").otherwise(said)


def shop(usage: Column, possible: Column) -> Column:
    return F.when(usage.isin(*TRADE_USAGES), "yes").when(F.coalesce(possible, F.lit(False)), "possible").otherwise("no")


def zone_fit(zone: Column, road_type: Column, width: Column, shops: Column, trade_pct: Column, n_read: Column) -> Column:
    """Does a street look like its zone? road_type is null for a street that wasn't read."""
    true = lambda c: F.coalesce(c, F.lit(False))
    main = true(road_type == "main road") | true(shops.isin("about half", "mostly")) | true((n_read >= 5) & (trade_pct >= 50))
    lane = true(road_type.isin("lane", "dead end")) & true(width == "1 lane") & true(shops.isin("none", "few")) & F.coalesce(trade_pct < 20, F.lit(True))
    return (
        F.when(zone.isNull(), "no zone").when(road_type.isNull(), "not read")
        .when(main & zone.isin("B", "C"), "zone may be low").when(lane & (zone == "A"), "zone may be high").otherwise("fits")
    )
