"""Deciding a street's name from the signs along it."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablewise.functions.signs import normal_name, street_number
from gablewise.sources.files import settled

ALIKE = 0.85
#: How a decision is put in words.
STATUS = {
    "a": "Accepted - board confirms",
    "b, other name": "Board overrides road layer",
    "b, no name": "Accepted - board (no road layer name)",
    "c": "Accepted - shop addresses agree",
    "conflict": "Conflict - needs review",
    "d": "Unverified - road layer only",
    "none, a sign": "Unverified - single sign only",
    "none": "No name found",
}


def _plain(name: str) -> str:
    return re.sub(r"[^a-z0-9\u0B80-\u0BFF]", "", name.lower())


def first_groups(names: list[str], numbers: list[str | None]) -> tuple[list[int], list[str]]:
    """The group of each name in turn, the first whose longest name so far it is like, and each group's longest name.

    Two names' letters are compared once, whatever their number. A name that comes again goes where it went before, unless the groups before that one, or it, have
    got other names since.
    """
    heads: list[tuple[str, str | None]] = []
    renamed: list[int] = []  # the groups that got another name, in turn
    known: dict[tuple[str, str], bool] = {}
    plain: dict[str, str] = {}
    went: dict[tuple[str, str | None], tuple[int, int]] = {}  # where, and after how many changes

    def like(name: str, number: str | None, head: str, n: str | None) -> bool:
        if name.lower() == head.lower():
            return True
        if n != number:
            return False
        low, top = (plain.get(x) or plain.setdefault(x, _plain(x)) for x in (name, head))
        hit = known.get((low, top))
        if hit is None:
            # what two names can have in common at most is counted first
            few = 2 * min(len(low), len(top)) < ALIKE * (len(low) + len(top))
            m = difflib.SequenceMatcher(None, low, top)
            hit = known[low, top] = not few and m.quick_ratio() >= ALIKE and m.ratio() >= ALIKE
        return hit

    at = []
    for name, number in zip(names, numbers, strict=True):
        i, upto = went.get((name, number), (None, 0))
        if i is None or any(j <= i for j in renamed[upto:]):
            i = next((k for k, (head, n) in enumerate(heads) if like(name, number, head, n)), None)
            if i is None:
                i = len(heads)
                heads.append((name, number))
            elif len(name) > len(heads[i][0]):
                heads[i] = name, number
                renamed.append(i)
        went[name, number] = i, len(renamed)
        at.append(i)
    return at, [head for head, _ in heads]


def leader_groups(evidence: DataFrame, key: str) -> DataFrame:
    """Evidence (key, ord, name, kind, unit_id, dist_m) with group and group_name: in order, each name joins the first group it is like.

    A group is called by its longest name so far, so the order matters; a key's evidence is the signs of one stretch. Rows
    without a name are left out.
    """
    # made once a row: nothing is carried through a generator
    x = evidence.withColumn("name", F.explode(F.array(normal_name(F.col("name"))))).where("name is not null").withColumn("number", street_number(F.lower("name")))

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        at, heads = first_groups(pdf["name"].tolist(), pdf.number.tolist())
        out = pdf.drop(columns="number")
        return out.assign(group=at, group_name=[heads[i] for i in at])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.drop("number").schema)
    return x.groupBy(key, "kind").applyInPandas(group, f"{schema}, group int, group_name string")


def decide_names(evidence: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """(key, name, rule, status, fix) from the signs along each stretch and the road layer's name (key, candidate).

    A board like the candidate confirms it (a); else the largest group of boards decides (b), two equally large ones conflict;
    without boards two buildings' addresses that agree decide (c), one vote a building; then the candidate (d); then the most
    common sign (none). Likeness to the candidate is tested on the few group names.
    """
    from gablewise.functions.signs import same_road

    e = settled(leader_groups(evidence, key))  # read four times
    first = e.where("kind = 'shop_address'").groupBy(key, "kind", "unit_id").agg(F.min("ord").alias("ord"))
    votes = e.where("kind = 'street_name_board'").unionByName(e.join(first, [key, "kind", "unit_id", "ord"], "left_semi"))
    cand = candidates.select(key, normal_name(F.col("candidate")).alias("candidate"))
    g = votes.groupBy(key, "kind", "group", "group_name").agg(F.count("*").alias("n"), F.min("dist_m").alias("near")).join(cand, key, "left")
    g = g.withColumn("hit", same_road(F.col("group_name"), F.col("candidate")))
    one = F.struct((-F.col("n")).alias("less"), F.when(F.col("kind") == "street_name_board", F.col("near")).otherwise(F.lit(0.0)).alias("near"), "group", F.col("group_name").alias("name"), "hit")
    sorts = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, one)))
    hit = F.min(F.when(F.col("hit") & (F.col("kind") == "street_name_board"), F.struct("group", "group_name")))
    per = g.groupBy(key).agg(sorts("street_name_board").alias("boards"), sorts("shop_address").alias("shops"), hit.alias("confirmed"))
    common = e.groupBy(key, "name").agg(F.count("*").alias("n"), F.min("ord").alias("ord"))
    common = common.groupBy(key).agg(F.min_by("name", F.struct((-F.col("n")).alias("a"), "ord")).alias("common"))
    x = cand.join(per, key, "full").join(common, key, "full")
    top = lambda c: F.get(c, F.lit(0))
    tie = lambda c: F.coalesce(F.get(c, F.lit(1)).less == top(c).less, F.lit(False))
    has_board, agree = F.coalesce(F.size("boards"), F.lit(0)) > 0, F.coalesce(top(F.col("shops")).less <= -2, F.lit(False))
    rule = (
        F.when(F.col("confirmed").isNotNull(), "a").when(has_board & tie(F.col("boards")), "conflict").when(has_board, "b")
        .when(agree & tie(F.col("shops")), "conflict").when(agree, "c").when(F.col("candidate").isNotNull(), "d").otherwise("none")
    )
    x = x.withColumn("rule", rule)
    name = F.when(rule == "a", F.col("confirmed.group_name")).when(rule == "b", top(F.col("boards"))["name"]).when(rule == "c", top(F.col("shops"))["name"]).when(rule == "d", F.col("candidate")).when(rule == "none", F.col("common"))
    fix = ((rule == "b") & F.col("candidate").isNotNull()) | ((rule == "c") & F.col("candidate").isNotNull() & ~top(F.col("shops")).hit)
    known = F.col("candidate").isNotNull()
    status = (
        F.when(rule == "a", STATUS["a"]).when(rule == "conflict", STATUS["conflict"]).when((rule == "b") & known, STATUS["b, other name"]).when(rule == "b", STATUS["b, no name"])
        .when(rule == "c", STATUS["c"]).when(rule == "d", STATUS["d"]).when(F.col("common").isNotNull(), STATUS["none, a sign"]).otherwise(STATUS["none"])
    )
    return x.select(key, name.alias("name"), "rule", status.alias("status"), F.coalesce(fix, F.lit(False)).alias("fix"))
