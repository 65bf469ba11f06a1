"""The audit's entities as views of the star-schema tables.

Every view has an explicit ordinal where the audit depends on an order. The same expressions, as SQL text, start the oracle
queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUILDING = "concat('B', cast({0} - case when {0} % 10 = 1 then 1 else 0 end as string))"

UNITS = {
    "unit_id": "concat('B', cast(p_partkey as string))",
    "building_id": BUILDING.format("p_partkey"),
    "x0": "(p_partkey % 40) * 14.0e0",
    "y0": "floor(p_partkey / 40.0e0) * 24.0e0 + 4.0e0",
    "x1": "(p_partkey % 40) * 14.0e0 + 8.0e0 + (p_size % 4)",
    "y1": "floor(p_partkey / 40.0e0) * 24.0e0 + 14.0e0 + (p_size % 6)",
    "storeys": "cast(p_size % 5 as int)",
    "usage": "case when p_type in ('PROMO', 'SMALL') then 'Commercial' when p_type = 'MEDIUM' then 'Mixed' else 'Residential' end",
    "road": "concat(p_name, case when p_partkey % 3 = 0 then ' STREET' when p_partkey % 3 = 1 then ' St' else ' street' end)",
    "ord": "cast(p_partkey as bigint)",
}
PANOS = {
    "pano_id": "concat('P', cast(c_custkey as string))",
    "pano_date": "case when c_mktsegment in ('BUILDING', 'MACHINERY') then '2022-12' else '2026-02' end",
    "own": "c_nationkey <> 0",
    "px": "((c_custkey * 37) % 5600) / 10.0e0",
    "py": "(c_custkey % n) * 24.0e0 + (c_custkey % 5 - 2) * 0.5e0",
    "pano_ord": "cast(c_custkey as bigint)",
}
ASSESS = {
    "building_id": BUILDING.format("l_partkey"),
    "zone_raw": "case l_returnflag when 'A' then 'A' when 'N' then 'ZONE-B' else '#N/A' end",
    "door_raw": "case when l_linenumber = 7 then '16-Jul' else concat('No. ', cast(l_linenumber as string), '-', cast(cast(l_quantity as int) as string)) end",
    "usage_raw": "case when l_linenumber % 3 = 0 then null when l_linestatus = 'O' then 'Commercial' else 'Residential' end",
    "ord": "cast(l_orderkey * 10 + l_linenumber as bigint)",
}
VIEW_ORDER = "partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax"
ANSWER_VIEWS = {
    "unit_key": "l_orderkey",
    "view": f"cast(row_number() over ({VIEW_ORDER}) as int)",
    "target_visible": "case l_returnflag when 'A' then 'clear' when 'N' then 'partly hidden' else 'hidden' end",
    "hidden_by": "case when l_returnflag <> 'R' then null when l_linenumber % 2 = 0 then 'tree' else 'vehicle' end",
    "same_as_ref": "case when l_linenumber = 1 then 'this is the reference view' when l_linestatus = 'O' then 'yes' when l_suppkey % 3 = 0 then 'cannot tell' else 'no' end",
    "between_marks": "case when l_suppkey % 7 = 0 then 'no, two buildings' else 'yes' end",
    "number_read": "case when l_quantity < 12 then concat(cast(l_linenumber as string), '-', cast(cast(l_quantity as int) as string)) end",
    "has_board": "l_discount > 0.06e0",
}
#: What a second run says of the same views.
SECOND_VIEWS = ANSWER_VIEWS | {
    "target_visible": "case when l_returnflag = 'R' then 'hidden' when l_suppkey % 5 = 0 then 'hidden' else 'clear' end",
    "same_as_ref": "case when l_linenumber = 1 then 'this is the reference view' when l_suppkey % 4 = 0 then 'no' else 'yes' end",
    "between_marks": "case when l_partkey % 11 = 0 then 'no, a part of one' else 'yes' end",
    "number_read": "case when l_quantity > 49 then concat(cast(l_linenumber as string), '-', cast(cast(l_quantity as int) as string)) end",
}
#: One reading a unit_key: what was concluded from all views. Run 2 exists for every third.
READINGS = {
    "unit_key": "o_orderkey",
    "reference_view": "cast(case o_orderkey % 9 when 0 then 2 when 3 then 1 when 4 then 3 when 7 then 9 end as int)",
    "features_both": "o_orderkey % 12 = 0",
    "viewer_placed": "o_orderkey % 8 = 7",
    "moved_away": "case when o_orderkey % 16 = 7 then 'another house' end",
    "aerial2": "case when o_orderkey % 6 = 3 then 'no' else 'yes' end",
    "features_both2": "o_orderkey % 18 = 9",
    "llm_usage2": "case when o_orderkey % 7 = 0 then 'MIXED.' when o_orderkey % 5 = 0 then 'residential' when o_orderkey % 5 = 1 then 'Mixed' when o_orderkey % 5 = 2 then 'Commercial' when o_orderkey % 5 = 3 then 'cannot tell' else '' end",
    "access": "case o_orderkey % 13 when 0 then 'not visible' when 1 then 'not street-facing' else 'street-facing' end",
    "error": "case when o_orderkey % 17 = 2 then 'timeout' end",
    "n_runs": "cast(case when o_orderkey % 17 in (2, 3) then 0 when o_orderkey % 3 = 0 then 2 else 1 end as int)",
    "core_ok": "o_orderkey % 5 <> 0",
    "aerial": "case when o_orderkey % 4 = 0 then 'no' else 'yes' end",
    "second_required": "o_orderkey % 2 = 0",
    "storeys": "cast(o_custkey % 5 as int)",
    "rec_usage": "case o_custkey % 3 when 0 then 'Residential' when 1 then 'Mixed' end",
    "llm_floors": "cast(case when o_custkey % 7 = 0 then null else o_orderkey % 4 end as int)",
    "llm_usage": "case o_orderkey % 5 when 0 then 'Residential' when 1 then 'Mixed' when 2 then 'Commercial' when 3 then 'cannot tell' else '' end",
    "llm_floors2": "cast(o_orderkey % 4 + case when o_custkey % 11 = 0 then 1 else 0 end as int)",
    "possible_shop": "o_totalprice > 100000e0",
    "newest": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then '2022-12' when o_orderpriority = '5-LOW' then null else '2026-02' end",
}
REVIEWS = {
    "unit_key": "user_id",
    "said_at": "ts",
    "file_ord": "event_id",
    "reviewer": "concat('R', cast(event_id % 3 as string))",
    "ident": "case when event_type = 'click' then 'yes' when event_type = 'view' then 'no' else 'cannot tell' end",
    "floors": "cast(case when event_type = 'click' then event_id % 4 end as int)",
    "usage": "case when event_type = 'click' then case event_id % 3 when 0 then 'Residential' when 1 then 'Mixed' else 'cannot tell' end end",
    "shop": "case when event_id % 2 = 0 then 'yes' else 'no' end",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "part"), UNITS)


def last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n): the number of rows of houses, found when a plan runs."""
    return table(spark, sf_dir, "part").agg((F.floor(F.max("p_partkey") / 40).cast("int") + 1).alias("n"))


def panos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "customer").withColumn("n", last_row(spark, sf_dir).scalar()), PANOS)


def assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), ASSESS)


def answer_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), ANSWER_VIEWS)


def second_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), SECOND_VIEWS)


def both_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views with what both runs say of them, the second's columns with a 2 behind; and own_raw, a door number on record of the unit, if the line has one."""
    second = {c + "2": SECOND_VIEWS[c] for c in ("target_visible", "same_as_ref", "between_marks", "hidden_by", "number_read")}
    own = {"own_raw": "case when l_suppkey % 2 = 0 then concat(l_linenumber, '-', cast(l_quantity as int)) end"}
    return _select(table(spark, sf_dir, "lineitem"), ANSWER_VIEWS | second | own)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "orders"), READINGS)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), REVIEWS)


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road lines: a lane below each row of houses that has any, and cross lines. (road_fid, x0, y0, x1, y1, road_name)."""
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 40).cast("bigint").alias("id")).distinct()
    rows = rows.selectExpr("id as road_fid", "-5e0 as x0", "id * 24e0 as y0", "565e0 as x1", "id * 24e0 as y1", "concat('Lane ', cast(id as string)) as road_name")
    cross = last_row(spark, sf_dir).where("n is not null").select("n", F.explode(F.expr("sequence(0L, 3L)")).alias("id"))
    cross = cross.selectExpr("100000 + id as road_fid", "id * 140e0 - 1.5e0 as x0", "-10e0 as y0", "id * 140e0 - 1.5e0 as x1", "n * 24e0 as y1", "concat('Cross ', cast(id as string)) as road_name")
    return rows.unionByName(cross)


def _text(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


#: The same views as common table expressions.
WITH = {
    "units": f"select {_text(UNITS)} from part",
    "panos": f"select {_text(PANOS)} from customer cross join (select cast(floor(max(p_partkey) / 40.0e0) as int) + 1 as n from part) m",
    "assess": f"select {_text(ASSESS)} from lineitem",
    "answer_views": f"select {_text(ANSWER_VIEWS)} from lineitem",
    "second_views": f"select {_text(SECOND_VIEWS)} from lineitem",
    "readings": f"select {_text(READINGS)} from orders",
    "reviews": f"select {_text(REVIEWS)} from events",
    "lanes": "select range as road_fid, -5e0 as x0, range * 24e0 as y0, 565e0 as x1, range * 24e0 as y1, concat('Lane ', range) as road_name from range((select cast(floor(max(p_partkey) / 40.0e0) as int) + 1 from part))"
    " union all select 100000 + range, range * 140e0 - 1.5e0, -10e0, range * 140e0 - 1.5e0, 24e0 * (select cast(floor(max(p_partkey) / 40.0e0) as int) + 1 from part), concat('Cross ', range) from range(4)",
}


def with_views(*names: str) -> str:
    """The start of an oracle query over these views, up to the next common table expression."""
    return "with " + ", ".join(f"{n} as ({WITH[n]})" for n in names)
