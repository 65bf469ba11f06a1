"""Every query with SQL gives the SQL's rows on the smallest tables, and spatial ones on larger tables too."""

import math
from pathlib import Path

import duckdb
import pytest

from gablewise.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


LARGER = "/root/testdata/sf0.01"
#: Queries in which rows may hang on the last bit of a coordinate.
SPATIAL = (
    "outline_panos_30m", "outline_visible_points", "outline_square_on", "outline_candidates", "outline_access", "outline_blockers", "outline_panos_usable",
    "los_candidates", "access_class", "bent_nearest_road", "bent_pano_roads", "bent_gap_stats", "bent_picture_points", "stretch_gap_stats", "neighbour_letters", "pano_snapped",
)


def tables(folder):
    c = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def duck(small):
    return tables(small)


@pytest.fixture(scope="session")
def larger_duck():
    return tables(LARGER)


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr(tuple(plain(r[i]) for i in order)) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = rows(df.columns, df.collect())
    r = duck.execute(ORACLES[name])
    assert got == rows([d[0] for d in r.description], r.fetchall())


@pytest.mark.parametrize("name", SPATIAL)
def test_spatial_query_equals_sql_on_larger_tables(spark, larger_duck, name):
    df = QUERIES[name](spark, LARGER)
    got = rows(df.columns, df.collect())
    r = larger_duck.execute(ORACLES[name])
    assert got == rows([d[0] for d in r.description], r.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, small, name):
    assert QUERIES[name](spark, small).collect() is not None
