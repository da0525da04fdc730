"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from fleetlens.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "lineitem supplier events".split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def plain(rows):
    def value(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v

    return sorted((tuple(value(v) for v in r) for r in rows), key=lambda r: [(v is None, str(type(v)) if isinstance(v, str) else "", v if v is not None else 0) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert plain(got.select(*names).collect()) == plain(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
