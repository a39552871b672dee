"""Every query over the driver tables against its SQL."""

import os

import duckdb
import pytest

from statloom.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def rows(names, values):
    at = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(f"{v[k]:.6g}" if isinstance(v[k], float) else str(v[k]) for k in at) for v in values)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df, sql = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert rows(df.columns, df.collect()) == rows(sql.columns, sql.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    QUERIES[name](spark, SF).limit(5).collect()
