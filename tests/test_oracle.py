"""Every registered job against its DuckDB twin on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E
from semrec import registry
from scripts.oracle_check import TABLES, digest

from conftest import SF_SMALL

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["split", "user_id", "description", "groundtruth"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(sdf)[0] == digest(odf)[0]
