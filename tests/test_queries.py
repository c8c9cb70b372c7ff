"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
import oracle_check as OC
from strata.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return OC.duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_peer_order_price" in df.columns


def test_every_query_has_oracle_or_is_documented():
    no_sql = set(catalog.QUERIES) - set(catalog.ORACLE_SQL)
    assert not no_sql, no_sql
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    spdf = sdf.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(spdf) > 0
        return
    dpdf = con.execute(sql).to_arrow_table().to_pandas()
    sc, sr = OC._rows(spdf)
    dc, dr = OC._rows(dpdf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
