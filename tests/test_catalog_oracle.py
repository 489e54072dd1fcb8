"""Every catalogue query against its DuckDB oracle on the smallest test tables."""

import duckdb
import pytest

from __spark_entry__ import entry, queries as all_queries
from tessera.plans.catalog import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sp = all_queries()[name](spark, SF).toPandas()
    dp = con.execute(ORACLE_SQL[name]).df()
    assert sorted(sp.columns) == sorted(dp.columns)
    assert len(sp) == len(dp)
    assert rows_of(sp) == rows_of(dp)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "cost_share" in df.columns


def test_cost_shares_sum_to_state_cost(spark):
    from pyspark.sql import functions as F
    df = all_queries()["q19_cost_share_fact"](spark, SF)
    per = df.groupBy("o_custkey", "yr").agg(F.sum("cost_share").alias("s"), F.first("state_cost").alias("c"),
                                            F.sum("run_share").alias("shares"))
    bad = per.filter((F.abs(F.col("s") - F.col("c")) > 1e-4 * F.greatest(F.lit(1.0), F.abs("c")))
                     | (F.abs(F.col("shares") - 1.0) > 1e-9)).count()
    assert bad == 0
