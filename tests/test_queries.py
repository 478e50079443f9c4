"""Every registered query against its SQL."""

import duckdb
import pytest

from ledgerline import catalogue

from .oracle import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, con, name):
    assert difference(spark, con, SF, catalogue.queries()[name], catalogue.oracle_sql()[name]) is None


def test_times_beyond_four_digits(spark, tmp_path):
    """Keys whose times pass the year 9999, up to 60 times those of sf0.1."""
    rows = spark.range(31_990, 32_020).union(spark.range(899_980, 900_000)).withColumnRenamed("id", "c_custkey")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    assert difference(spark, con, str(tmp_path), catalogue.queries()["event_times"], catalogue.oracle_sql()["event_times"]) is None


def test_all_have_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())
