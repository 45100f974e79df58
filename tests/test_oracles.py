"""Every registered query against its SQL on the smallest fixture."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tickloom.plans.registry import ORACLES, QUERIES

from .conftest import DATA


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, same, name):
    same(QUERIES[name](spark, DATA), duck.execute(ORACLES[name]).df())


@pytest.mark.parametrize("ids", [(-2000, -1500, -7, 5, -999, 1001), (0, 41, 374, 1015, 1666, 2327)], ids=["negative keys", "halves"])
@pytest.mark.parametrize("name", ["counter_irate", "counter_rate"])
def test_counters_on_odd_keys(spark, same, tmp_path, name, ids):
    """Remainders keep the sign of a key; 41 in 640 s is 0.0640625, whose millionfold as a double is below the half."""
    import duckdb

    rows = [(k, datetime(2024, 1, 1) + timedelta(seconds=640 * i), "view") for i, k in enumerate(ids)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    same(QUERIES[name](spark, str(tmp_path)), con.execute(ORACLES[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
