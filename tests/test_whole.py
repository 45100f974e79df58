"""Registered queries read their whole table: brute force on small tables that earlier cuts would have shortened."""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta

from tickloom.plans.graph import CHAIN_NODES
from tickloom.plans.registry import QUERIES
from tickloom.sources.fixtures import AS_OF_EVENTS_MS


def test_chain_reads_late_orders(spark, tmp_path):
    keys = [(9980, 3), (9976, 12), (5012, 25), (19971, 5012), (40007, 25), (7, 7), (25 + CHAIN_NODES, 60), (60 + 3 * CHAIN_NODES, 61), (61, 62), (7 + 5 * CHAIN_NODES, 25)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    edges = {(f"N{c}", f"N{k % CHAIN_NODES}") for k, c in keys if c != k % CHAIN_NODES}
    paths = front = [(a, b) for a, b in edges if b == "N7"]
    for _ in range(4):
        front = [(a, *p) for p in front for a, b in edges if b == p[0] and a not in p]
        paths = paths + front
    got = QUERIES["causal_chain"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r["path"].split(">")) for r in got) == sorted(paths) and len(paths) > 5 and max(map(len, paths)) == 5


def test_no_data_reads_the_whole_span(spark, tmp_path):
    """A gap of an hour on the last day is reported, at the place it has."""
    first, step, n = AS_OF_EVENTS_MS - 30 * 86_400_000, 600_000, 30 * 144
    gap = set(range(n - 10, n - 4))
    rows = [(k, "view", k, datetime.fromtimestamp((first + k * step) / 1000, UTC).replace(tzinfo=None) + timedelta(seconds=5), 1.0, json.dumps({"k": 1})) for k in range(n) if k not in gap]
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, ts timestamp_ntz, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = [tuple(r) for r in QUERIES["no_data_flow_alert"](spark, str(tmp_path)).select("symbol", "started", "ended", "samples").collect()]
    assert got == [("SYM_VIEW", first + min(gap) * step, first + max(gap) * step, len(gap))]
