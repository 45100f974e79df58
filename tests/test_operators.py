"""Cases of the graph, feature, provenance, heartbeat and alert operators that the fixture does not reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.columns import range_join, sustained
from tickloom.operators import alerts, features, graph, heartbeat, ohlcv, provenance


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_exposure_needs_an_affected_pair(spark):
    make = spark.createDataFrame
    g = {
        "cascade": make([(1, 100, 0.9, 1.0, 0.2, "x")], "id long, ts_ms long, severity double, spread_velocity double, max_drawdown double, origin_exchange string"),
        "affected": make([(1, "P")], "cascade_id long, pair string"),
        "lists": make([("x", "Q")], "exchange string, pair string"),
    }
    assert graph.cascade_exposure(g, "x", 200, 150).count() == 0
    g["lists"] = make([("x", "P")], "exchange string, pair string")
    assert rows(graph.cascade_exposure(g, "x", 200, 150)) == [(1, 0.9, 0.2, 1)]
    g["lists"] = make([("y", "P")], "exchange string, pair string")
    assert graph.cascade_paths(g, "x", "y").count() == 1 and graph.cascade_paths(g, "x", "y", max_hops=1).count() == 0


def test_edges_follow_the_clause_order(spark):
    make = spark.createDataFrame
    ex, pair = make([("x",)], "name string"), make([("P",)], "symbol string")
    c = make([(1, "x", ["P", "Z"]), (2, "unknown", ["P"])], "id long, origin_exchange string, affected_pairs array<string>")
    origin, hit = graph.cascade_edges(c, ex, pair)
    assert rows(origin) == [(1, "x")] and rows(hit) == [(1, "P")]
    w = make([("a", "BTC", None, "x"), ("b", "BTC", "x", "x")], "tx_id string, asset string, from_exchange string, to_exchange string")
    e = graph.whale_edges(w, make([("BTC",)], "symbol string"), ex)
    assert rows(e["to_exchange"]) == [("b", "x")] and len(rows(e["transferred"])) == 2


def test_routes_are_all_of_the_input(spark):
    e = spark.createDataFrame([(1, "cascade", None), (2, None, "whale_transfer"), (3, None, None), (4, "odd", "cascade")], "id long, event_type string, type string")
    parts = graph.routed(e)
    assert sum(p.count() for p in parts.values()) == 4
    assert {k: [r["id"] for r in v.collect()] for k, v in parts.items()} == {"cascade": [1], "whale_transfer": [2], "price_movement": [], "quality": [3, 4]}


def test_chain_forms_agree(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("b", "t"), ("a", "t")], "src string, dst string")
    e.createOrReplaceTempView("chain_edges")
    got = rows(graph.causal_chain(spark, e, "t", 4).select("start", "hops", F.array_join("path", ">")))
    sql = rows(spark.sql(graph.causal_chain_sql("chain_edges", "t", 4)).select("start", "hops", F.array_join("path", ">")))
    assert got == sql and ("a", 2, "a>b>t") in got


def test_seed(spark):
    s = graph.seed(spark)
    assert {k: v.count() for k, v in s.items()} == {"exchange": 5, "asset": 5, "pair": 3, "pair_asset": 6, "lists": 5}


def test_range_join_is_exclusive_and_hashed(spark):
    a = spark.createDataFrame([(0,), (100,)], "l long")
    b = spark.createDataFrame([(0,), (1,), (99,), (100,), (199,)], "r long")
    j = range_join(a, b, "l", "r", 100, [])
    assert rows(j.select("l", "r")) == [(0, 1), (0, 99), (100, 199)]
    assert "NestedLoop" not in j._jdf.queryExecution().executedPlan().toString()


def test_history_dedups_and_trims(spark):
    m = spark.createDataFrame([("A", i, i // 2, f"m{i % 5}") for i in range(20)], "symbol string, seq long, ts_ms long, member string")
    h = features.history(m, keep=3)
    assert rows(h.select("member", "ts_ms", "rank")) == [("m2", 8, 3), ("m3", 9, 2), ("m4", 9, 1)]
    l = features.latest(m)
    assert l.first()["seq"] == 19 and features.live(l, 3_600_008).count() == 1 and features.live(l, 3_600_009).count() == 0
    assert features.multi_latest(l, ["A", "B"]).filter("member IS NULL").count() == 1


def test_consistency_gets_stuck(spark):
    t = [0, 5, 20, 24, 100, 10]
    d = spark.createDataFrame([(i, "s", x * 1_000_000) for i, x in enumerate(t)], "event_id long, source_id string, source_us long")
    got = [r[0] for r in provenance.consistency(d).orderBy("event_id").select("consistency").collect()]
    assert [round(x, 3) for x in got] == [1.0, 1.0, 0.7, 0.62, 0.0, 1.0]


def test_stats_of_nothing(spark):
    v = spark.createDataFrame([], "event_id long, source_id string, quality double, reject_reason string")
    r = provenance.stats(v).first()
    assert (r["total_received"], r["accept_rate"]) == (0, 0.0)


def test_chain_of_steps(spark):
    d = provenance.attach(spark.createDataFrame([(1, "s", 5)], "event_id long, source_id string, source_us long"))
    d = provenance.add_step(provenance.add_step(d, "scale", 1, by=2), "cast", 2)
    assert [s["transform_type"] for s in d.first()["transform_chain"]] == ["scale", "cast"] and d.first()["transform_chain"][0]["parameters"] == {"by": "2"}
    assert '"by":"2"' in provenance.to_json(d).first()["record"]


def test_escalation_ladder(spark):
    beats = [(i, "s", t, "h") for i, t in enumerate([0, 100, 460, 2000, 2100])]
    got = [tuple(r) for r in heartbeat.escalations(spark.createDataFrame(beats, "event_id long, strategy_id string, ts_ms long, positions_hash string"), 150, 2200).orderBy("event_id").select("missed", "level", "accepted").collect()]

    def checks(last, end):
        return sum(1 for k in range(1, 20) if last + 150 < 150 * k < end)

    assert [m for m, _, _ in got] == [checks(0, 100), checks(100, 460), checks(460, 2000), checks(2000, 2100), checks(2100, 2200)]
    assert got[2][1:] == ("HALTED", True) and got[3][1:] == ("HALTED", False)


def test_sustained_and_rates(spark):
    s = spark.createDataFrame([("k", t * 1000, f) for t, f in enumerate([True, True, False, True, True, True])], "k string, ts long, on boolean")
    assert rows(sustained(s, ["k"], "ts", "on", 2).select("started", "ended")) == [(3000, 5000)]
    c = spark.createDataFrame([("k", 0, 5.0), ("k", 10_000, 8.0), ("k", 20_000, 2.0)], "k string, ts long, v double")
    got = [r["increase"] for r in alerts.rate(c, ["k"], "ts", "v").orderBy("ts").collect()]
    assert got == [0.0, 3.0, 5.0]


def test_rates_over_spans_against_brute_force(spark):
    """Ranges that start in the span before, gaps of several spans, equal times, resets, a null value and a null key; no range is summed sample by sample."""
    import random

    rng = random.Random(3)
    data, n = [], 0
    for k in ("a", "b", None):
        for t in sorted(rng.choice([rng.randrange(0, 900), rng.randrange(3000, 3400)]) for _ in range(60)):
            n += 1
            data.append((k, n, t, None if n % 37 == 0 else float(rng.randrange(0, 50))))
    got = alerts.rate(spark.createDataFrame(data, "k string, n long, ts long, v double"), ["k"], "ts", "v", 100, "n")
    want = {}
    for k in ("a", "b", None):
        of, last = [r for r in data if r[0] == k], None
        incs = []
        for _, _, t, v in of:
            incs.append((t, 0.0 if v is None or last is None else v if v < last else v - last))
            last = v
        for _, i, t, _ in of:
            inside = [(x, inc) for x, inc in incs if t - 100 <= x <= t]
            more, gap = sum(inc for _, inc in inside) - inside[0][1], t - inside[0][0]
            want[i] = (more, round(more * 1000 / gap, 9) if gap else None)
    assert {r["n"]: (r["increase"], r["rate"] if r["rate"] is None else round(r["rate"], 9)) for r in got.collect()} == want
    assert "RangeFrame" not in got._jdf.queryExecution().executedPlan().toString()


def test_two_samples_of_one_time_divide_by_zero(spark):
    """As the SQL does: nothing gained gives NaN, a gain infinity; ``tie`` says which sample is the earlier, days apart too."""
    data = [(1, 0, 5.0), (2, 0, 5.0), (4, 0, 7.0), (3, 0, 6.0), (5, 200_000_000, 9.0), (6, 200_000_000, 4.0)]
    got = alerts.irate(spark.createDataFrame(data, "n long, ts long, v double").selectExpr("'k' AS k", "*"), ["k"], "ts", "v", "n")
    assert [str(r["irate"]) for r in got.orderBy("n").collect()] == ["None", "nan", "inf", "inf", str(2000.0 / 200_000_000), "inf"]


def test_histogram_quantile(spark):
    inf = float("inf")
    b = spark.createDataFrame([("a", 1.0, 10), ("a", 2.0, 20), ("a", inf, 20), ("b", 1.0, 0), ("b", inf, 4)], "k string, le double, n long")
    assert rows(alerts.histogram_quantile(b, ["k"], 0.75)) == [("a", 1.5), ("b", 1.0)]


def test_all_rules(spark):
    assert len(alerts.RULES) == 13
    data = []
    for t in range(0, 20):
        at = t * 60_000
        data += [("store_up", {"i": "a"}, at, 0.0), ("consumergroup_lag", {"g": "x"}, at, 20_000.0), ("node_memory_MemAvailable_bytes", {"i": "a"}, at, 5.0), ("node_memory_MemTotal_bytes", {"i": "a"}, at, 100.0)]
        data += [("node_cpu_seconds_total", {"instance": "a", "mode": "idle"}, at, float(t)), ("checkpoints_failed_total", {}, at, float(t))]
        for fs in ("ext4", "tmpfs"):
            data += [("node_filesystem_avail_bytes", {"fstype": fs}, at, 1.0), ("node_filesystem_size_bytes", {"fstype": fs}, at, 100.0)]
    got = alerts.evaluate_all(spark.createDataFrame(data, "metric string, labels map<string,string>, ts_ms long, value double"))
    assert sorted(r["alert"] for r in got.collect()) == ["DiskSpaceLow", "FailedCheckpoints", "HighCPUUsage", "HighConsumerLag", "HighMemoryUsage", "StoreDown"]


def test_rollup_equals_raw(spark):
    d = spark.range(500).select((F.col("id") * 61_000).alias("ts_ms"), F.col("id").alias("seq"), F.lit("A").alias("symbol"), F.lit("x").alias("exchange"), (100 + F.col("id") % 17).cast("double").alias("price"), F.lit(2.0).alias("volume"))
    day, hour = ohlcv.ohlcv(d, ohlcv.DAY, spread=False), ohlcv.ohlcv(d, ohlcv.HOUR, spread=False)
    cols = ["bucket_ms", "open", "high", "low", "close", "volume", "trade_count", F.round("avg_price", 9)]
    assert rows(day.select(*cols)) == rows(ohlcv.rollup_bars(hour, ohlcv.DAY).select(*cols))


def test_compressed_layout(spark, tmp_path):
    d = spark.createDataFrame([("A", "x", 86_400_000 * i + j, 1.0) for i in range(2) for j in range(3)], "symbol string, exchange string, ts_ms long, price double")
    ohlcv.write_compressed(d, str(tmp_path / "cold"))
    back = spark.read.parquet(str(tmp_path / "cold"))
    assert back.count() == 6 and back.select("date").distinct().count() == 2


def test_msgpack():
    import random
    import struct

    import pytest

    from tickloom.functions import msgpack

    values = [None, True, False, 0, 127, 128, -1, -32, -33, 255, 256, 65_536, 2**32, 2**63, -(2**31) - 1, 1.5, "", "x" * 31, "é" * 40, "y" * 70_000, [], list(range(20)), {}, {"a": [1, {"b": None}], "c": "d"}, {str(i): i for i in range(20)}]
    assert all(msgpack.unpack(msgpack.pack(v)) == v for v in values)
    # Encodings that the format prescribes.
    assert [msgpack.pack(x).hex() for x in (5, -1, 300, "ab", [1], {"a": 1})] == ["05", "ff", "cd012c", "a26162", "9101", "81a16101"]
    assert msgpack.unpack(b"\xca" + struct.pack(">f", 0.5)) == 0.5 and msgpack.unpack(msgpack.pack(b"raw")) == "raw"
    rng = random.Random(3)
    for body in (b"", b"\xc1", b"\x92\x01", b"\x01\x01", b"\xd9\xff", *(bytes(rng.randrange(256) for _ in range(6)) for _ in range(50))):
        try:
            msgpack.unpack(body)
        except (ValueError, TypeError):
            continue
    with pytest.raises(ValueError):
        msgpack.unpack(b"\xc1")


def test_msgpack_messages(spark):
    from tickloom.functions import msgpack
    from tickloom.sources.parse import decode_msgpack, parse_ticks

    good = {"symbol": "A", "price": 1.5, "volume": 2, "exchange": "KRAKEN", "timestamp": 5, "more": [1]}
    df = spark.createDataFrame([(1, bytearray(msgpack.pack(good))), (2, bytearray(b"\xc1")), (3, None)], "seq long, value binary")
    got = {r["seq"]: (r["symbol"], r["price"], r["parse_error"]) for r in parse_ticks(decode_msgpack(df)).collect()}
    assert got == {1: ("A", 1.5, False), 2: (None, None, True), 3: (None, None, True)}


def test_ranks_and_halos(spark):
    """Small blocks give the detectors the same state as one block for all."""
    from tickloom.operators import triangulation as tri
    from tickloom.sources import fixtures as fx

    from .conftest import DATA

    ticks = fx.triangulated(spark, DATA).filter("event_id < 700").cache()
    cols = ["event_id", "n", "last_exchange_us", "bunched", "n_recent", "median_ms", "short_ms", "base_ms"]
    state = lambda n, block: {r[0]: r for r in rows(tri.with_state(ticks, n, block).select(*cols))}
    whole = state(60, 4096)
    assert len(whole) == 700 and state(60, 100) == whole and max(r[1] for r in whole.values()) > 120


def test_substring_index(spark):
    pairs = spark.createDataFrame([("BTC/USDT",), ("ETH/BTC",), ("A",), ("",)], "symbol string")
    low = spark.createDataFrame([(1, "BTC", 0.1), (2, "", 0.2), (3, "A", 0.9), (4, "TH/B", 0.0), (5, None, 0.0), (6, "BTC/USDT/X", 0.0)], "event_id long, symbol string, quality_score double")
    assert rows(graph.low_quality_edges(low, pairs)) == [(1, "BTC/USDT"), (1, "ETH/BTC"), (2, ""), (2, "A"), (2, "BTC/USDT"), (2, "ETH/BTC"), (4, "ETH/BTC")]


def test_days_of_the_cold_layout(spark, tmp_path):
    d = spark.createDataFrame([("A", "x", 86_400_000 * i, 1.0) for i in range(4)], "symbol string, exchange string, ts_ms long, price double")
    ohlcv.write_compressed(d, str(tmp_path / "cold"), as_of_ms=3 * 86_400_000, after_ms=86_400_000)
    assert sorted(r["ts_ms"] for r in spark.read.parquet(str(tmp_path / "cold")).collect()) == [0, 86_400_000]
    from tickloom.sources import tables

    parts = {r["part"]: r["files"] for r in tables.sizes(spark, str(tmp_path / "cold")).collect()}
    assert set(parts) == {"date=1970-01-01", "date=1970-01-02"} and all(parts.values())


def test_record_has_thirteen_fields(spark):
    import json

    d = spark.createDataFrame([(1, "s", 5)], "event_id long, source_id string, source_us long")
    body = json.loads(provenance.to_json(d).first()["record"])
    assert len(body) == 13 and body["quality_score"] == 1.0 and body["validation_errors"] == [] and body["source_timestamp"] == "1970-01-01T00:00:00.000005"


def test_cross_source_is_required(spark):
    from dataclasses import replace

    d = spark.createDataFrame([(1, "s", 0, "A", "price", 5.0, 0), (2, "t", 9_000_000_000, "B", "price", 5.0, 0), (3, "u", 9_000_000_000, "B", "price", 5.0, 0)], "event_id long, source_id string, source_us long, symbol string, data_type string, value double, staleness_ms long")
    got = dict(rows(provenance.validate(d, None, replace(provenance.DEFAULT, cross_required=True)).select("event_id", "reject_reason")))
    assert got == {1: "cross_source_missing", 2: None, 3: None}


def test_status_of_strategies(spark):
    beats = [(i, "s", t, "h") for i, t in enumerate([0, 100])] + [(7, "late", 0, "h")]
    df = spark.createDataFrame(beats, "event_id long, strategy_id string, ts_ms long, positions_hash string")
    got = {r["strategy_id"]: (r["last_ms"], r["missed"], r["level"], r["healthy"]) for r in heartbeat.status(df, 301, 150, spark.createDataFrame([("new",)], "strategy_id string")).collect()}
    assert got["new"] == (None, 0, "NORMAL", True) and got["s"][0] == 100 and got["late"][0] == 0 and not got["late"][3]


def test_positions_hash_ignores_order(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS p UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 2, 'b', 1)")
    got = [r[0] for r in df.select(heartbeat.positions_hash(F.col("p"))).collect()]
    assert got[0] == got[1] != got[2] and len(got[0]) == 16
