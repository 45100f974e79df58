"""Golden cases of the checks, parser cases, and random ticks against the plain scorer."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.config import PENALTIES, QualityConfig, load_config
from tickloom.functions.columns import decimals, ranked, running
from tickloom.operators import quality as q
from tickloom.sources.parse import parse_ticks

from . import oracle

SCHEMA = "seq long, symbol string, exchange string, price double, volume double, ts_ms long, now_ms long"


def tick(seq, price=100.0, volume=1.0, ts=1000, symbol="A", exchange="binance", age=0):
    return (seq, symbol, exchange, price, volume, ts, ts + age)


def issues(spark, rows, cfg=q.DEFAULT):
    got = q.score(spark.createDataFrame(rows, SCHEMA), cfg).select("seq", "issues", "quality_score").collect()
    return {r["seq"]: (r["issues"], r["quality_score"]) for r in got}


@pytest.mark.parametrize(
    ("rows", "last", "score"),
    [
        ([tick(1, price=-1000.0)], ["INVALID_PRICE_NEGATIVE"], 0.75),
        ([tick(1, price=0.0)], ["INVALID_PRICE_NEGATIVE"], 0.75),
        ([tick(1, volume=-50.0)], ["INVALID_VOLUME_NEGATIVE"], 0.8),
        ([tick(1, exchange="nowhere")], ["UNKNOWN_EXCHANGE"], 0.85),
        ([tick(1, ts=5000), tick(2, ts=4000)], ["OUT_OF_ORDER"], 0.7),
        ([tick(1, ts=5000), tick(2, ts=5000)], ["DUPLICATE_TIMESTAMP"], 0.9),
        ([tick(1, ts=5000), tick(2, ts=65001)], ["LARGE_GAP"], 0.95),
        ([tick(1, ts=5000), tick(2, ts=65000)], [], 1.0),
        ([tick(1, price=45000.0, ts=1), tick(2, price=50000.0, ts=2)], ["EXTREME_PRICE_MOVE"], 0.8),
        ([tick(1, price=45000.0, ts=1), tick(2, price=47500.0, ts=2)], ["LARGE_PRICE_MOVE"], 0.95),
        ([tick(1, price=100.0, ts=1), tick(2, price=120.0, ts=2)], ["EXTREME_PRICE_MOVE", "PRICE_ANOMALY"], 0.7),
        ([tick(1, volume=-1.0, ts=1), tick(2, volume=9.1, ts=2)], ["EXTREME_VOLUME_SPIKE"], 0.85),
        ([tick(1, price=1.123456789)], ["EXCESSIVE_PRECISION"], 0.95),
        ([tick(1, age=30001)], ["STALE_DATA"], 0.85),
        ([tick(1, age=10001)], ["DELAYED_DATA"], 0.95),
        ([tick(1, age=-5001)], ["FUTURE_TIMESTAMP"], 0.8),
        ([tick(1, price=0.0, ts=1), tick(2, price=5.0, ts=2)], ["PRICE_ANOMALY"], 0.9),
        ([tick(1, price=float("nan"), volume=float("nan"))], [], 1.0),
        ([tick(1, price=1e15)], [], 1.0),
        ([tick(1, price=1e-12)], [], 1.0),
    ],
)
def test_golden(spark, rows, last, score):
    assert issues(spark, rows)[rows[-1][0]] == (last, score)


def test_arrival_order_counts_not_time(spark):
    rows = [tick(1, ts=10_000), tick(2, ts=9_000), tick(3, ts=7_000), tick(4, ts=8_000), tick(5, ts=10_000)]
    got = issues(spark, rows)
    assert [("OUT_OF_ORDER" in got[k][0]) for k in range(1, 6)] == [False, True, True, False, False]


def test_nan_poisons_the_average(spark):
    rows = [tick(1, ts=1), tick(2, price=float("nan"), ts=2), tick(3, ts=3), tick(4, price=1000.0, ts=4)]
    assert issues(spark, rows)[4][0] == ["EXTREME_PRICE_MOVE"]


def test_prior_average_flag(spark):
    rows = [tick(1, volume=1.0, ts=1), tick(2, volume=50.0, ts=2)]
    assert issues(spark, rows)[2][0] == []
    assert issues(spark, rows, QualityConfig(compare_to_prior_ema=True))[2][0] == ["VOLUME_SPIKE"]


def test_score_never_leaves_its_bounds(spark):
    rows = [tick(1, ts=10_000_000), tick(2, price=-5.123456789, volume=-1.0, exchange="x", ts=1, age=99_999)]
    assert issues(spark, rows)[2][1] == 0.0


def test_ema_spans_blocks(spark):
    n = 2000
    d = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") * 50).alias("seq"), (100 + F.sin("id") * 7).alias("x"))
    out = running(ranked(d, "k", "seq", span=1000), "k", "rn", {"x": "was"}, {"x": "e"}, block=64).collect()
    got = {r["rn"]: r["e"] for r in out}
    prior = {r["rn"]: r["e_before"] for r in out}
    was = {r["rn"]: r["was"] for r in out}
    import math

    assert set(out[0].asDict()) == {"k", "seq", "x", "rn", "was", "e", "e_before"}
    assert prior[1] is None and all(abs(prior[k] - got[k - 1]) < 1e-9 for k in range(2, n + 1))
    assert was[1] is None and all(abs(was[k] - (100 + math.sin(k - 2) * 7)) < 1e-9 for k in range(2, n + 1))

    e = None
    for i in range(n):
        x = 100 + math.sin(i) * 7
        e = x if e is None else 0.1 * x + 0.9 * e
        assert abs(got[i + 1] - e) < 1e-9


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", ""]),
            st.sampled_from(["binance", "kraken", "other"]),
            st.one_of(st.floats(-5, 200).map(lambda x: round(x, 3)), st.floats(0.01, 1000)),
            st.floats(-10, 1e6).map(lambda x: round(x, 1)),
            st.integers(0, 300_000),
            st.integers(-10_000, 40_000),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_random_ticks(spark, rows):
    ticks = [(i + 1, s, e, p, v, ts, ts + a) for i, (s, e, p, v, ts, a) in enumerate(rows)]
    want = oracle.score([dict(zip(("seq", "symbol", "exchange", "price", "volume", "ts_ms", "now_ms"), t, strict=True)) for t in ticks])
    got = issues(spark, ticks)
    assert {k: (i, s) for k, (i, s) in got.items()} == {k: (i, s) for k, (s, i) in want.items()}


@pytest.mark.parametrize("value", ["symbol=SYM;price=1", "{{]", '{"symbol" "SYM"}', '{"price": 1.5, "vol', "  ", "42", '["SYM", 1.5]', "true", None, '[{"price":1}]', '{"symbol":"A","price":1,"volume":1,"exchange":null,"timestamp":5}', '{"symbol":"A","price":1,"volume":1,"exchange":"kraken"}', '{"symbol":"A","price":"x","volume":1,"exchange":"kraken","timestamp":5}'])
def test_bad_payloads(spark, value):
    row = parse_ticks(spark.createDataFrame([(value,)], "value string")).first()
    assert row["parse_error"] and row["symbol"] is None


@pytest.mark.parametrize(
    ("stamp", "ms"),
    [("1705312800000", 1705312800000), ('"2024-01-15T10:00:00Z"', 1705312800000), ('"2024-01-15T10:00:00+00:00"', 1705312800000), ('"2024-01-15T05:00:00-05:00"', 1705312800000), ('"2024-01-15T10:00:00.123456Z"', 1705312800123), ("-1000000", -1000000), ("0", 0), ("32503680000000", 32503680000000)],
)
def test_timestamps(spark, stamp, ms):
    value = f'{{"symbol":"","price":"1.5","volume":9223372036854775807,"exchange":"KrakeN","timestamp":{stamp}}}'
    row = parse_ticks(spark.createDataFrame([(value,)], "value string")).first()
    assert (row["ts_ms"], row["exchange"], row["price"], row["symbol"], row["parse_error"]) == (ms, "kraken", 1.5, "", False)


def test_parse_errors_touch_no_state(spark):
    rows = [(1, 0, '{"symbol":"A","price":100,"volume":1,"exchange":"kraken","timestamp":1}'), (2, 0, "[]"), (3, 0, '{"symbol":"A","price":101,"volume":1,"exchange":"kraken","timestamp":2}')]
    got = q.score_parsed(parse_ticks(spark.createDataFrame(rows, "seq long, now_ms long, value string"))).orderBy("seq").collect()
    assert [(r["symbol"], r["issues"], r["quality_score"]) for r in got] == [("A", [], 1.0), ("ERROR", ["PARSE_ERROR"], 0.0), ("A", [], 1.0)]


def test_decimals(spark):
    d = spark.createDataFrame([(12345678.125,), (0.1,), (1.23456789e-05,), (1e-12,), (5e-05,), (float("nan"),), (1e17,)], "x double")
    assert [r[0] for r in d.select(decimals("x")).collect()] == [3, 1, 12, 0, 0, 0, 0]


def test_quarantine_is_a_split(spark):
    rows = [tick(1), tick(2, price=0.0), tick(3, volume=-1.0), tick(4, price=float("nan")), tick(5, volume=float("nan"))]
    s = q.score(spark.createDataFrame(rows, SCHEMA))
    ok, bad = q.quarantine(s)
    assert (ok.count(), bad.count()) == (1, 4)


def test_config_overlay(tmp_path):
    p = tmp_path / "c.yml"
    p.write_text("exchanges:\n  valid_exchanges: [x]\n  latency_thresholds: {binance: 7}\nquality:\n  large_gap_threshold_ms: 5\n  unknown: 1\nother: {}\n")
    c = load_config(str(p))
    assert c.valid_exchanges == ("x",) and c.gap_ms == 5 and c.latency_limits["binance"] == 7 and c.latency_limits["kraken"] == 200
    assert c.penalty("LARGE_GAP") == 0.05 and c.penalty("?") == 0.0 and len(PENALTIES) == 15 and c.is_valid_exchange("X")


def test_envelope_and_defaults(spark):
    import json

    s = q.score(spark.createDataFrame([tick(1, symbol="日本/€")], SCHEMA))
    body = json.loads(q.envelope(s).first()["value"])
    assert body["symbol"] == "日本/€" and body["quality_score"] == 1.0 and body["issues"] == [] and body["original_data"]["exchange"] == "binance"
    d = q.with_defaults(spark.createDataFrame([(None, None, None, None, None)], "exchange string, price double, volume double, quality_score double, issues array<string>")).first()
    assert tuple(d) == ("unknown", 0.0, 0.0, 1.0, [])
