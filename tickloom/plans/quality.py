"""Quality queries over the tick view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import decimals
from tickloom.operators import quality as q
from tickloom.sources import fixtures as fx
from tickloom.sources.parse import parse_ticks

#: Scored ticks in SQL: state by window, averages by recursion over arrival ranks, issues in check order.
SCORED = fx.TICKS + """,
r AS (SELECT *, row_number() OVER w AS rn, lag(ts_ms) OVER w AS last_ts, lag(price) OVER w AS last_price FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY seq)),
e AS (SELECT symbol, rn, price AS pe, volume AS ve FROM r WHERE rn = 1
  UNION ALL SELECT r.symbol, r.rn, 0.1 * r.price + 0.9 * e.pe, 0.1 * r.volume + 0.9 * e.ve FROM e JOIN r ON r.symbol = e.symbol AND r.rn = e.rn + 1),
flags AS (SELECT r.*, pe AS price_ema, ve AS volume_ema,
  CASE WHEN price <= 0 THEN 'INVALID_PRICE_NEGATIVE' END AS i1,
  CASE WHEN volume < 0 THEN 'INVALID_VOLUME_NEGATIVE' END AS i2,
  CASE WHEN exchange NOT IN ('binance', 'kraken', 'bybit', 'deribit', 'coinbase') THEN 'UNKNOWN_EXCHANGE' END AS i3,
  CASE WHEN ts_ms < last_ts THEN 'OUT_OF_ORDER' WHEN ts_ms = last_ts THEN 'DUPLICATE_TIMESTAMP' WHEN ts_ms - last_ts > 60000 THEN 'LARGE_GAP' END AS i4,
  CASE WHEN last_price <> 0 AND abs(price - last_price) / last_price > 0.10 THEN 'EXTREME_PRICE_MOVE' WHEN last_price <> 0 AND abs(price - last_price) / last_price > 0.05 THEN 'LARGE_PRICE_MOVE' END AS i5,
  CASE WHEN pe > 0 AND abs(price - pe) / pe > 0.15 THEN 'PRICE_ANOMALY' END AS i6,
  CASE WHEN ve > 0 AND volume / ve > 100 THEN 'EXTREME_VOLUME_SPIKE' WHEN ve > 0 AND volume / ve > 10 THEN 'VOLUME_SPIKE' END AS i7,
  CASE WHEN length(split_part(price::VARCHAR, '.', 2)) > 8 THEN 'EXCESSIVE_PRECISION' END AS i8,
  CASE WHEN now_ms - ts_ms > 30000 THEN 'STALE_DATA' WHEN now_ms - ts_ms > 10000 THEN 'DELAYED_DATA' WHEN now_ms - ts_ms < -5000 THEN 'FUTURE_TIMESTAMP' END AS i9
  FROM r JOIN e USING (symbol, rn)),
pen AS (SELECT unnest(['INVALID_PRICE_NEGATIVE', 'INVALID_VOLUME_NEGATIVE', 'UNKNOWN_EXCHANGE', 'OUT_OF_ORDER', 'DUPLICATE_TIMESTAMP', 'LARGE_GAP', 'EXTREME_PRICE_MOVE', 'LARGE_PRICE_MOVE', 'PRICE_ANOMALY', 'EXTREME_VOLUME_SPIKE', 'VOLUME_SPIKE', 'EXCESSIVE_PRECISION', 'STALE_DATA', 'DELAYED_DATA', 'FUTURE_TIMESTAMP']) AS code,
  unnest([25, 20, 15, 30, 10, 5, 20, 5, 10, 15, 5, 5, 15, 5, 20]) AS p),
lists AS (SELECT *, list_filter([i1, i2, i3, i4, i5, i6, i7, i8, i9], lambda x: x IS NOT NULL) AS issues FROM flags),
cost AS (SELECT event_id, sum(p) AS c FROM (SELECT event_id, unnest(issues) AS code FROM lists) JOIN pen USING (code) GROUP BY 1),
scored AS (SELECT lists.*, len(issues)::INTEGER AS issue_count, greatest(0, 100 - coalesce(c, 0)) / 100.0::DOUBLE AS quality_score FROM lists LEFT JOIN cost USING (event_id)),
market_data AS (SELECT * FROM scored WHERE price > 0 AND volume >= 0 AND quality_score BETWEEN 0 AND 1)
"""
WITH = "WITH RECURSIVE " + SCORED
TICKS = "WITH " + fx.TICKS


def _ticks(spark, d) -> DataFrame:
    return fx.ticks(spark, d)


def _state(spark, d) -> DataFrame:
    return q.with_state(_ticks(spark, d))


def scored(spark, d) -> DataFrame:
    return q.score(_ticks(spark, d))


def _flag(column, name: str = "issue"):
    return column.alias(name)


def _parsed(spark, d) -> DataFrame:
    return parse_ticks(fx.raw_messages(spark, d))


def _parsed_scores(spark, d) -> DataFrame:
    out = q.score_parsed(_parsed(spark, d))
    return out.select("seq", "symbol", "ts_ms", "quality_score", F.array_join("issues", ",").alias("issues"), "issue_count")


def _envelope(spark, d) -> DataFrame:
    body = q.envelope(scored(spark, d))
    back = lambda p: F.get_json_object("value", p)
    return body.select("key", back("$.timestamp").cast("long").alias("ts_ms"), back("$.quality_score").cast("double").alias("quality_score"), back("$.issue_count").cast("int").alias("issue_count"), back("$.processed_at_ms").cast("long").alias("processed_at_ms"), F.round(back("$.original_data.price").cast("double"), 6).alias("price"))


QUERIES = {
    "tick_projection": lambda s, d: _ticks(s, d),
    "schema_checks": lambda s, d: _ticks(s, d).select("event_id", *[c.isNotNull().alias(n) for c, n in zip(q.schema_issues(), ("bad_price", "bad_volume", "bad_exchange"), strict=True)]),
    "exchange_check": lambda s, d: _ticks(s, d).groupBy("exchange").agg(F.count_if(q.schema_issues()[2].isNotNull()).alias("unknown"), F.count(F.lit(1)).alias("total")),
    "temporal_checks": lambda s, d: _state(s, d).select("event_id", _flag(q.temporal_issue())),
    "price_move_checks": lambda s, d: _state(s, d).select("event_id", F.round(q.price_move(), 6).alias("move"), _flag(q.move_issue())),
    "price_ema": lambda s, d: _state(s, d).select("event_id", F.round("price_ema", 6).alias("price_ema")),
    "ema_anomaly": lambda s, d: _state(s, d).select("event_id", _flag(q.anomaly_issue())),
    "volume_ema_ratio": lambda s, d: _state(s, d).select("event_id", F.round("volume_ema", 6).alias("volume_ema"), _flag(q.volume_issue())),
    "precision_check": lambda s, d: _ticks(s, d).select("event_id", decimals("price").cast("int").alias("decimals"), _flag(q.precision_issue())),
    "freshness_check": lambda s, d: _ticks(s, d).select("event_id", _flag(q.freshness_issue())),
    "quality_score": lambda s, d: scored(s, d).select("event_id", "symbol", "quality_score", "issue_count", F.array_join("issues", ",").alias("issues")),
    "issue_histogram": lambda s, d: scored(s, d).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n")),
    "parse_malformed": lambda s, d: _parsed(s, d).select("event_id", "symbol", F.round("price", 6).alias("price"), "volume", "exchange", "ts_ms", "parse_error"),
    "parse_scores": _parsed_scores,
    "quarantine_split": lambda s, d: scored(s, d).groupBy(q.valid_row().alias("valid")).agg(F.count(F.lit(1)).alias("n"), F.min("price").alias("min_price"), F.min("volume").alias("min_volume")),
    "output_envelope": _envelope,
}

_PARSED = fx.TICKS + """,
parsed AS (SELECT event_id, seq, now_ms, event_id % 101 = 0 AS parse_error, CASE WHEN event_id % 101 <> 0 THEN symbol END AS symbol, CASE WHEN event_id % 101 <> 0 THEN price END AS price,
  CASE WHEN event_id % 101 <> 0 THEN volume END AS volume, CASE WHEN event_id % 101 <> 0 THEN exchange END AS exchange, CASE WHEN event_id % 101 <> 0 THEN ts_ms END AS ts_ms FROM ticks)"""

ORACLES = {
    "tick_projection": TICKS + " SELECT * FROM ticks",
    "schema_checks": TICKS + " SELECT event_id, price <= 0 AS bad_price, volume < 0 AS bad_volume, exchange = 'otherex' AS bad_exchange FROM ticks",
    "exchange_check": TICKS + " SELECT exchange, count(*) FILTER (exchange = 'otherex') AS unknown, count(*) AS total FROM ticks GROUP BY 1",
    "temporal_checks": WITH + " SELECT event_id, i4 AS issue FROM flags",
    "price_move_checks": WITH + " SELECT event_id, round(CASE WHEN last_price <> 0 THEN abs(price - last_price) / last_price END, 6) AS move, i5 AS issue FROM flags",
    "price_ema": WITH + " SELECT event_id, round(price_ema, 6) AS price_ema FROM flags",
    "ema_anomaly": WITH + " SELECT event_id, i6 AS issue FROM flags",
    "volume_ema_ratio": WITH + " SELECT event_id, round(volume_ema, 6) AS volume_ema, i7 AS issue FROM flags",
    "precision_check": TICKS + " SELECT event_id, length(rtrim(split_part(price::VARCHAR, '.', 2), '0'))::INTEGER AS decimals, CASE WHEN length(split_part(price::VARCHAR, '.', 2)) > 8 THEN 'EXCESSIVE_PRECISION' END AS issue FROM ticks",
    "freshness_check": WITH + " SELECT event_id, i9 AS issue FROM flags",
    "quality_score": WITH + " SELECT event_id, symbol, quality_score, issue_count, array_to_string(issues, ',') AS issues FROM scored",
    "issue_histogram": WITH + " SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM scored) GROUP BY 1",
    "parse_malformed": "WITH " + _PARSED + " SELECT event_id, symbol, round(price, 6) AS price, volume, exchange, ts_ms, parse_error FROM parsed",
    "parse_scores": "WITH RECURSIVE " + SCORED.replace("FROM ticks WINDOW", "FROM ticks WHERE event_id % 101 <> 0 WINDOW") + " SELECT seq, symbol, ts_ms, quality_score, array_to_string(issues, ',') AS issues, issue_count FROM scored UNION ALL SELECT seq, 'ERROR', 0, 0.0, 'PARSE_ERROR', 1 FROM ticks WHERE event_id % 101 = 0",
    "quarantine_split": WITH + " SELECT price > 0 AND volume >= 0 AS valid, count(*) AS n, min(price) AS min_price, min(volume) AS min_volume FROM scored GROUP BY 1",
    "output_envelope": WITH + " SELECT symbol AS key, ts_ms, quality_score, issue_count, now_ms AS processed_at_ms, round(price, 6) AS price FROM scored",
}
