"""Time-series analytics and feature-store queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import rounded
from tickloom.operators import alerts, features, ohlcv
from tickloom.operators import quality as q
from tickloom.plans.quality import WITH, scored
from tickloom.sources import fixtures as fx

AS_OF = fx.AS_OF_EVENTS_MS
M, H, D = ohlcv.MINUTE, ohlcv.HOUR, ohlcv.DAY
#: An instant inside the data for refreshes and latest bars.
NOW = AS_OF - 20 * D


def market(spark, d) -> DataFrame:
    return q.market_data(fx.ticks(spark, d))


def _tidy(bars: DataFrame) -> DataFrame:
    real = [c for c in ("volume", "avg_price", "price_stddev", "price_range") if c in bars.columns]
    return bars.withColumns({c: F.round(c, 9 if c == "avg_price" else 4) for c in real})


def _bars(width: int, spread: bool):
    return lambda s, d: _tidy(ohlcv.ohlcv(market(s, d), width, spread=spread))


def _members(s, d) -> DataFrame:
    t = fx.ticks(s, d)
    return t.select("symbol", "seq", "ts_ms", F.concat_ws("|", F.col("ts_ms").cast("string"), "exchange", F.col("volume").cast("int").cast("string")).alias("member"))


def _alert_runs(s, d) -> DataFrame:
    series = alerts.bad_data_rate(scored(s, d), H, 0.3).withColumn("rule", F.lit("bad"))
    return alerts.sustained(series, ["rule"], "ts_ms", "firing", 2 * 3600)


def _no_data(s, d) -> DataFrame:
    t = fx.ticks(s, d)
    series = alerts.no_data(t, AS_OF - 30 * D, AS_OF, 10 * M)
    return alerts.sustained(series, ["symbol"], "ts_ms", "firing", 1800)


def _latency_alert(s, d) -> DataFrame:
    t = fx.ticks(s, d).withColumn("age_s", F.abs(F.col("now_ms") - F.col("ts_ms")) / 1000.0).withColumn("day_ms", ohlcv.bucket("ts_ms", D))
    b = alerts.latency_buckets(t, ["day_ms"], "age_s", (1.0, 5.0, 10.0, 20.0, 30.0))
    h = alerts.histogram_quantile(b, ["day_ms"], 0.9)
    return h.select("day_ms", F.round("quantile", 4).alias("quantile"), (F.col("quantile") > 25).alias("firing"))


def _resource(s, d) -> DataFrame:
    e = fx.table(s, d, "events").select("user_id", fx.ms("ts").alias("ts_ms"), "value")
    by = e.groupBy(F.concat(F.lit("n"), (F.col("user_id") % 5).cast("string")).alias("instance"), ohlcv.bucket("ts_ms", H).alias("ts_ms")).agg(F.round(F.sum("value"), 4).alias("v"))
    lab = F.create_map(F.lit("instance"), "instance")
    long = by.select("ts_ms", lab.alias("labels"), F.explode(F.array(F.struct(F.lit("store_memory_used_bytes").alias("metric"), F.col("v").alias("value")), F.struct(F.lit("store_memory_max_bytes").alias("metric"), F.lit(250.0).alias("value")))).alias("m")).select("m.metric", "labels", "ts_ms", "m.value")
    rule = next(r for r in alerts.RULES if r.name == "StoreMemoryHigh")
    return alerts.evaluate(alerts.Rule(rule.name, rule.series, 3600, rule.severity), long)


def _rate(s, d) -> DataFrame:
    e = fx.table(s, d, "events").select("event_id", "event_type", fx.ms("ts").alias("ts_ms"))
    c = e.withColumn("counter", (F.col("event_id") % 1000).cast("double"))
    r = alerts.rate(c, ["event_type"], "ts_ms", "counter", 6 * H, "event_id")
    return r.select("event_id", F.round("increase", 4).alias("increase"), rounded("rate", 6).alias("rate"))


QUERIES = {
    "ohlcv_5min": _bars(5 * M, True),
    "ohlcv_1hour": _bars(H, False),
    "ohlcv_1day": _bars(D, False),
    "ohlcv_rollup_1day": lambda s, d: _tidy(ohlcv.rollup_bars(ohlcv.ohlcv(market(s, d), H, spread=False), D)),
    "ohlcv_drill_downs": lambda s, d: ohlcv.drill_downs(market(s, d)).withColumn("volume", F.round("volume", 2)),
    "ohlcv_read_range": lambda s, d: _tidy(ohlcv.read_bars(ohlcv.ohlcv(market(s, d), 5 * M), "SYM_CLICK", AS_OF - 25 * D, AS_OF - 20 * D, "kraken")),
    "latest_ohlcv": lambda s, d: _tidy(ohlcv.latest_bars(ohlcv.ohlcv(market(s, d), 5 * M), NOW, 6 * H)),
    "quality_summary": lambda s, d: ohlcv.quality_summary(scored(s, d)).withColumn("avg_quality", F.round("avg_quality", 6)),
    "unique_issues": lambda s, d: ohlcv.unique_issues(market(s, d)).select("symbol", "total", F.round("avg_quality", 6).alias("avg_quality"), F.array_join("unique_issues", ",").alias("unique_issues")),
    "quality_metrics": lambda s, d: ohlcv.quality_metrics(scored(s, d), D).withColumn("avg_quality", F.round("avg_quality", 6)),
    "refresh_window_5min": lambda s, d: _tidy(ohlcv.refresh_window(market(s, d), "ohlcv_5min", NOW)),
    "retention_filter": lambda s, d: ohlcv.retained(market(s, d), AS_OF, 10 * D).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("ts_ms").alias("oldest_ms")),
    "feature_latest": lambda s, d: features.latest(_members(s, d)),
    "feature_history_range": lambda s, d: features.history_range(features.history(_members(s, d)), "SYM_VIEW", AS_OF - 10 * D, AS_OF, 50),
    "feature_history_top1000": lambda s, d: features.history(_members(s, d)).select("symbol", "ts_ms", "member", F.col("rank").cast("long").alias("rank")),
    "feature_multi_latest": lambda s, d: features.multi_latest(features.latest(_members(s, d)), ["SYM_CLICK", "SYM_NONE", "SYM_ERROR"]),
    "feature_ttl_live": lambda s, d: features.live(features.latest(_members(s, d)), AS_OF - 12 * H).select("symbol", "expires_ms"),
    "bad_data_rate_alert": _alert_runs,
    "no_data_flow_alert": _no_data,
    "high_latency_alert": _latency_alert,
    "resource_ratio_alert": _resource,
    "counter_rate": _rate,
}


def _bars_sql(width: int, spread: bool, source: str = "market_data", where: str = "true") -> str:
    extra = ", round(stddev_samp(price), 4) AS price_stddev, round(max(price) - min(price), 4) AS price_range" if spread else ""
    return f"SELECT ts_ms // {width} * {width} AS bucket_ms, symbol, exchange, first(price ORDER BY ts_ms, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts_ms, seq) AS close, round(sum(volume), 4) AS volume, count(*) AS trade_count, round(avg(price), 9) AS avg_price{extra} FROM {source} WHERE {where} GROUP BY ALL"


_MEMBERS = "WITH " + fx.TICKS + ", m AS (SELECT symbol, seq, ts_ms, ts_ms || '|' || exchange || '|' || volume::INTEGER AS member FROM ticks), l AS (SELECT symbol, max(seq) AS seq, arg_max(ts_ms, seq) AS ts_ms, arg_max(member, seq) AS member FROM m GROUP BY symbol)"
_HISTORY = _MEMBERS + ", once AS (SELECT symbol, member, arg_max(ts_ms, seq) AS ts_ms FROM m GROUP BY ALL), h AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_ms DESC, member DESC) AS rank FROM once QUALIFY rank <= 1000)"
_LO = -(-(NOW - 2 * H) // (5 * M)) * 5 * M
_HI = (NOW - M) // (5 * M) * 5 * M

ORACLES = {
    "ohlcv_5min": WITH + _bars_sql(5 * M, True),
    "ohlcv_1hour": WITH + _bars_sql(H, False),
    "ohlcv_1day": WITH + _bars_sql(D, False),
    "ohlcv_rollup_1day": WITH + _bars_sql(D, False),
    "ohlcv_drill_downs": WITH + f"SELECT b AS bucket_ms, symbol, exchange, round(sum(volume), 2) AS volume, count(*) AS trade_count FROM (SELECT ts_ms // {D} * {D} AS b, * FROM market_data) GROUP BY ROLLUP (b, symbol, exchange)",
    "ohlcv_read_range": WITH + f"SELECT * FROM ({_bars_sql(5 * M, True)}) WHERE symbol = 'SYM_CLICK' AND exchange = 'kraken' AND bucket_ms BETWEEN {AS_OF - 25 * D} AND {AS_OF - 20 * D}",
    "latest_ohlcv": WITH + f"SELECT * FROM ({_bars_sql(5 * M, True)}) WHERE bucket_ms > {NOW - 6 * H}",
    "quality_summary": WITH + "SELECT symbol, exchange, count(*) AS total_records, round(avg(quality_score), 6) AS avg_quality, min(quality_score) AS min_quality, count(*) FILTER (quality_score < 0.7) AS low_quality_count FROM scored GROUP BY ALL",
    "unique_issues": WITH + ", u AS (SELECT symbol, array_to_string(list_sort(list(DISTINCT i)), ',') AS unique_issues FROM (SELECT symbol, unnest(issues) AS i FROM market_data) GROUP BY 1) SELECT symbol, count(*) AS total, round(avg(quality_score), 6) AS avg_quality, any_value(unique_issues) AS unique_issues FROM market_data JOIN u USING (symbol) GROUP BY 1",
    "quality_metrics": WITH + f"SELECT ts_ms // {D} * {D} AS bucket_ms, symbol, exchange, count(*) AS total_messages, count(*) FILTER (quality_score >= 0.7) AS valid_messages, round(avg(quality_score), 6) AS avg_quality, min(quality_score) AS min_quality, 0::BIGINT AS parse_errors, count(*) FILTER (i9 = 'STALE_DATA') AS stale_data, count(*) FILTER (i6 IS NOT NULL) AS price_anomalies, count(*) FILTER (i7 IS NOT NULL) AS volume_spikes FROM scored GROUP BY ALL",
    "refresh_window_5min": WITH + _bars_sql(5 * M, True, where=f"ts_ms >= {_LO} AND ts_ms < {_HI}"),
    "retention_filter": WITH + f"SELECT symbol, count(*) AS n, min(ts_ms) AS oldest_ms FROM market_data WHERE ts_ms >= {AS_OF - 10 * D} GROUP BY 1",
    "feature_latest": _MEMBERS + f" SELECT 'features:' || symbol || ':latest' AS key, symbol, seq, ts_ms, member, ts_ms + {features.TTL_MS} AS expires_ms FROM l",
    "feature_history_range": _HISTORY + f" SELECT symbol, ts_ms, member FROM h WHERE symbol = 'SYM_VIEW' AND ts_ms BETWEEN {AS_OF - 10 * D} AND {AS_OF} ORDER BY ts_ms, member LIMIT 50",
    "feature_history_top1000": _HISTORY + " SELECT symbol, ts_ms, member, rank FROM h",
    "feature_multi_latest": _MEMBERS + " SELECT w.symbol, member FROM (SELECT unnest(['SYM_CLICK', 'SYM_NONE', 'SYM_ERROR']) AS symbol) w LEFT JOIN l USING (symbol)",
    "feature_ttl_live": _MEMBERS + f" SELECT symbol, ts_ms + {features.TTL_MS} AS expires_ms FROM l WHERE ts_ms + {features.TTL_MS} > {AS_OF - 12 * H}",
    "bad_data_rate_alert": WITH + f", b AS (SELECT ts_ms // {H} * {H} AS ts_ms, count(*) FILTER (quality_score < 0.7) / count(*) > 0.3 AS firing FROM scored GROUP BY 1), i AS (SELECT *, sum((NOT firing)::INT) OVER (ORDER BY ts_ms) AS g FROM b) SELECT 'bad' AS rule, min(ts_ms) AS started, max(ts_ms) AS ended, count(*) AS samples FROM i WHERE firing GROUP BY g HAVING max(ts_ms) - min(ts_ms) >= {2 * H}",
    "no_data_flow_alert": "WITH " + fx.TICKS + f", spine AS (SELECT symbol, unnest(range({AS_OF - 30 * D}, {AS_OF}, {10 * M})) AS ts_ms FROM (SELECT DISTINCT symbol FROM ticks)), c AS (SELECT symbol, ts_ms // {10 * M} * {10 * M} AS ts_ms, count(*) AS n FROM ticks GROUP BY ALL), i AS (SELECT symbol, ts_ms, n IS NULL AS firing, sum((n IS NOT NULL)::INT) OVER (PARTITION BY symbol ORDER BY ts_ms) AS g FROM spine LEFT JOIN c USING (symbol, ts_ms)) SELECT symbol, min(ts_ms) AS started, max(ts_ms) AS ended, count(*) AS samples FROM i WHERE firing GROUP BY symbol, g HAVING max(ts_ms) - min(ts_ms) >= 1800000",
    "high_latency_alert": "WITH " + fx.TICKS + f", a AS (SELECT ts_ms // {D} * {D} AS day_ms, abs(now_ms - ts_ms) / 1000.0::DOUBLE AS s FROM ticks), edges AS (SELECT unnest([1.0, 5.0, 10.0, 20.0, 30.0, 'inf'::DOUBLE]) AS le), b AS (SELECT day_ms, le, count(*) AS n FROM a JOIN edges ON s <= le GROUP BY ALL), w AS (SELECT *, coalesce(lag(le) OVER x, 0) AS lo, coalesce(lag(n) OVER x, 0) AS below, max(n) OVER (PARTITION BY day_ms) AS total FROM b WINDOW x AS (PARTITION BY day_ms ORDER BY le)), z AS (SELECT day_ms, arg_min(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (total * 0.9::DOUBLE - below) / (n - below) END, le) AS quantile FROM w WHERE n >= total * 0.9::DOUBLE GROUP BY 1) SELECT day_ms, round(quantile, 4) AS quantile, quantile > 25 AS firing FROM z",
    "resource_ratio_alert": f"WITH b AS (SELECT 'n' || (user_id % 5) AS instance, epoch_us(ts) // 1000 // {H} * {H} AS ts_ms, round(sum(value), 4) / 250.0 > 0.85 AS firing FROM events GROUP BY ALL), i AS (SELECT *, sum((NOT firing)::INT) OVER (PARTITION BY instance ORDER BY ts_ms) AS g FROM b) SELECT 'StoreMemoryHigh' AS alert, 'warning' AS severity, '{{\"instance\":\"' || instance || '\"}}' AS labels, min(ts_ms) AS started, max(ts_ms) AS ended, count(*) AS samples FROM i WHERE firing GROUP BY instance, g HAVING max(ts_ms) - min(ts_ms) >= 3600000",
    "counter_rate": f"WITH c AS (SELECT event_id, event_type, epoch_us(ts) // 1000 AS ts_ms, (event_id % 1000)::DOUBLE AS v FROM events), i AS (SELECT *, CASE WHEN v < lag(v) OVER w THEN v ELSE coalesce(v - lag(v) OVER w, 0) END AS inc FROM c WINDOW w AS (PARTITION BY event_type ORDER BY ts_ms)), r AS (SELECT event_id, sum(inc) OVER f - first_value(inc) OVER f AS increase, ts_ms - min(ts_ms) OVER f AS span FROM i WINDOW f AS (PARTITION BY event_type ORDER BY ts_ms RANGE BETWEEN {6 * H} PRECEDING AND CURRENT ROW)) SELECT event_id, round(increase, 4) AS increase, round(CASE WHEN span > 0 THEN increase * 1000 / span END, 6) AS rate FROM r",
}
