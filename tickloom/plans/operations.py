"""Sinks, serialized records, service alerts and the smaller operators, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import rounded
from tickloom.operators import alerts, features, graph, ohlcv
from tickloom.operators import heartbeat as hb
from tickloom.operators import provenance as pv
from tickloom.operators import quality as q
from tickloom.operators import triangulation as tri
from tickloom.plans import analytics as an
from tickloom.plans import graph as pg
from tickloom.plans import integrity as it
from tickloom.plans.quality import SCORED, WITH, scored
from tickloom.sources import fixtures as fx
from tickloom.sources import parse, tables
from tickloom.streaming import scorer

M, H, D = ohlcv.MINUTE, ohlcv.HOUR, ohlcv.DAY
AS_OF, NOW = fx.AS_OF_EVENTS_MS, an.NOW
REFRESHES = (NOW, NOW + H, NOW + 2 * H)


def _refresh_chain(s, d) -> DataFrame:
    """A table of bars after three refreshes, each of which keeps what the ones before computed."""
    data, path = tables.stored(an.market(s, d), "market"), tables.new_path(s, "bars")
    for at in REFRESHES:
        scorer.refresh_bars(data, "ohlcv_5min", at, path)
    return an._tidy(s.read.parquet(path).drop("date"))


def _store_rows(s, d) -> DataFrame:
    """The time-series table and its quarantine after two batches, the second of which came twice."""
    path = tables.new_path(s, "store")
    data = tables.stored(scored(s, d), "scored")
    write = scorer.store_writer(path)
    for batch, part in ((0, "seq % 2 = 0"), (1, "seq % 2 = 1"), (1, "seq % 2 = 1")):
        write(data.filter(part), batch)
    side = lambda name: s.read.parquet(f"{path}/{name}").select(F.lit(name).alias("side"), "symbol", "price")
    both = side("market_data").unionByName(side("quarantine"))
    return both.groupBy("side", "symbol").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 3).alias("total"))


def _history_sink(s, d) -> DataFrame:
    """The stored history after three batches in arrival order."""
    rows = tables.stored(an._members(s, d), "members")
    held = features.upsert_history(rows.filter("false"), rows.filter("seq % 3 = 0"))
    for k in (1, 2):
        held = features.upsert_history(tables.stored(held, "history"), rows.filter(f"seq % 3 = {k}"))
    return held.select("symbol", "ts_ms", "member")


def _latest_sink(s, d) -> DataFrame:
    rows = an._members(s, d)
    held = features.latest(rows.filter("seq % 2 = 0"))
    return features.upsert_latest(held, features.latest(rows.filter("seq % 2 = 1"))).select("symbol", "seq", "ts_ms", "member", "expires_ms")


def _dims(s, d) -> tuple[DataFrame, DataFrame]:
    """The known exchanges and pairs: not all that events name."""
    g = fx.graph(s, d)
    return g["exchange"].filter("id < 20"), g["pair"].filter("id % 3 <> 0")


def _counted(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    out = None
    for name, (t, dst) in parts.items():
        one = t.groupBy(F.col(dst).alias("dst")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("edge"), "dst", "n")
        out = one if out is None else out.unionByName(one)
    return out


def _move_edges(s, d) -> DataFrame:
    line = fx.table(s, d, "lineitem").join(fx.table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(fx.table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    moves = line.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"), F.col("n_name").alias("exchange"))
    exchange, pair = _dims(s, d)
    on, at = graph.move_edges(moves, pair, exchange)
    return _counted({"ON_PAIR": (on, "symbol"), "ON_EXCHANGE": (at, "exchange")})


def _cascade_edges(s, d) -> DataFrame:
    g = fx.graph(s, d)
    pairs = g["affected"].groupBy(F.col("cascade_id").alias("id")).agg(F.collect_list("pair").alias("affected_pairs"))
    exchange, pair = _dims(s, d)
    origin, hit = graph.cascade_edges(g["cascade"].join(pairs, "id", "left"), exchange, pair)
    return _counted({"ORIGINATED": (origin, "exchange"), "AFFECTED": (hit, "pair")})


def _seeds(s, d) -> DataFrame:
    g = graph.seed(s)
    return g["lists"].select(F.lit("LISTS").alias("kind"), F.col("exchange").alias("src"), F.col("pair").alias("dst")).unionByName(g["pair_asset"].select("kind", F.col("pair").alias("src"), F.col("asset").alias("dst")))


def _iso(s, d) -> DataFrame:
    o = fx.table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("t"), fx.ms("o_orderdate").alias("ms"))
    kind = F.col("o_orderkey") % 4
    text = F.when(kind == 0, F.concat("t", F.lit("Z"))).when(kind == 1, F.concat("t", F.lit(".250+00:00"))).when(kind == 2, F.concat("t", F.lit("-05:00"))).otherwise(F.col("ms").cast("string"))
    return o.select("o_orderkey", parse.epoch_ms(text).alias("ts_ms"))


def _local_time(s, d) -> DataFrame:
    return fx.ticks(s, d).select("event_id", F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd HH:mm:ss").alias("at"))


def _record(s, d) -> DataFrame:
    r = pv.attach(fx.provenance(s, d).withColumn("receive_us", F.col("source_us") + F.col("staleness_ms") * 1000))
    out = pv.to_json(pv.add_step(r, "scale", 5, by=2))
    get = lambda p: F.get_json_object("record", p)
    return out.select("event_id", F.size(F.json_object_keys("record")).alias("n_fields"), get("$.source_id").alias("source_id"), get("$.source_timestamp").alias("source_timestamp"), get("$.receive_timestamp").alias("receive_timestamp"), get("$.transform_chain[0].parameters.by").alias("step_by"), get("$.is_validated").alias("is_validated"), get("$.staleness_ms").cast("long").alias("staleness_ms"))


def _tri_record(s, d) -> DataFrame:
    get = lambda p: F.get_json_object("record", p)
    return tri.to_json(fx.triangulated(s, d)).select("event_id", get("$.t_exchange").alias("t_exchange"), get("$.t_process").alias("t_process"), get("$.symbol").alias("symbol"), get("$.total_latency_ms").cast("double").alias("total_latency_ms"))


def _chain(s, d) -> DataFrame:
    r = pv.attach(fx.provenance(s, d), "derived").select("event_id", "source_type", "transform_chain", "is_validated")
    r = pv.add_step(pv.add_step(r, "scale", 1, by=2), "cast", 2)
    return r.select("event_id", "source_type", F.array_join("transform_chain.transform_type", ">").alias("steps"), F.element_at(F.col("transform_chain.timestamp_ms"), -1).alias("last_ms"), "is_validated")


def _alert(name: str):
    rule = next(r for r in alerts.RULES if r.name == name)
    return lambda s, d: alerts.evaluate(rule, fx.service_samples(s, d))


def _idle(s, d) -> DataFrame:
    series = alerts._cpu(fx.service_samples(s, d))
    return series.select(F.col("labels")["instance"].alias("instance"), "ts_ms", F.round("value", 6).alias("busy"), "firing")


def _irate(s, d) -> DataFrame:
    e = fx.table(s, d, "events").select("event_id", "event_type", fx.ms("ts").alias("ts_ms")).withColumn("counter", (F.col("event_id") % 1000).cast("double"))
    return alerts.irate(e, ["event_type"], "ts_ms", "counter", "event_id").select("event_id", rounded("irate", 6).alias("irate"))


def _tumbling(s, d) -> DataFrame:
    bars = scorer.bars_stream(scored(s, d))
    return bars.select(F.unix_millis("window.start").alias("bucket_ms"), "symbol", "exchange", "open", "high", "low", "close", F.round("volume", 4).alias("volume"), "trade_count")


def _cold(s, d) -> DataFrame:
    path = tables.new_path(s, "cold")
    ohlcv.write_compressed(an.market(s, d), path, AS_OF, 15 * D)
    back = s.read.parquet(path)
    return back.groupBy(F.col("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("volume"), 2).alias("volume"))


def _bursts(s, d) -> DataFrame:
    state = q.with_state(fx.bursts(s, d))
    return state.select("event_id", F.round("volume_ema", 6).alias("volume_ema"), q.volume_issue().alias("issue"))


def _passthrough(s, d) -> DataFrame:
    """Envelopes that carry each payload as it came: fields that no check reads stay, and a failed payload is an empty object."""
    raw = fx.raw_messages(s, d)
    parsed = parse.parse_ticks(raw)
    judged = q.score_parsed(parsed).drop("symbol", "ts_ms")
    rows = judged.join(parsed.drop("parse_error"), "seq").withColumns({"symbol": F.coalesce("symbol", F.lit("ERROR")), "ts_ms": F.coalesce("ts_ms", F.lit(0).cast("long"))})
    get = lambda p: F.get_json_object("value", p)
    return q.envelope(rows, payload="value").select("key", get("$.timestamp").cast("long").alias("ts_ms"), get("$.issue_count").cast("int").alias("issue_count"), get("$.original_data.venue_note").alias("venue_note"), get("$.original_data.timestamp").cast("long").alias("sent_ms"), F.size(F.json_object_keys(get("$.original_data"))).alias("n_fields"))


def _msgpack(s, d) -> DataFrame:
    good = fx.raw_messages(s, d).filter("event_id % 101 <> 0")
    back = parse.parse_ticks(parse.decode_msgpack(parse.encode_msgpack(good)))
    return back.select("event_id", "symbol", F.round("price", 6).alias("price"), "volume", "exchange", "ts_ms", "parse_error")


def _status(s, d) -> DataFrame:
    known = s.createDataFrame([("S1",), ("S_new",)], "strategy_id string")
    return hb.status(fx.heartbeats(s, d), AS_OF - 2 * D, it.BEAT_TIMEOUT, known)


def _positions(s, d) -> DataFrame:
    e = fx.table(s, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    held = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("positions"))
    return held.select("user_id", hb.positions_hash(F.col("positions")).alias("positions_hash"))


QUERIES = {
    "refresh_chain_5min": _refresh_chain,
    "store_rows": _store_rows,
    "store_defaults": lambda s, d: _gaps(s, d),
    "history_upsert": _history_sink,
    "latest_upsert": _latest_sink,
    "move_edges": _move_edges,
    "cascade_edges": _cascade_edges,
    "seed_edges": _seeds,
    "iso_to_ms": _iso,
    "ms_to_time": _local_time,
    "provenance_record": _record,
    "provenance_chain": _chain,
    "provenance_staleness": lambda s, d: fx.provenance(s, d).select("event_id", pv.staleness(F.lit(AS_OF * 1000)).alias("staleness_ms")),
    "tri_record": _tri_record,
    "whale_then_drop_top20": lambda s, d: graph.whale_then_drop(fx.graph(s, d), "P7", 20 * D, limit=20).select("tx_id", "amount", "transfer_ms", "price_ms", "exchange", F.round("price_change_pct", 4).alias("price_change_pct")),
    "cpu_by_instance": _idle,
    "counter_irate": _irate,
    "alert_high_memory": _alert("HighMemoryUsage"),
    "alert_high_cpu": _alert("HighCPUUsage"),
    "alert_disk_space": _alert("DiskSpaceLow"),
    "alert_job_failed": _alert("StreamJobFailed"),
    "alert_slow_checkpoints": _alert("SlowCheckpoints"),
    "alert_failed_checkpoints": _alert("FailedCheckpoints"),
    "alert_store_down": _alert("StoreDown"),
    "alert_consumer_lag": _alert("HighConsumerLag"),
    "alert_broker_down": _alert("BrokerDown"),
    "tumbling_bars_5min": _tumbling,
    "cold_snapshot": _cold,
    "volume_spikes": _bursts,
    "envelope_passthrough": _passthrough,
    "msgpack_round_trip": _msgpack,
    "heartbeat_status": _status,
    "positions_hash": _positions,
}


def _gaps(s, d) -> DataFrame:
    """Messages with absent fields, and the row that the time-series writer makes of them."""
    t = scored(s, d)
    hole = lambda c, n: F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)
    rows = q.with_defaults(t.select("event_id", hole("exchange", 3), hole("price", 5), hole("volume", 7), hole("quality_score", 4), hole("issues", 6)))
    return rows.withColumn("issues", F.array_join("issues", ","))


def _runs(name: str, series: str) -> str:
    rule = next(r for r in alerts.RULES if r.name == name)
    return f"""WITH {fx.CELLS}, s AS ({series}), i AS (SELECT *, sum((NOT firing)::INT) OVER (PARTITION BY labels ORDER BY ts_ms) AS g FROM s)
SELECT '{rule.name}' AS alert, '{rule.severity}' AS severity, labels, min(ts_ms) AS started, max(ts_ms) AS ended, count(*) AS samples FROM i WHERE firing GROUP BY labels, g HAVING max(ts_ms) - min(ts_ms) >= {rule.for_s * 1000}"""


def _simple(name: str, firing: str) -> str:
    return _runs(name, f"SELECT '{{\"instance\":\"' || instance || '\"}}' AS labels, ts_ms, {firing} AS firing FROM sampled")


_IDLE = "SELECT instance, ts_ms, 100 - ((1.0::DOUBLE * step * 1000 / gap) + (0.75::DOUBLE * step * 1000 / gap)) / 2 * 100 AS busy FROM (SELECT instance, ts_ms, total - lag(total) OVER w AS step, ts_ms - lag(ts_ms) OVER w AS gap FROM sampled WINDOW w AS (PARTITION BY k ORDER BY h))"
_INCREASE = "SELECT '{\"instance\":\"' || instance || '\"}' AS labels, ts_ms, sum(inc) OVER f - first_value(inc) OVER f > 0 AS firing FROM (SELECT *, coalesce(failed - lag(failed) OVER (PARTITION BY k ORDER BY h), 0) AS inc FROM sampled) WINDOW f AS (PARTITION BY k ORDER BY ts_ms RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW)"
_LO = ohlcv.refresh_bounds("ohlcv_5min", REFRESHES[0])[0]
_HI = ohlcv.refresh_bounds("ohlcv_5min", REFRESHES[-1])[1]
_G = "WITH " + fx.GRAPH
_PROV = "WITH " + fx.PROVENANCE
_ISO = "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S.%f')"

ORACLES = {
    "refresh_chain_5min": WITH + an._bars_sql(5 * M, True, where=f"ts_ms >= {_LO} AND ts_ms < {_HI}"),
    "store_rows": WITH + " SELECT CASE WHEN price > 0 AND volume >= 0 THEN 'market_data' ELSE 'quarantine' END AS side, symbol, count(*) AS n, round(sum(price), 3) AS total FROM scored GROUP BY ALL",
    "store_defaults": WITH + " SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN exchange ELSE 'unknown' END AS exchange, CASE WHEN event_id % 5 <> 0 THEN price ELSE 0 END AS price, CASE WHEN event_id % 7 <> 0 THEN volume ELSE 0 END AS volume, CASE WHEN event_id % 4 <> 0 THEN quality_score ELSE 1 END AS quality_score, CASE WHEN event_id % 6 <> 0 THEN array_to_string(issues, ',') ELSE '' END AS issues FROM scored",
    "history_upsert": an._HISTORY + " SELECT symbol, ts_ms, member FROM h",
    "latest_upsert": an._MEMBERS + f" SELECT symbol, seq, ts_ms, member, ts_ms + {features.TTL_MS} AS expires_ms FROM l",
    "move_edges": _G + ", m AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'P' || l_partkey AS symbol, sn, n_nationkey FROM lineitem JOIN g_supplier ON l_suppkey = s_suppkey JOIN nation ON n_name = sn WHERE l_partkey % 3 <> 0 AND l_partkey IN (SELECT p_partkey FROM part)) SELECT 'ON_PAIR' AS edge, symbol AS dst, count(*) AS n FROM m GROUP BY ALL UNION ALL SELECT 'ON_EXCHANGE', sn, count(*) FROM m WHERE n_nationkey < 20 GROUP BY ALL",
    "cascade_edges": _G + ", c AS (SELECT g_cascade.* FROM g_cascade JOIN nation ON n_name = origin_exchange WHERE n_nationkey < 20) SELECT 'ORIGINATED' AS edge, origin_exchange AS dst, count(*) AS n FROM c GROUP BY ALL UNION ALL SELECT 'AFFECTED', pair, count(*) FROM c JOIN g_affected ON cascade_id = id JOIN part ON pair = 'P' || p_partkey WHERE p_partkey % 3 <> 0 GROUP BY ALL",
    "seed_edges": "SELECT * FROM (VALUES ('LISTS', 'binance', 'BTC/USDT'), ('LISTS', 'binance', 'ETH/USDT'), ('LISTS', 'binance', 'SOL/USDT'), ('LISTS', 'kraken', 'BTC/USDT'), ('LISTS', 'kraken', 'ETH/USDT'), ('BASE_ASSET', 'BTC/USDT', 'BTC'), ('BASE_ASSET', 'ETH/USDT', 'ETH'), ('BASE_ASSET', 'SOL/USDT', 'SOL'), ('QUOTE_ASSET', 'BTC/USDT', 'USDT'), ('QUOTE_ASSET', 'ETH/USDT', 'USDT'), ('QUOTE_ASSET', 'SOL/USDT', 'USDT')) t(kind, src, dst)",
    "iso_to_ms": "SELECT o_orderkey, epoch_ms(o_orderdate) + CASE o_orderkey % 4 WHEN 1 THEN 250 WHEN 2 THEN 18000000 ELSE 0 END AS ts_ms FROM orders",
    "ms_to_time": "WITH " + fx.TICKS + " SELECT event_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS at FROM ticks",
    "provenance_record": _PROV + f" SELECT event_id, 13 AS n_fields, source_id, {_ISO.format('source_us')} AS source_timestamp, {_ISO.format('source_us + staleness_ms * 1000')} AS receive_timestamp, '2' AS step_by, 'false' AS is_validated, staleness_ms FROM prov",
    "provenance_chain": _PROV + " SELECT event_id, 'derived' AS source_type, 'scale>cast' AS steps, 2 AS last_ms, false AS is_validated FROM prov",
    "provenance_staleness": _PROV + f" SELECT event_id, ({AS_OF} * 1000 - source_us) / 1000.0::DOUBLE AS staleness_ms FROM prov",
    "tri_record": "WITH " + fx.TRI + f" SELECT event_id, {_ISO.format('exchange_us')} AS t_exchange, {_ISO.format('process_us')} AS t_process, symbol, (process_us - exchange_us) / 1000.0::DOUBLE AS total_latency_ms FROM tri",
    "whale_then_drop_top20": _G + f" SELECT tx_id, amount, w.ts_ms AS transfer_ms, p.ts_ms AS price_ms, exchange, round(price_change_pct, 4) AS price_change_pct FROM g_whale w JOIN g_price_move p ON p.symbol = 'P7' AND price_change_pct < -0.02 AND p.ts_ms > w.ts_ms AND p.ts_ms < w.ts_ms + {20 * D} WHERE amount > 100 AND to_exchange IS NOT NULL ORDER BY amount DESC, tx_id, price_ms, exchange, p.price_change_pct LIMIT 20",
    "cpu_by_instance": f"WITH {fx.CELLS} SELECT instance, ts_ms, round(busy, 6) AS busy, coalesce(busy > 90, false) AS firing FROM ({_IDLE})",
    "counter_irate": "SELECT event_id, round(CASE WHEN v < p THEN v ELSE v - p END * 1000 / (ts_ms - t), 6) AS irate FROM (SELECT event_id, ts_ms, v, lag(v) OVER w AS p, lag(ts_ms) OVER w AS t FROM (SELECT event_id, event_type, epoch_us(ts) // 1000 AS ts_ms, (event_id % 1000)::DOUBLE AS v FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY ts_ms))",
    "alert_high_memory": _simple("HighMemoryUsage", "1 - v / 2500 > 0.9"),
    "alert_high_cpu": _runs("HighCPUUsage", f"SELECT '{{\"instance\":\"' || instance || '\"}}' AS labels, ts_ms, coalesce(busy > 90, false) AS firing FROM ({_IDLE})"),
    "alert_disk_space": _runs("DiskSpaceLow", "SELECT '{\"fstype\":\"' || fstype || '\",\"instance\":\"' || instance || '\"}' AS labels, ts_ms, v / 2000 < 0.1 AS firing FROM sampled WHERE fstype NOT IN ('tmpfs', 'overlay')"),
    "alert_job_failed": _simple("StreamJobFailed", "h // 6 % 5 = k"),
    "alert_slow_checkpoints": _simple("SlowCheckpoints", "h // 8 % 3 = 0"),
    "alert_failed_checkpoints": _runs("FailedCheckpoints", _INCREASE),
    "alert_store_down": _simple("StoreDown", "h // 4 % 6 = k"),
    "alert_consumer_lag": _simple("HighConsumerLag", "h // 15 % 3 = 2"),
    "alert_broker_down": _simple("BrokerDown", "h // 5 % 7 = k"),
    "tumbling_bars_5min": WITH + f" SELECT ts_ms // {5 * M} * {5 * M} AS bucket_ms, symbol, exchange, first(price ORDER BY ts_ms, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts_ms, seq) AS close, round(sum(volume), 4) AS volume, count(*) AS trade_count FROM market_data GROUP BY ALL",
    "cold_snapshot": WITH + f" SELECT strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d') AS day, count(*) AS n, round(sum(volume), 2) AS volume FROM market_data WHERE ts_ms // {D} * {D} + {D} <= {AS_OF - 15 * D} GROUP BY 1",
    "volume_spikes": "WITH RECURSIVE " + SCORED.replace(fx.TICKS, fx.BURSTS) + " SELECT event_id, round(volume_ema, 6) AS volume_ema, i7 AS issue FROM flags",
    "envelope_passthrough": "WITH RECURSIVE " + SCORED.replace("FROM ticks WINDOW", "FROM ticks WHERE event_id % 101 <> 0 WINDOW") + " SELECT symbol AS key, ts_ms, issue_count, 'n' || event_id AS venue_note, ts_ms AS sent_ms, 6 AS n_fields FROM scored UNION ALL SELECT 'ERROR', 0, 1, NULL, NULL, 0 FROM ticks WHERE event_id % 101 = 0",
    "msgpack_round_trip": "WITH " + fx.TICKS + " SELECT event_id, symbol, round(price, 6) AS price, volume, exchange, ts_ms, false AS parse_error FROM ticks WHERE event_id % 101 <> 0",
    "heartbeat_status": "WITH " + fx.HEARTBEATS.replace("FROM events)", f"FROM events WHERE epoch_us(ts) // 1000 <= {AS_OF - 2 * D})") + f""", g AS (SELECT *, coalesce(lead(ts_ms) OVER w, {AS_OF - 2 * D}) AS next_ms FROM heartbeats WINDOW w AS (PARTITION BY strategy_id ORDER BY ts_ms, event_id)),
m AS (SELECT *, greatest(0, (next_ms - 1) // {it.BEAT_TIMEOUT} - (ts_ms + {it.BEAT_TIMEOUT}) // {it.BEAT_TIMEOUT}) AS missed FROM g),
h AS (SELECT *, coalesce(max((missed >= 5)::INT) OVER (PARTITION BY strategy_id ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS halted FROM m),
z AS (SELECT strategy_id, max(ts_ms) FILTER (halted = 0) AS last_ms, max(missed) >= 5 AS is_halted, arg_max(missed, (ts_ms, event_id)) AS now FROM h GROUP BY 1 UNION ALL SELECT 'S_new', NULL, false, 0),
l AS (SELECT *, CASE WHEN is_halted THEN 'HALTED' WHEN now >= 3 THEN 'CANCEL_ALL' WHEN now >= 2 THEN 'ALERT' WHEN now >= 1 THEN 'WARNING' ELSE 'NORMAL' END AS level FROM z)
SELECT strategy_id, last_ms, CASE WHEN is_halted THEN 5 ELSE now END AS missed, level, is_halted, CASE WHEN is_halted THEN '5 missed heartbeats' END AS halt_reason, NOT is_halted AND level = 'NORMAL' AS healthy FROM l""",
    "positions_hash": "SELECT user_id, substr(sha256('[' || string_agg('{\"key\":\"' || event_type || '\",\"value\":' || n || '}', ',' ORDER BY event_type) || ']'), 1, 16) AS positions_hash FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1",
}
