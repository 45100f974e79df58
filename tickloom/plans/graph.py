"""Causal-graph queries over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import graph as g
from tickloom.plans.quality import WITH, scored
from tickloom.sources import fixtures as fx

AS_OF, NOW = fx.AS_OF_GRAPH_MS, fx.AS_OF_EVENTS_MS
DAY = g.DAY


def _graph(s, d) -> dict[str, DataFrame]:
    return fx.graph(s, d)


def _recent(s, d) -> DataFrame:
    out = g.recent_cascades(_graph(s, d), AS_OF, 30 * DAY)
    return out.select("id", "ts_ms", "severity", F.round("spread_velocity", 4).alias("spread_velocity"), "max_drawdown", F.array_join("affected_pairs", ",").alias("affected_pairs"))


def _paths(s, d) -> DataFrame:
    return g.cascade_paths(_graph(s, d), "NATION_11", "NATION_10").withColumn("path", F.array_join("path", ">"))


def _routing(s, d) -> DataFrame:
    e = fx.table(s, d, "events")
    kind = F.when(F.col("event_type") == "click", "cascade").when(F.col("event_type") == "view", "whale_transfer").when(F.col("event_type") == "error", "oddity")
    other = F.when(F.col("event_id") % 2 == 0, "price_movement")
    return g.route(e.select("event_id", kind.alias("event_type"), other.alias("type"))).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


def _edges(s, d) -> DataFrame:
    t = fx.table(s, d, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
    return g.upsert_edges(t.filter("src % 2 = 0"), t).groupBy("src").agg(F.count(F.lit(1)).alias("n_edges"))


def _nodes(s, d) -> DataFrame:
    e = fx.table(s, d, "events").select("user_id", "event_type", "value", F.col("event_id").alias("seq"))
    return g.upsert_nodes(e.filter("seq % 3 = 0"), e.filter("seq % 3 <> 0"), "user_id", "seq").select("user_id", "event_type", "value", "seq")


#: Orders fold to so many nodes: few enough that chains form, and so many that paths of five hops stay countable.
CHAIN_NODES = 9973


def _chain_edges(s, d) -> DataFrame:
    """Every order is an edge from its customer to a node of its own key."""
    e = fx.table(s, d, "orders").select(F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("N"), (F.col("o_orderkey") % CHAIN_NODES).cast("string")).alias("dst"))
    return e.filter("src <> dst").distinct()


def _chain(s, d) -> DataFrame:
    return g.causal_chain(s, _chain_edges(s, d), "N7", 5).withColumn("path", F.array_join("path", ">"))


def _drop(s, d) -> DataFrame:
    out = g.whale_then_drop(_graph(s, d), "P7", 2 * DAY)
    return out.select("tx_id", "transfer_ms", "price_ms", "exchange", F.round("price_change_pct", 4).alias("price_change_pct"))


def _exposure(s, d) -> DataFrame:
    return g.cascade_exposure(_graph(s, d), "NATION_11", AS_OF, 60 * DAY).withColumn("avg_severity", F.round("avg_severity", 6))


def _upsert_split(s, d) -> DataFrame:
    c = fx.table(s, d, "customer").select("c_custkey")
    new, old = g.new_keys(c, c.filter("c_custkey % 3 = 0"), "c_custkey")
    return new.agg(F.count(F.lit(1)).alias("inserts")).crossJoin(old.agg(F.count(F.lit(1)).alias("updates")))


def _whale_edges(s, d) -> DataFrame:
    gr = _graph(s, d)
    asset = gr["whale"].select(F.col("asset").alias("symbol")).filter("symbol <> 'MACHINERY'").distinct()
    e = g.whale_edges(gr["whale"], asset, gr["exchange"])
    out = None
    for name, t in sorted(e.items()):
        part = t.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("edge"), "dst", "n")
        out = part if out is None else out.unionByName(part)
    return out


def _low_pairs(s, d) -> DataFrame:
    sc = scored(s, d)
    pairs = sc.select(F.concat("symbol", F.lit("/USDT")).alias("symbol")).distinct().unionByName(s.createDataFrame([("SYM_CLICK/EUR",), ("OTHER/USD",)], "symbol string"))
    return g.low_quality_edges(sc, pairs).groupBy("pair").agg(F.count(F.lit(1)).alias("n_events"))


QUERIES = {
    "recent_cascades": _recent,
    "whale_activity": lambda s, d: g.whale_activity(_graph(s, d), "BUILDING", AS_OF, 90 * DAY).withColumns({"amount": F.round("amount", 6), "amount_usd": F.round("amount_usd", 2)}),
    "cascade_exposure": _exposure,
    "cascade_paths": _paths,
    "quality_trends": lambda s, d: g.quality_trends(scored(s, d), "SYM_SIGNUP", NOW, 5 * DAY).select("event_id", "ts_ms", "quality_score", F.array_join("issues", ",").alias("issues")),
    "exchange_listings": lambda s, d: g.exchange_listings(_graph(s, d)).select("exchange", "n_pairs", F.sha2(F.array_join("pairs", ","), 256).alias("pairs_sha256")),
    "low_quality_pairs": _low_pairs,
    "whale_then_drop": _drop,
    "preceding_cascades": lambda s, d: g.preceding_cascades(_graph(s, d), 7 * DAY),
    "causal_chain": _chain,
    "event_routing": _routing,
    "edge_upsert": _edges,
    "node_upsert": _nodes,
    "upsert_split": _upsert_split,
    "whale_edges": _whale_edges,
    "node_counts": lambda s, d: g.label_counts(_graph(s, d)),
    "key_violations": lambda s, d: g.uniqueness(fx.table(s, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key")), "key"),
    "severity_bands": lambda s, d: _graph(s, d)["cascade"].groupBy(g.severity_band(F.col("severity")).alias("band")).agg(F.count(F.lit(1)).alias("n")),
}

G = "WITH " + fx.GRAPH
ORACLES = {
    "recent_cascades": G + f" SELECT id, ts_ms, severity, round(spread_velocity, 4) AS spread_velocity, max_drawdown, string_agg(pair, ',' ORDER BY pair) AS affected_pairs FROM g_cascade JOIN g_affected ON id = cascade_id WHERE ts_ms > {AS_OF - 30 * DAY} AND severity >= 0.5 GROUP BY ALL",
    "whale_activity": G + f" SELECT tx_id, ts_ms, round(amount, 6) AS amount, round(amount_usd, 2) AS amount_usd, from_exchange, to_exchange FROM g_whale WHERE asset = 'BUILDING' AND ts_ms > {AS_OF - 90 * DAY} AND amount_usd >= 100000",
    "cascade_exposure": G + f", o AS (SELECT count(*) AS originated_count, round(avg(severity), 6) AS avg_severity, max(max_drawdown) AS max_drawdown FROM g_cascade WHERE origin_exchange = 'NATION_11' AND ts_ms > {AS_OF - 60 * DAY}), a AS (SELECT count(DISTINCT id) AS affected_by_count FROM g_cascade JOIN g_affected ON id = cascade_id JOIN g_lists USING (pair) WHERE exchange = 'NATION_11' AND ts_ms > {AS_OF - 60 * DAY}) SELECT * FROM o, a WHERE affected_by_count > 0",
    "cascade_paths": G + " SELECT cascade_id, ts_ms, severity, 'Exchange:NATION_11>CascadeEvent:' || cascade_id || '>Pair:' || pair || '>Exchange:NATION_10' AS path FROM g_cascade JOIN g_affected ON id = cascade_id JOIN g_lists USING (pair) WHERE origin_exchange = 'NATION_11' AND exchange = 'NATION_10' ORDER BY ts_ms DESC, cascade_id, pair LIMIT 10",
    "quality_trends": WITH + f" SELECT event_id, ts_ms, quality_score, array_to_string(issues, ',') AS issues FROM scored WHERE symbol = 'SYM_SIGNUP' AND ts_ms > {NOW - 5 * DAY}",
    "exchange_listings": G + " SELECT exchange, count(*) AS n_pairs, sha256(string_agg(pair, ',' ORDER BY pair)) AS pairs_sha256 FROM g_lists GROUP BY 1",
    "low_quality_pairs": WITH + ", p AS (SELECT DISTINCT symbol || '/USDT' AS pair FROM ticks UNION SELECT unnest(['SYM_CLICK/EUR', 'OTHER/USD'])) SELECT pair, count(*) AS n_events FROM scored JOIN p ON contains(pair, symbol) WHERE quality_score < 0.7 GROUP BY 1",
    "whale_then_drop": G + f" SELECT tx_id, w.ts_ms AS transfer_ms, p.ts_ms AS price_ms, exchange, round(price_change_pct, 4) AS price_change_pct FROM g_whale w JOIN g_price_move p ON p.symbol = 'P7' AND price_change_pct < -0.02 AND p.ts_ms > w.ts_ms AND p.ts_ms < w.ts_ms + {2 * DAY} WHERE amount > 100 AND to_exchange IS NOT NULL",
    "preceding_cascades": G + f", x AS (SELECT pair, cascade_id, ts_ms, severity FROM g_affected JOIN g_cascade ON id = cascade_id) SELECT c.pair, c.cascade_id, c.ts_ms, c.severity, count(*) AS preceding FROM x c JOIN x p ON p.pair = c.pair AND p.ts_ms < c.ts_ms AND p.ts_ms > c.ts_ms - {7 * DAY} WHERE c.severity >= 0.5 GROUP BY ALL",
    "causal_chain": f"WITH RECURSIVE e AS (SELECT DISTINCT 'N' || o_custkey AS src, 'N' || (o_orderkey % {CHAIN_NODES}) AS dst FROM orders WHERE o_custkey <> o_orderkey % {CHAIN_NODES}), c AS (SELECT src AS start, 1 AS hops, [src, dst] AS path FROM e WHERE dst = 'N7' UNION ALL SELECT e.src, hops + 1, [e.src] || path FROM c JOIN e ON e.dst = c.start WHERE hops < 5 AND NOT list_contains(path, e.src)) SELECT start, hops, array_to_string(path, '>') AS path FROM c",
    "event_routing": "SELECT CASE event_type WHEN 'click' THEN 'cascade' WHEN 'view' THEN 'whale_transfer' WHEN 'error' THEN 'quality' ELSE CASE WHEN event_id % 2 = 0 THEN 'price_movement' ELSE 'quality' END END AS route, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1",
    "edge_upsert": "SELECT src, count(*) AS n_edges FROM (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem) GROUP BY 1",
    "node_upsert": "SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY 1",
    "upsert_split": "SELECT count(*) FILTER (c_custkey % 3 <> 0) AS inserts, count(*) FILTER (c_custkey % 3 = 0) AS updates FROM customer",
    "whale_edges": G + ", t AS (SELECT * FROM g_whale WHERE asset <> 'MACHINERY'), f AS (SELECT * FROM t WHERE from_exchange IS NOT NULL) SELECT 'transferred' AS edge, asset AS dst, count(*) AS n FROM t GROUP BY ALL UNION ALL SELECT 'from_exchange', from_exchange, count(*) FROM f GROUP BY ALL UNION ALL SELECT 'to_exchange', to_exchange, count(*) FROM f WHERE to_exchange IS NOT NULL GROUP BY ALL",
    "node_counts": G + " SELECT 'exchange' AS label, count(*) AS n FROM nation UNION ALL SELECT 'pair', count(*) FROM part UNION ALL SELECT 'lists', count(*) FROM g_lists UNION ALL SELECT 'cascade', count(*) FROM g_cascade UNION ALL SELECT 'affected', count(*) FROM g_affected UNION ALL SELECT 'whale', count(*) FROM g_whale UNION ALL SELECT 'price_move', count(*) FROM g_price_move",
    "key_violations": "SELECT l_orderkey || '-' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "severity_bands": G + " SELECT CASE WHEN severity >= 0.8 THEN 'critical' WHEN severity >= 0.5 THEN 'high' WHEN severity >= 0.25 THEN 'medium' ELSE 'low' END AS band, count(*) AS n FROM g_cascade GROUP BY 1",
}
