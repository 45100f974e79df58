"""Views that give the fixture tables the shapes of market data, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01 UTC
AS_OF_EVENTS_MS = 1_706_659_200_000  # 2024-01-31 UTC
AS_OF_GRAPH_MS = 996_624_000_000  # 2001-08-01 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(c: str | Column) -> Column:
    """Epoch milliseconds of a zoneless timestamp, read as UTC whatever the session's zone."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.timestamp_diff("MILLISECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), c.cast("timestamp_ntz"))
    return whole


def micros(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), c.cast("timestamp_ntz"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ticks; ``seq`` is the arrival order and one row in 17 arrives late."""
    e = table(spark, sf_dir, "events")
    id_, k = F.col("event_id"), F.get_json_object("props", "$.k")
    names = F.array(*[F.lit(x) for x in ("binance", "kraken", "bybit", "deribit", "coinbase", "otherex")])
    price = F.when(id_ % 97 == 0, -1.0).when(id_ % 193 == 0, 0.0).when(id_ % 13 == 0, (100.0 + F.col("value")) / 7.0).otherwise(F.round(100.0 + F.col("value") / 10.0, 3))
    minute = F.floor(micros("ts") / 60_000_000) * 60_000
    return e.select(
        "event_id",
        (2 * id_ + F.when(id_ % 17 == 0, 101).otherwise(0)).alias("seq"),
        F.concat(F.lit("SYM_"), F.upper("event_type")).alias("symbol"),
        F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")).alias("exchange"),
        price.cast("double").alias("price"),
        F.when(id_ % 89 == 0, -200.0).otherwise(k.cast("double")).alias("volume"),
        minute.alias("ts_ms"),
        (minute + k.cast("long") * 400 - 8000).alias("now_ms"),
    )


TICKS = """
ticks AS (SELECT event_id,
  2*event_id + CASE WHEN event_id % 17 = 0 THEN 101 ELSE 0 END AS seq,
  'SYM_' || upper(event_type) AS symbol,
  CASE user_id % 6 WHEN 0 THEN 'binance' WHEN 1 THEN 'kraken' WHEN 2 THEN 'bybit' WHEN 3 THEN 'deribit' WHEN 4 THEN 'coinbase' ELSE 'otherex' END AS exchange,
  CASE WHEN event_id % 97 = 0 THEN -1.0 WHEN event_id % 193 = 0 THEN 0.0 WHEN event_id % 13 = 0 THEN (100.0 + value) / 7.0 ELSE round(100.0 + value / 10.0, 3) END::DOUBLE AS price,
  CASE WHEN event_id % 89 = 0 THEN -200.0 ELSE json_extract_string(props,'$.k')::DOUBLE END AS volume,
  (epoch_us(ts)//60000000)*60000 AS ts_ms,
  (epoch_us(ts)//60000000)*60000 + json_extract_string(props,'$.k')::BIGINT*400 - 8000 AS now_ms
FROM events)"""


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as JSON payloads, with one in 101 malformed."""
    t = ticks(spark, sf_dir)
    bad = F.array(*[F.lit(x) for x in ("symbol=SYM;price=1", "{{]", '{"symbol" "SYM", "price" 1}', '{"price": 1.5, "vol', "   ", "42", '["SYM", 1.5]')])
    body = F.to_json(F.struct("symbol", "price", "volume", "exchange", F.col("ts_ms").alias("timestamp"), F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("venue_note")))
    broken = F.element_at(bad, (F.floor(F.col("event_id") / 101) % 7 + 1).cast("int"))
    return t.select("event_id", "seq", "now_ms", F.when(F.col("event_id") % 101 == 0, broken).otherwise(body).alias("value"))


def triangulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three timestamps per event in microseconds: exchange, receive, process."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    ts = micros("ts")
    lag = F.when(F.col("event_id") % 211 == 0, k * 20).otherwise(k) + F.when(F.col("event_id") % 10_000 >= 5_000, 250).otherwise(0)
    block = F.floor(F.col("event_id") / 120)
    receive = F.when(block % 9 == 4, EPOCH_US + block * 3_600_000_000).otherwise(ts + lag * 1000)
    sent = ts - F.when(F.col("event_id") % 307 == 0, 3 * 86_400_000_000).otherwise(0)
    return e.select("event_id", F.col("event_type").alias("source_id"), F.concat(F.lit("U"), (F.col("user_id") % 10).cast("string")).alias("symbol"), sent.alias("exchange_us"), receive.alias("receive_us")).withColumn("process_us", F.col("receive_us") + F.col("event_id") % 7 * 1000)


TRI = f"""
tri AS (SELECT *, receive_us + event_id % 7 * 1000 AS process_us FROM (SELECT event_id, event_type AS source_id, 'U' || (user_id % 10) AS symbol,
  epoch_us(ts) - CASE WHEN event_id % 307 = 0 THEN 259200000000 ELSE 0 END AS exchange_us,
  CASE WHEN (event_id // 120) % 9 = 4 THEN {EPOCH_US} + event_id // 120 * 3600000000
    ELSE epoch_us(ts) + (CASE WHEN event_id % 211 = 0 THEN 20 ELSE 1 END * json_extract_string(props,'$.k')::BIGINT + CASE WHEN event_id % 10000 >= 5000 THEN 250 ELSE 0 END) * 1000 END AS receive_us
FROM events))"""


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose volumes are slightly negative but for one in seven, so that averages pass close to zero and both volume codes occur."""
    id_ = F.col("event_id")
    return ticks(spark, sf_dir).withColumn("volume", F.when(id_ % 7 == 3, 9.0 + id_ % 23 / 7.0).otherwise(-1.0))


BURSTS = TICKS.replace("ticks AS (", "calm AS (") + """,
ticks AS (SELECT * REPLACE (CASE WHEN event_id % 7 = 3 THEN 9.0 + event_id % 23 / 7.0::DOUBLE ELSE -1.0 END::DOUBLE AS volume) FROM calm)"""


def service_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring samples (metric, labels, ts_ms, value) of five instances: an hour of events is a minute of samples."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("k"), (F.floor(micros("ts") / 3_600_000_000) - EPOCH_US // 3_600_000_000).alias("h"), "value")
    cell = e.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("v"))
    upto = Window.partitionBy("k").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    hit = lambda hours, of, at: (F.floor(F.col("h") / hours) % of == at).cast("double")
    cell = cell.withColumns({"total": F.sum("n").over(upto), "failed": F.sum(hit(10, 4, F.col("k") % 4)).over(upto)})
    label = lambda **more: F.create_map(F.lit("instance"), F.concat(F.lit("n"), F.col("k").cast("string")), *[x for a, b in more.items() for x in (F.lit(a), b)])
    disk = label(fstype=F.element_at(F.array(*map(F.lit, ("ext4", "ext4", "xfs", "tmpfs", "overlay"))), (F.col("k") + 1).cast("int")))
    values = [
        ("node_memory_MemAvailable_bytes", label(), F.col("v")),
        ("node_memory_MemTotal_bytes", label(), F.lit(2500.0)),
        ("node_cpu_seconds_total", label(cpu=F.lit("0"), mode=F.lit("idle")), F.col("total") * 1.0),
        ("node_cpu_seconds_total", label(cpu=F.lit("1"), mode=F.lit("idle")), F.col("total") * 0.75),
        ("node_cpu_seconds_total", label(cpu=F.lit("1"), mode=F.lit("user")), F.col("total") * 50.0),
        ("node_filesystem_avail_bytes", disk, F.col("v")),
        ("node_filesystem_size_bytes", disk, F.lit(2000.0)),
        ("stream_running_jobs", label(), 1.0 - hit(6, 5, F.col("k"))),
        ("stream_last_checkpoint_ms", label(), 1000.0 + 70_000 * hit(8, 3, F.lit(0))),
        ("checkpoints_failed_total", label(), F.col("failed")),
        ("store_up", label(), 1.0 - hit(4, 6, F.col("k"))),
        ("consumergroup_lag", label(), 8000.0 + 4000 * hit(15, 3, F.lit(2))),
        ("broker_up", label(), 1.0 - hit(5, 7, F.col("k"))),
    ]
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), lab.alias("labels"), v.cast("double").alias("value")) for m, lab, v in values])).alias("m")
    return cell.select((EPOCH_US // 1000 + F.col("h") * 60_000).alias("ts_ms"), each).select("m.metric", "m.labels", "ts_ms", "m.value")


CELLS = f"""
cell AS (SELECT user_id % 5 AS k, epoch_us(ts) // 3600000000 - {EPOCH_US // 3_600_000_000} AS h, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY ALL),
sampled AS (SELECT *, 'n' || k AS instance, {EPOCH_US // 1000} + h * 60000 AS ts_ms, sum(n) OVER (PARTITION BY k ORDER BY h) AS total, sum((h // 10 % 4 = k % 4)::INT) OVER (PARTITION BY k ORDER BY h) AS failed,
  ['ext4', 'ext4', 'xfs', 'tmpfs', 'overlay'][k + 1] AS fstype FROM cell)"""


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("strategy_id"), ms("ts").alias("ts_ms"), F.substring(F.sha2("event_type", 256), 1, 16).alias("positions_hash"))


HEARTBEATS = """
heartbeats AS (SELECT event_id, 'S' || (user_id % 10) AS strategy_id, epoch_us(ts) // 1000 AS ts_ms, substr(sha256(event_type), 1, 16) AS positions_hash FROM events)"""


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with gaps scaled by 1/1000 so that the seconds bands are met; value is the tick price."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", micros("ts").alias("us"))
    t = ticks(spark, sf_dir).select("event_id", "symbol", "price", (F.col("now_ms") - F.col("ts_ms")).alias("staleness_ms"))
    src = F.concat("event_type", F.lit("_"), (F.col("user_id") % 3).cast("string"))
    return e.join(t, "event_id").select("event_id", src.alias("source_id"), F.floor(F.col("us") / 1000).alias("source_us"), "symbol", F.lit("price").alias("data_type"), F.col("price").alias("value"), F.pmod("staleness_ms", F.lit(2600)).alias("staleness_ms"))


PROVENANCE = TICKS + """,
prov AS (SELECT e.event_id, event_type || '_' || (user_id % 3) AS source_id, epoch_us(ts) // 1000 AS source_us, symbol, 'price' AS data_type, price AS value,
  ((now_ms - ts_ms) % 2600 + 2600) % 2600 AS staleness_ms FROM events e JOIN ticks USING (event_id))"""


def graph(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Node and edge tables from the order tables."""
    t = lambda n: table(spark, sf_dir, n)
    nation, orders, line = t("nation"), t("orders"), t("lineitem")
    of_supplier = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("sn"))
    of_customer = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", F.col("n_name").alias("cn"))
    lines = line.select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_discount", F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("pair"))
    with_sn = lines.join(of_supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    cascade = orders.filter("o_orderstatus = 'F'").join(of_customer, F.col("o_custkey") == F.col("c_custkey"))
    cascade = cascade.select(F.col("o_orderkey").alias("id"), ms("o_orderdate").alias("ts_ms"), (F.col("o_orderkey") % 100 / 100.0).alias("severity"), (F.col("o_totalprice") / 1000).alias("spread_velocity"), (F.col("o_orderkey") % 37 / 100.0).alias("max_drawdown"), F.col("cn").alias("origin_exchange"))
    affected = lines.select(F.col("l_orderkey").alias("cascade_id"), "pair").join(cascade.select(F.col("id").alias("cascade_id")), "cascade_id", "left_semi").distinct()
    first = with_sn.filter("l_linenumber = 1").groupBy("l_orderkey").agg(F.min("sn").alias("to_exchange"))
    whale = orders.filter("o_totalprice >= 300000").join(of_customer, F.col("o_custkey") == F.col("c_custkey")).join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    whale = whale.select(F.col("o_orderkey").alias("tx_id"), ms("o_orderdate").alias("ts_ms"), (F.col("o_totalprice") / 1000).alias("amount"), F.col("o_totalprice").alias("amount_usd"), F.col("c_mktsegment").alias("asset"), F.when(F.col("o_custkey") % 7 != 0, F.col("cn")).alias("from_exchange"), "to_exchange")
    return {
        "exchange": nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id")),
        "pair": t("part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), F.col("p_partkey").alias("id")),
        "lists": with_sn.select(F.col("sn").alias("exchange"), "pair").distinct(),
        "cascade": cascade,
        "affected": affected,
        "whale": whale,
        "price_move": with_sn.select(ms("l_shipdate").alias("ts_ms"), F.col("pair").alias("symbol"), F.col("sn").alias("exchange"), (F.col("l_discount") - 0.05).alias("price_change_pct")),
    }


GRAPH = """
g_supplier AS (SELECT s_suppkey, n_name AS sn FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g_customer AS (SELECT c_custkey, c_mktsegment, n_name AS cn FROM customer JOIN nation ON c_nationkey = n_nationkey),
g_lists AS (SELECT DISTINCT sn AS exchange, 'P' || l_partkey AS pair FROM lineitem JOIN g_supplier ON l_suppkey = s_suppkey),
g_cascade AS (SELECT o_orderkey AS id, epoch_ms(o_orderdate) AS ts_ms, (o_orderkey % 100) / 100.0::DOUBLE AS severity, o_totalprice / 1000 AS spread_velocity, (o_orderkey % 37) / 100.0::DOUBLE AS max_drawdown, cn AS origin_exchange
  FROM orders JOIN g_customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'),
g_affected AS (SELECT DISTINCT l_orderkey AS cascade_id, 'P' || l_partkey AS pair FROM lineitem WHERE l_orderkey IN (SELECT id FROM g_cascade)),
g_whale AS (SELECT o_orderkey AS tx_id, epoch_ms(o_orderdate) AS ts_ms, o_totalprice / 1000 AS amount, o_totalprice AS amount_usd, c_mktsegment AS asset, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE cn END AS from_exchange, to_exchange
  FROM orders JOIN g_customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, min(sn) AS to_exchange FROM lineitem JOIN g_supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 1 GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_totalprice >= 300000),
g_price_move AS (SELECT epoch_ms(l_shipdate) AS ts_ms, 'P' || l_partkey AS symbol, sn AS exchange, l_discount - 0.05 AS price_change_pct FROM lineitem JOIN g_supplier ON l_suppkey = s_suppkey)"""
