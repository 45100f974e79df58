"""Causal event graph on DataFrames: routing, upserts and the read queries.

A graph is a dict of node and edge tables: ``exchange`` (name), ``pair`` (symbol), ``asset`` (symbol), ``lists``
(exchange, pair), ``cascade`` (id, ts_ms, severity, spread_velocity, max_drawdown, origin_exchange), ``affected``
(cascade_id, pair), ``whale`` (tx_id, ts_ms, amount, amount_usd, asset, from_exchange, to_exchange),
``price_move`` (ts_ms, symbol, exchange, price_change_pct). Times are epoch ms; ``as_of`` is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.columns import range_join
from tickloom.sources.tables import stored

DAY, HOUR = 86_400_000, 3_600_000
ROUTES = ("cascade", "whale_transfer", "price_movement", "quality")
# The seed entities are data.
SEED_EXCHANGES = ("binance", "kraken", "bybit", "deribit", "coinbase")
SEED_ASSETS = ("BTC", "ETH", "USDT", "USDC", "SOL")


def route(events: DataFrame, kind: str = "event_type", fallback: str = "type") -> DataFrame:
    """Adds ``route``: cascade, whale_transfer, price_movement, or quality for everything else."""
    name = F.coalesce(F.col(kind), F.col(fallback), F.lit("quality"))
    return events.withColumn("route", F.when(name.isin(*ROUTES[:3]), name).otherwise("quality"))


def routed(events: DataFrame) -> dict[str, DataFrame]:
    """The routes as tables; together they are all of ``events``."""
    d = route(events)
    return {r: d.filter(F.col("route") == r) for r in ROUTES}


def upsert_nodes(stored: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """Merge by key: the newest version of each node."""
    both = stored.unionByName(batch)
    return both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), seq).alias("_n")).select(key, "_n.*")


def new_keys(batch: DataFrame, stored: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows to update)."""
    return batch.join(stored.select(key), key, "left_anti"), batch.join(stored.select(key), key, "left_semi")


def upsert_edges(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Edges are a set."""
    return stored.unionByName(batch).distinct()


def cascade_edges(cascades: DataFrame, exchange: DataFrame, pair: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(originated, affected) from rows with ``affected_pairs``. An unknown origin leaves no edge of either kind."""
    known = cascades.join(exchange.select(F.col("name").alias("origin_exchange")), "origin_exchange", "left_semi")
    hit = known.select(F.col("id").alias("cascade_id"), F.explode("affected_pairs").alias("pair")).join(pair.select(F.col("symbol").alias("pair")), "pair", "left_semi")
    return known.select(F.col("id").alias("cascade_id"), F.col("origin_exchange").alias("exchange")).distinct(), hit.select("cascade_id", "pair").distinct()


def whale_edges(whales: DataFrame, asset: DataFrame, exchange: DataFrame) -> dict[str, DataFrame]:
    """TRANSFERRED, FROM_EXCHANGE and TO_EXCHANGE. Each needs the one before: no sender, no receiver edge."""
    names = exchange.select("name")
    sent = whales.join(asset.select(F.col("symbol").alias("asset")), "asset", "left_semi")
    from_ = sent.filter(F.col("from_exchange").isNotNull()).join(names.withColumnRenamed("name", "from_exchange"), "from_exchange", "left_semi")
    to = from_.filter(F.col("to_exchange").isNotNull()).join(names.withColumnRenamed("name", "to_exchange"), "to_exchange", "left_semi")
    edge = lambda d, c: d.select("tx_id", F.col(c).alias("dst")).distinct()
    return {"transferred": edge(sent, "asset"), "from_exchange": edge(from_, "from_exchange"), "to_exchange": edge(to, "to_exchange")}


def move_edges(moves: DataFrame, pair: DataFrame, exchange: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ON_PAIR, ON_EXCHANGE) of rows (id, symbol, exchange); the second needs the first."""
    on = moves.join(pair.select("symbol"), "symbol", "left_semi")
    at = on.join(exchange.select(F.col("name").alias("exchange")), "exchange", "left_semi")
    return on.select("id", "symbol").distinct(), at.select("id", "exchange").distinct()


def low_quality_edges(scored: DataFrame, pair: DataFrame, below: float = 0.7) -> DataFrame:
    """Pairs whose symbol contains the symbol of a low-quality event.

    Distinct symbols meet the pairs through an index of the pairs' substrings of the lengths that symbols have, so the
    join is an equality and no side is compared with all of the other. An empty symbol stands in every pair.
    """
    low = scored.filter((F.col("quality_score") < below) & F.col("symbol").isNotNull())
    names = low.select("symbol").distinct()
    lengths = names.select(F.length("symbol").alias("n")).distinct().agg(F.array_sort(F.collect_list("n")).alias("lengths"))
    found = F.flatten(F.transform("lengths", lambda n: F.transform(F.sequence(F.lit(0), F.greatest(F.length("pair") - n, F.lit(0))), lambda i: F.substring(F.col("pair"), i + 1, n))))
    index = pair.select(F.col("symbol").alias("pair")).crossJoin(lengths).select("pair", F.explode(F.array_distinct(found)).alias("symbol"))
    hit = names.join(index, "symbol").filter(F.contains("pair", "symbol"))
    return low.select("event_id", "symbol").join(hit, "symbol").select("event_id", "pair").distinct()


def recent_cascades(g: dict[str, DataFrame], as_of: int, horizon: int = DAY, min_severity: float = 0.5) -> DataFrame:
    c = g["cascade"].filter((F.col("ts_ms") > as_of - horizon) & (F.col("severity") >= min_severity))
    met = c.join(g["affected"], F.col("id") == F.col("cascade_id"))
    out = met.groupBy("id", "ts_ms", "severity", "spread_velocity", "max_drawdown").agg(F.array_sort(F.collect_list("pair")).alias("affected_pairs"))
    return out.orderBy(F.desc("ts_ms"), "id")


def whale_activity(g: dict[str, DataFrame], asset: str, as_of: int, horizon: int = DAY, min_usd: float = 100_000) -> DataFrame:
    w = g["whale"].filter((F.col("asset") == asset) & (F.col("ts_ms") > as_of - horizon) & (F.col("amount_usd") >= min_usd))
    names = g["exchange"].select("name")
    d = w.join(names.withColumnRenamed("name", "_f"), F.col("from_exchange") == F.col("_f"), "left").join(names.withColumnRenamed("name", "_t"), F.col("to_exchange") == F.col("_t"), "left")
    return d.select("tx_id", "ts_ms", "amount", "amount_usd", F.col("_f").alias("from_exchange"), F.col("_t").alias("to_exchange")).orderBy(F.desc("ts_ms"), "tx_id")


def cascade_exposure(g: dict[str, DataFrame], exchange: str, as_of: int, horizon: int = 7 * DAY) -> DataFrame:
    """One row, or none at all when no listed pair was affected in the horizon."""
    recent = g["cascade"].filter(F.col("ts_ms") > as_of - horizon)
    own = recent.filter(F.col("origin_exchange") == exchange).agg(F.count(F.lit(1)).alias("originated_count"), F.avg("severity").alias("avg_severity"), F.max("max_drawdown").alias("max_drawdown"))
    listed = g["lists"].filter(F.col("exchange") == exchange).select("pair")
    hit = recent.select(F.col("id").alias("cascade_id")).join(g["affected"], "cascade_id").join(listed, "pair", "left_semi")
    by = hit.agg(F.count_distinct("cascade_id").alias("affected_by_count")).filter("affected_by_count > 0")
    return own.crossJoin(by)


def cascade_paths(g: dict[str, DataFrame], src: str, dst: str, max_hops: int = 3, limit: int | None = 10) -> DataFrame:
    """Paths src <- cascade -> pair <- dst, newest first; the path has three edges, so max_hops below 2 finds none."""
    if 3 > 2 * max_hops:
        return cascade_paths(g, src, dst).filter("false")
    c = g["cascade"].filter(F.col("origin_exchange") == src)
    listed = g["lists"].filter(F.col("exchange") == dst).select("pair")
    met = c.join(g["affected"], F.col("id") == F.col("cascade_id")).join(listed, "pair")
    path = F.array(F.lit(f"Exchange:{src}"), F.concat(F.lit("CascadeEvent:"), F.col("id").cast("string")), F.concat(F.lit("Pair:"), "pair"), F.lit(f"Exchange:{dst}"))
    out = met.select("cascade_id", "ts_ms", "severity", path.alias("path")).orderBy(F.desc("ts_ms"), "cascade_id", "path")
    return out if limit is None else out.limit(limit)


def quality_trends(scored: DataFrame, symbol: str, as_of: int, horizon: int = DAY) -> DataFrame:
    hit = scored.filter((F.col("symbol") == symbol) & (F.col("ts_ms") > as_of - horizon))
    return hit.select("event_id", "ts_ms", "quality_score", "issues").orderBy(F.desc("ts_ms"), "event_id")


def exchange_listings(g: dict[str, DataFrame]) -> DataFrame:
    """Each exchange with its pairs in one row, as the listing is defined; a row is as long as an exchange has pairs."""
    return g["lists"].groupBy("exchange").agg(F.count(F.lit(1)).alias("n_pairs"), F.array_sort(F.collect_list("pair")).alias("pairs"))


def whale_then_drop(g: dict[str, DataFrame], pair: str, horizon_ms: int = HOUR, min_amount: float = 100.0, drop: float = -0.02, limit: int | None = None) -> DataFrame:
    """Transfers followed within the horizon by a fall of the pair's price; a bucketed range join. ``limit``: the largest so many, largest first."""
    w = g["whale"].filter((F.col("amount") > min_amount) & F.col("to_exchange").isNotNull()).select("tx_id", "amount", F.col("ts_ms").alias("transfer_ms"))
    p = g["price_move"].filter((F.col("symbol") == pair) & (F.col("price_change_pct") < drop)).select(F.col("ts_ms").alias("price_ms"), "exchange", "price_change_pct")
    out = range_join(w, p, "transfer_ms", "price_ms", horizon_ms, [])
    return out if limit is None else out.orderBy(F.desc("amount"), "tx_id", "price_ms", "exchange", "price_change_pct").limit(limit)


def preceding_cascades(g: dict[str, DataFrame], horizon_ms: int = HOUR, min_severity: float = 0.5) -> DataFrame:
    """Per pair and severe cascade: how many cascades came strictly within the horizon before it (none: no row)."""
    at = g["affected"].join(g["cascade"].select(F.col("id").alias("cascade_id"), "ts_ms", "severity"), "cascade_id")
    w = Window.partitionBy("pair").orderBy("ts_ms").rangeBetween(-horizon_ms + 1, -1)
    return at.withColumn("preceding", F.count(F.lit(1)).over(w)).filter((F.col("severity") >= min_severity) & (F.col("preceding") > 0)).select("pair", "cascade_id", "ts_ms", "severity", "preceding")


def causal_chain(spark: SparkSession, edges: DataFrame, target: str, max_hops: int = 5) -> DataFrame:
    """All simple-edge paths of 1 to ``max_hops`` edges that end at ``target``: (start, hops, path). ``edges``: (src, dst).

    Walks backwards, one join a hop; each frontier is stored, so a hop reads the one before and repeats no earlier join.
    """
    front = edges.filter(F.col("dst") == target).select(F.col("src").alias("start"), F.lit(1).alias("hops"), F.array("src", "dst").alias("path"))
    out = front
    back = edges.select(F.col("src").alias("_s"), F.col("dst").alias("start"))
    for _ in range(max_hops - 1):
        front = stored(back.join(front, "start").filter(~F.array_contains("path", F.col("_s"))).select(F.col("_s").alias("start"), (F.col("hops") + 1).alias("hops"), F.concat(F.array("_s"), "path").alias("path")), "front")
        out = out.unionByName(front)
    return out


def causal_chain_sql(edges_view: str, target: str, max_hops: int = 5) -> str:
    """The same as a recursive SQL query, for engines and sessions that prefer text."""
    return f"""
    WITH RECURSIVE chain(start, hops, path) AS (
      SELECT src, 1, array(src, dst) FROM {edges_view} WHERE dst = '{target}'
      UNION ALL
      SELECT e.src, c.hops + 1, concat(array(e.src), c.path) FROM {edges_view} e JOIN chain c ON e.dst = c.start
      WHERE c.hops < {max_hops} AND NOT array_contains(c.path, e.src))
    SELECT * FROM chain"""


def uniqueness(nodes: DataFrame, key: str) -> DataFrame:
    """Violations of the key's uniqueness: key and count."""
    return nodes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def seed(spark: SparkSession) -> dict[str, DataFrame]:
    """The service's fixed entities."""
    pairs = [("BTC/USDT", "BTC", "USDT"), ("ETH/USDT", "ETH", "USDT"), ("SOL/USDT", "SOL", "USDT")]
    lists = [("binance", "BTC/USDT"), ("binance", "ETH/USDT"), ("binance", "SOL/USDT"), ("kraken", "BTC/USDT"), ("kraken", "ETH/USDT")]
    make = spark.createDataFrame
    return {
        "exchange": make([(e,) for e in SEED_EXCHANGES], "name string"),
        "asset": make([(a,) for a in SEED_ASSETS], "symbol string"),
        "pair": make([(p,) for p, _, _ in pairs], "symbol string"),
        "pair_asset": make([x for p, b, q in pairs for x in ((p, "BASE_ASSET", b), (p, "QUOTE_ASSET", q))], "pair string, kind string, asset string"),
        "lists": make(lists, "exchange string, pair string"),
    }


def label_counts(g: dict[str, DataFrame]) -> DataFrame:
    """Rows per table of the graph."""
    out = None
    for name, d in sorted(g.items()):
        part = d.agg(F.lit(name).alias("label"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def severity_band(severity: Column) -> Column:
    return F.when(severity >= 0.8, "critical").when(severity >= 0.5, "high").when(severity >= 0.25, "medium").otherwise("low")
