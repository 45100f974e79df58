"""Feature store views: latest row and bounded history per symbol, reads and expiry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TTL_MS = 3_600_000
HISTORY = 1000


def member_json(scored: DataFrame) -> DataFrame:
    """The stored value of each row: its key and JSON body."""
    body = F.to_json(F.struct("symbol", F.col("ts_ms").alias("timestamp"), "price", "volume", "exchange", "quality_score"))
    return scored.select("symbol", "seq", "ts_ms", body.alias("member"))


def latest(rows: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """Last written row per symbol (not the newest by event time), with its key and expiry; one partial aggregation."""
    last = rows.groupBy("symbol").agg(F.max_by(F.struct("ts_ms", "member", "seq"), "seq").alias("r"))
    return last.select(F.format_string("features:%s:latest", "symbol").alias("key"), "symbol", "r.seq", "r.ts_ms", "r.member", (F.col("r.ts_ms") + ttl_ms).alias("expires_ms"))


def live(latest_rows: DataFrame, as_of_ms: int) -> DataFrame:
    return latest_rows.filter(F.col("expires_ms") > as_of_ms)


def history(rows: DataFrame, keep: int = HISTORY) -> DataFrame:
    """Sorted history per symbol: equal members once with their last score, newest ``keep`` by (score, member).

    The rank filter sits on the window, so each task keeps ``keep`` rows per symbol before the shuffle.
    """
    once = rows.groupBy("symbol", "member").agg(F.max_by("ts_ms", "seq").alias("ts_ms"))
    w = Window.partitionBy("symbol").orderBy(F.desc("ts_ms"), F.desc("member"))
    return once.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= keep)


def history_range(hist: DataFrame, symbol: str, start_ms: int, end_ms: int, limit: int = 100) -> DataFrame:
    """Members with start <= score <= end, oldest first, at most ``limit``."""
    hit = hist.filter((F.col("symbol") == symbol) & F.col("ts_ms").between(start_ms, end_ms))
    return hit.select("symbol", "ts_ms", "member").orderBy("ts_ms", "member").limit(limit)


def multi_latest(latest_rows: DataFrame, symbols: list[str]) -> DataFrame:
    """Requested symbols with their latest member, null where there is none."""
    wanted = latest_rows.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    return wanted.join(latest_rows.select("symbol", "member"), "symbol", "left")


def upsert_latest(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored latest rows after a batch: the higher arrival number wins, so replays change nothing."""
    both = stored.unionByName(batch)
    return both.groupBy("symbol").agg(F.max_by(F.struct(*[c for c in both.columns if c != "symbol"]), "seq").alias("r")).select("symbol", "r.*")


def upsert_history(stored: DataFrame, batch: DataFrame, keep: int = HISTORY) -> DataFrame:
    """Stored history rows (symbol, seq, ts_ms, member) after a batch: equal members once with their last score, the newest ``keep`` stay."""
    both = stored.unionByName(batch)
    once = both.groupBy("symbol", "member").agg(F.max_by("ts_ms", "seq").alias("ts_ms"), F.max("seq").alias("seq"))
    w = Window.partitionBy("symbol").orderBy(F.desc("ts_ms"), F.desc("member"))
    return once.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= keep).select("symbol", "seq", "ts_ms", "member")
