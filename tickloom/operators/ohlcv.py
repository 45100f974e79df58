"""Time-bucketed market data: bars, quality summaries, refresh and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
#: name -> (bucket width, refresh look-back, refresh lag, cadence), in ms
AGGREGATES = {
    "ohlcv_5min": (5 * MINUTE, 2 * HOUR, MINUTE, MINUTE),
    "ohlcv_1hour": (HOUR, 3 * HOUR, HOUR, 30 * MINUTE),
    "ohlcv_1day": (DAY, 2 * DAY, DAY, HOUR),
}
RETENTION_MS, COMPRESS_AFTER_MS = 365 * DAY, 90 * DAY


def bucket(ts: str, width_ms: int) -> Column:
    """Start of the UTC-aligned bucket, in epoch ms."""
    return (F.floor(F.col(ts) / width_ms) * width_ms).cast("long")


def ohlcv(data: DataFrame, width_ms: int = 5 * MINUTE, keys: tuple[str, ...] = ("symbol", "exchange"), spread: bool = True) -> DataFrame:
    """Bars per bucket and key in one partially aggregated shuffle. Ties in time go by arrival."""
    at = F.struct("ts_ms", "seq")
    aggs = [
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.avg("price").alias("avg_price"),
    ]
    if spread:
        aggs += [F.stddev_samp("price").alias("price_stddev"), (F.max("price") - F.min("price")).alias("price_range")]
    return data.groupBy(bucket("ts_ms", width_ms).alias("bucket_ms"), *keys).agg(*aggs)


def rollup_bars(bars: DataFrame, width_ms: int, keys: tuple[str, ...] = ("symbol", "exchange")) -> DataFrame:
    """Wider bars from narrower ones; equal to those from raw data, reading far fewer rows."""
    at = F.col("bucket_ms")
    return bars.groupBy(bucket("bucket_ms", width_ms).alias("_b"), *keys).agg(
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        (F.sum(F.col("avg_price") * F.col("trade_count")) / F.sum("trade_count")).alias("avg_price"),
    ).withColumnRenamed("_b", "bucket_ms")


def read_bars(bars: DataFrame, symbol: str, start_ms: int, end_ms: int, exchange: str | None = None) -> DataFrame:
    """Bars of a symbol within [start, end], newest first; the filters reach the scan."""
    out = bars.filter((F.col("symbol") == symbol) & F.col("bucket_ms").between(start_ms, end_ms))
    if exchange is not None:
        out = out.filter(F.col("exchange") == exchange)
    return out.orderBy(F.desc("bucket_ms"), "exchange")


def latest_bars(bars: DataFrame, as_of_ms: int, within_ms: int = HOUR) -> DataFrame:
    return bars.filter(F.col("bucket_ms") > as_of_ms - within_ms).orderBy(F.desc("bucket_ms"), "symbol", "exchange")


def refresh_bounds(name: str, as_of_ms: int) -> tuple[int, int]:
    """[start, end) of the buckets wholly inside [as_of - look-back, as_of - lag)."""
    width, back, lag, _ = AGGREGATES[name]
    return -(-(as_of_ms - back) // width) * width, (as_of_ms - lag) // width * width


def refresh_window(data: DataFrame, name: str, as_of_ms: int) -> DataFrame:
    """The buckets that a refresh at ``as_of`` computes anew."""
    lo, hi = refresh_bounds(name, as_of_ms)
    part = data.filter((F.col("ts_ms") >= lo) & (F.col("ts_ms") < hi))
    return ohlcv(part, AGGREGATES[name][0], spread=name == "ohlcv_5min")


def retained(data: DataFrame, as_of_ms: int, keep_ms: int = RETENTION_MS) -> DataFrame:
    return data.filter(F.col("ts_ms") >= as_of_ms - keep_ms)


def cold(data: DataFrame, as_of_ms: int, after_ms: int = COMPRESS_AFTER_MS) -> DataFrame:
    """Rows of whole UTC days that ended at least ``after_ms`` ago."""
    return data.filter(bucket("ts_ms", DAY) + DAY <= as_of_ms - after_ms)


def write_compressed(data: DataFrame, path: str, as_of_ms: int | None = None, after_ms: int = COMPRESS_AFTER_MS) -> None:
    """Cold layout: one folder per day, segments by symbol and exchange, newest first, zstd. ``as_of_ms``: only days old enough by then."""
    d = data if as_of_ms is None else cold(data, as_of_ms, after_ms)
    d = d.withColumn("date", F.to_date(F.timestamp_millis("ts_ms")))
    d.repartition("date", "symbol").sortWithinPartitions("date", "symbol", "exchange", F.desc("ts_ms")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("date").parquet(path)


def quality_summary(scored: DataFrame, start_ms: int | None = None, end_ms: int | None = None, low: float = 0.7) -> DataFrame:
    """Counts and quality per symbol and exchange, worst first."""
    d = scored
    if start_ms is not None:
        d = d.filter(F.col("ts_ms") >= start_ms)
    if end_ms is not None:
        d = d.filter(F.col("ts_ms") <= end_ms)
    out = d.groupBy("symbol", "exchange").agg(F.count(F.lit(1)).alias("total_records"), F.avg("quality_score").alias("avg_quality"), F.min("quality_score").alias("min_quality"), F.count_if(F.col("quality_score") < low).alias("low_quality_count"))
    return out.orderBy("avg_quality", "symbol", "exchange")


def unique_issues(scored: DataFrame) -> DataFrame:
    """Per symbol: rows, mean quality and the distinct issue codes. Codes are a handful, so sets merge map-side."""
    return scored.groupBy("symbol").agg(F.count(F.lit(1)).alias("total"), F.avg("quality_score").alias("avg_quality"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("issues")))).alias("unique_issues"))


def quality_metrics(scored: DataFrame, width_ms: int = HOUR, low: float = 0.7) -> DataFrame:
    """Roll-up of totals, valid rows, quality and four kinds of issue per bucket, symbol and exchange."""
    has = lambda *codes: F.count_if(F.arrays_overlap("issues", F.array(*[F.lit(c) for c in codes])))
    return scored.groupBy(bucket("ts_ms", width_ms).alias("bucket_ms"), "symbol", "exchange").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("quality_score") >= low).alias("valid_messages"),
        F.avg("quality_score").alias("avg_quality"),
        F.min("quality_score").alias("min_quality"),
        has("PARSE_ERROR").alias("parse_errors"),
        has("STALE_DATA").alias("stale_data"),
        has("PRICE_ANOMALY").alias("price_anomalies"),
        has("VOLUME_SPIKE", "EXTREME_VOLUME_SPIKE").alias("volume_spikes"),
    )


def drill_downs(data: DataFrame, width_ms: int = DAY) -> DataFrame:
    """Volume and trades by day, symbol and exchange with subtotals (a rollup in one pass)."""
    return data.rollup(bucket("ts_ms", width_ms).alias("bucket_ms"), "symbol", "exchange").agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("trade_count"))
