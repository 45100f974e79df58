"""Batch quality scorer: fifteen stateful checks per tick, all as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import PARSE_ERROR, QualityConfig
from tickloom.functions.columns import clamp, decimals, ranked, real, running

DEFAULT = QualityConfig()


def with_state(ticks: DataFrame, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """Each tick with what its symbol's state held before it (last_ts, last_price) and the averages after it.

    State follows arrival order. Ticks that failed to parse must not be in ``ticks``.
    """
    d = ranked(ticks, "symbol", "seq")
    d = running(d, "symbol", "rn", {"ts_ms": "last_ts", "price": "last_price"}, {"price": "price_ema", "volume": "volume_ema"}, cfg.ema_alpha)
    d = d.withColumnRenamed("volume_ema_before", "volume_ref").drop("price_ema_before")
    return d if cfg.compare_to_prior_ema else d.drop("volume_ref")


def schema_issues(cfg: QualityConfig = DEFAULT) -> list[Column]:
    return [
        F.when(real("price") <= 0, F.lit("INVALID_PRICE_NEGATIVE")),
        F.when(real("volume") < 0, F.lit("INVALID_VOLUME_NEGATIVE")),
        F.when(~F.col("exchange").isin(*cfg.valid_exchanges), F.lit("UNKNOWN_EXCHANGE")),
    ]


def temporal_issue(cfg: QualityConfig = DEFAULT) -> Column:
    gap = F.col("ts_ms") - F.col("last_ts")
    return F.when(gap < 0, F.lit("OUT_OF_ORDER")).when(gap == 0, F.lit("DUPLICATE_TIMESTAMP")).when(gap > cfg.gap_ms, F.lit("LARGE_GAP"))


def price_move() -> Column:
    """Relative move from the last price; null without one, and for a last price of zero."""
    return F.try_divide(F.abs(real("price") - real("last_price")), real("last_price"))


def move_issue(cfg: QualityConfig = DEFAULT) -> Column:
    return F.when(price_move() > cfg.extreme_move, F.lit("EXTREME_PRICE_MOVE")).when(price_move() > cfg.large_move, F.lit("LARGE_PRICE_MOVE"))


def anomaly_issue(cfg: QualityConfig = DEFAULT) -> Column:
    avg = real("price_ema")
    return F.when((avg > 0) & (F.try_divide(F.abs(real("price") - avg), avg) > cfg.ema_deviation), F.lit("PRICE_ANOMALY"))


def volume_issue(cfg: QualityConfig = DEFAULT) -> Column:
    avg = real("volume_ref" if cfg.compare_to_prior_ema else "volume_ema")
    ratio = F.try_divide(real("volume"), avg)
    return F.when((avg > 0) & (ratio > cfg.extreme_volume), F.lit("EXTREME_VOLUME_SPIKE")).when((avg > 0) & (ratio > cfg.large_volume), F.lit("VOLUME_SPIKE"))


def precision_issue(cfg: QualityConfig = DEFAULT) -> Column:
    return F.when(decimals("price") > cfg.max_decimals, F.lit("EXCESSIVE_PRECISION"))


def freshness_issue(cfg: QualityConfig = DEFAULT) -> Column:
    age = F.col("now_ms") - F.col("ts_ms")
    return F.when(age > cfg.stale_ms, F.lit("STALE_DATA")).when(age > cfg.delayed_ms, F.lit("DELAYED_DATA")).when(age < -cfg.future_ms, F.lit("FUTURE_TIMESTAMP"))


def issue_list(cfg: QualityConfig = DEFAULT) -> Column:
    """Issue codes in the order of the checks."""
    checks = [*schema_issues(cfg), temporal_issue(cfg), move_issue(cfg), anomaly_issue(cfg), volume_issue(cfg), precision_issue(cfg), freshness_issue(cfg)]
    return F.array_compact(F.array(*checks))


def score_of(issues: Column, cfg: QualityConfig = DEFAULT) -> Column:
    """1 less the penalties, within [0, 1], to three places."""
    table = F.create_map(*[F.lit(x) for kv in cfg.penalties.items() for x in kv])
    total = F.aggregate(issues, F.lit(0.0), lambda s, i: s + F.coalesce(F.try_element_at(table, i), F.lit(0.0)))
    return F.round(clamp(1.0 - total), 3)


def score(ticks: DataFrame, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """Ticks with issues, issue_count and quality_score."""
    d = with_state(ticks, cfg).withColumn("issues", issue_list(cfg))
    return d.withColumns({"quality_score": score_of(F.col("issues"), cfg), "issue_count": F.size("issues")})


def score_parsed(parsed: DataFrame, cfg: QualityConfig = DEFAULT) -> DataFrame:
    """Scores a parser's output: failed rows get PARSE_ERROR, symbol ERROR, timestamp 0, score 0, and touch no state."""
    good = score(parsed.filter("NOT parse_error"), cfg)
    cols = ["symbol", "ts_ms", "quality_score", "issues", "issue_count"]
    bad = parsed.filter("parse_error").select("seq", F.lit("ERROR").alias("symbol"), F.lit(0).cast("long").alias("ts_ms"), F.lit(0.0).alias("quality_score"), F.array(F.lit(PARSE_ERROR)).alias("issues"), F.lit(1).alias("issue_count"))
    return good.select("seq", *cols).unionByName(bad)


def envelope(scored: DataFrame, processed_at_ms: str = "now_ms", payload: str | None = None) -> DataFrame:
    """One JSON message per scored tick, fields promoted beside the original data.

    ``payload`` names the column with the message as it came (JSON text); it passes with all of its fields, and a failed
    one as an empty object. Without it the original data is rebuilt from the tick.
    """
    if payload is None:
        original = F.to_json(F.struct("symbol", "price", "volume", "exchange", F.col("ts_ms").alias("timestamp")))
    else:
        original = F.when(F.array_contains("issues", PARSE_ERROR), F.lit("{}")).otherwise(F.trim(F.col(payload)))
    head = F.to_json(F.struct("symbol", F.col("ts_ms").alias("timestamp"), "price", "volume", "exchange", "quality_score", "issues", "issue_count", F.col(processed_at_ms).alias("processed_at_ms")))
    body = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(',"original_data":'), F.coalesce(original, F.lit("{}")), F.lit("}"))
    return scored.select(F.col("symbol").alias("key"), body.alias("value"))


def valid_row() -> Column:
    """The table constraints: price above 0, volume at least 0, score within [0, 1], keys present."""
    keys = F.col("symbol").isNotNull() & F.col("exchange").isNotNull() & F.col("ts_ms").isNotNull()
    return F.coalesce(keys & (real("price") > 0) & (real("volume") >= 0) & F.col("quality_score").between(0, 1), F.lit(False))


def with_defaults(messages: DataFrame) -> DataFrame:
    """Row mapping of the time-series writer, with its defaults for absent fields."""
    fill = {"exchange": F.lit("unknown"), "price": F.lit(0.0), "volume": F.lit(0.0), "quality_score": F.lit(1.0), "issues": F.array().cast("array<string>")}
    return messages.withColumns({k: F.coalesce(k, v) for k, v in fill.items()})


def quarantine(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the table accepts, rows it refuses)."""
    return scored.filter(valid_row()), scored.filter(~valid_row())


def market_data(ticks: DataFrame, cfg: QualityConfig = DEFAULT) -> DataFrame:
    return quarantine(score(ticks, cfg))[0]
