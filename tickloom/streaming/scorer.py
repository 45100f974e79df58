"""Streaming scorer: one keyed processor per symbol, and the sinks that its output feeds."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from datetime import UTC, datetime

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.config import PARSE_ERROR, QualityConfig
from tickloom.operators import features, ohlcv
from tickloom.operators import quality as q
from tickloom.sources import tables

TTL_MS = 86_400_000
STATE = T.StructType([T.StructField("last_ts", T.LongType()), T.StructField("last_price", T.DoubleType()), T.StructField("price_ema", T.DoubleType()), T.StructField("volume_ema", T.DoubleType())])
CARRIED = "symbol string, seq bigint, ts_ms bigint, now_ms bigint, price double, volume double, exchange string"
SCORED = CARRIED + ", last_ts bigint, last_price double, price_ema double, volume_ema double, volume_ref double"


def configure(spark: SparkSession, replay: bool = False) -> None:
    """Session settings that the stateful operators need: RocksDB state with changelog checkpoints.

    ``replay``: the stream ends with its input (availableNow). Expiry by processing time would otherwise ask for
    another batch forever; without batches that bring no data, the query stops after the last one that does.
    """
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not replay).lower())
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class TickState(StatefulProcessor):
    """Adds to each tick what its symbol's state held, in arrival order, and moves the state on.

    The checks themselves are the batch scorer's columns; only the recursion lives here. State expires
    ``ttl_ms`` after its last write, and every tick writes it.
    """

    def __init__(self, alpha: float = 0.1, ttl_ms: int = TTL_MS):
        self.alpha, self.ttl_ms = alpha, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("tick", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.state.get()) if self.state.exists() else (None, None, None, None)
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        out = []
        for r in batch.itertuples(index=False):
            last_ts, last_price, pe, ve = held
            new_pe = r.price if pe is None else self.alpha * r.price + (1 - self.alpha) * pe
            new_ve = r.volume if ve is None else self.alpha * r.volume + (1 - self.alpha) * ve
            out.append((key[0], r.seq, r.ts_ms, r.now_ms, r.price, r.volume, r.exchange, last_ts, last_price, new_pe, new_ve, ve))
            held = (int(r.ts_ms), float(r.price), float(new_pe), float(new_ve))
        self.state.update(held)
        names = [c.split()[0] for c in SCORED.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        for c in ("last_ts",):
            frame[c] = frame[c].astype("Int64")
        yield frame

    def close(self) -> None:
        pass


def score_stream(parsed: DataFrame, cfg: QualityConfig = q.DEFAULT, ttl_ms: int = TTL_MS) -> DataFrame:
    """Scored ticks of a parsed stream; failed payloads come out as PARSE_ERROR rows and touch no state.

    There is no watermark: late ticks are flagged, never dropped.
    """
    good = parsed.filter("NOT parse_error").select(*[c.split()[0] for c in CARRIED.split(", ")])
    stateful = good.groupBy("symbol").transformWithStateInPandas(TickState(cfg.ema_alpha, ttl_ms), outputStructType=SCORED, outputMode="Append", timeMode="ProcessingTime")
    scored = stateful.withColumn("issues", q.issue_list(cfg))
    cols = ["symbol", "seq", "ts_ms", "now_ms", "price", "volume", "exchange"]
    scored = scored.select(*cols, q.score_of(F.col("issues"), cfg).alias("quality_score"), "issues", F.size("issues").alias("issue_count"))
    none = lambda t: F.lit(None).cast(t)
    bad = parsed.filter("parse_error").select(F.lit("ERROR").alias("symbol"), "seq", F.lit(0).cast("long").alias("ts_ms"), "now_ms", none("double").alias("price"), none("double").alias("volume"), none("string").alias("exchange"), F.lit(0.0).alias("quality_score"), F.array(F.lit(PARSE_ERROR)).alias("issues"), F.lit(1).alias("issue_count"))
    return scored.unionByName(bad)


def bars_stream(scored: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Tumbling bars with a watermark, for append or update mode."""
    d = scored.filter(q.valid_row()).withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", late)
    at = F.struct("ts_ms", "seq")
    return d.groupBy(F.window("ts", width), "symbol", "exchange").agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("trade_count"))


def store_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of the time-series table: valid rows by day, the others to quarantine.

    Each micro-batch owns a folder named by its id and overwrites it, so a batch that runs again leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        ok, bad = q.quarantine(kept)
        day = F.to_date(F.timestamp_millis("ts_ms"))
        ok.withColumn("date", day).write.mode("overwrite").partitionBy("date").parquet(f"{path}/market_data/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{path}/quarantine/batch={batch_id}")
        kept.unpersist()

    return write


def _merged(path: str, batch_id: int, fresh: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], empty: str | None = None) -> None:
    """Write version ``batch_id`` of a merged view from the version before it, and drop the versions before that one.

    Versions are named by batch id, so a repeated batch rewrites its own version from the same predecessor.
    """
    spark = fresh.sparkSession
    before = f"{path}/version={batch_id - 1}"
    if tables.exists(spark, before):
        fresh = merge(spark.read.parquet(before), fresh)
    fresh.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
    tables.delete(spark, f"{path}/version={batch_id - 2}")


def latest_writer(path: str, now_ms: Callable[[], int] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of the latest-per-symbol view. ``now_ms``: a clock; rows that expired by then are left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = features.latest(features.member_json(batch.filter("symbol <> 'ERROR'")))
        alive = (lambda d: features.live(d, now_ms())) if now_ms else (lambda d: d)
        _merged(path, batch_id, alive(fresh), lambda old, new: alive(features.upsert_latest(old, new)))

    return write


def history_writer(path: str, keep: int = features.HISTORY) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink of the per-symbol history: equal members once, the newest ``keep`` stay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = features.member_json(batch.filter("symbol <> 'ERROR'"))
        fresh = features.upsert_history(rows.filter("false"), rows, keep)
        _merged(path, batch_id, fresh, lambda old, new: features.upsert_history(old, new, keep))

    return write


def with_retry(write: Callable[[DataFrame, int], None], attempts: int = 5, wait_s: float = 1.0) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that is tried again, each time after twice the wait; the last failure ends the query, which restarts from its checkpoint."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for k in range(attempts):
            try:
                return write(batch, batch_id)
            except Exception:
                if k + 1 == attempts:
                    raise
                time.sleep(wait_s * 2**k)

    return run


def dispatch(column: str, handlers: Mapping[str, Callable[[DataFrame, int], None]], other: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch outlet of a stream of anomalies, escalations or events: each handler gets the rows of its kind, ``other`` the rest."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        for kind, handle in handlers.items():
            handle(kept.filter(F.col(column) == kind), batch_id)
        if other is not None:
            other(kept.filter(~F.coalesce(F.col(column).isin(*handlers), F.lit(False))), batch_id)
        kept.unpersist()

    return write


def run_with_restarts(start: Callable[[], StreamingQuery], attempts: int = 5, wait_s: float = 30.0) -> StreamingQuery:
    """Start a query and wait for its end; a failed one is started again from its checkpoint, up to ``attempts`` times with a fixed delay."""
    for k in range(attempts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if k == attempts:
                raise
            time.sleep(wait_s)
    return query


def refresh_bars(data: DataFrame, name: str, as_of_ms: int, path: str) -> None:
    """Recompute the aggregate's refresh window in the table at ``path``; every bucket outside the window stays as it is."""
    spark = data.sparkSession
    lo, hi = ohlcv.refresh_bounds(name, as_of_ms)
    day = F.to_date(F.timestamp_millis("bucket_ms"))
    fresh = ohlcv.refresh_window(data, name, as_of_ms).withColumn("date", day)
    days = [str(datetime.fromtimestamp(d * 86_400, UTC).date()) for d in range(lo // ohlcv.DAY, (hi - 1) // ohlcv.DAY + 1)]
    keep = None
    if tables.exists(spark, path):
        old = spark.read.schema(fresh.schema).parquet(path)
        keep = old.filter(F.col("date").isin(*[datetime.strptime(d, "%Y-%m-%d").date() for d in days]) & ~((F.col("bucket_ms") >= lo) & (F.col("bucket_ms") < hi)))
    tables.replace_days(fresh, keep, days, path)
