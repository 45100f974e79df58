"""Three-timestamp latency analytics: detectors per source, metrics and text export."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.columns import nearest_rank, ranked

SAMPLES, RECENT, CALIBRATION, SHORT = 1000, 100, 100, 50
#: Ranks of a source that one task works on, besides the ``SAMPLES`` before them.
BLOCK = 4096


def latencies(ticks: DataFrame) -> DataFrame:
    """network_ms, processing_ms and total_ms from the three timestamps in microseconds."""
    gap = lambda a, b: (F.col(a) - F.col(b)) / 1000.0
    return ticks.withColumns({"network_ms": gap("receive_us", "exchange_us"), "processing_ms": gap("process_us", "receive_us"), "total_ms": gap("process_us", "exchange_us")})


def _anomaly(kind: str, when: Column, severity: Column, value: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("anomaly"), severity.alias("severity"), value.alias("value")))


def with_state(ticks: DataFrame, samples: int = SAMPLES, block_ranks: int = BLOCK) -> DataFrame:
    """Columns that the detectors read, by source in arrival order.

    Nothing looks back more than ``samples`` ranks (100 at least), so a source's ticks are dealt out in blocks of ``block_ranks``
    ranks, each with the ranks before it that it looks at, and rolling medians, counts and previous values come from one pandas pass per block. The baseline is the
    median of a source's first ticks.
    """
    d = ranked(latencies(ticks), "source_id", "event_id", "n")
    halo = max(samples, RECENT)
    block_ranks = max(block_ranks, halo)
    block = F.floor((F.col("n") - 1) / block_ranks)
    near_end = F.pmod(F.col("n") - 1, F.lit(block_ranks)) >= block_ranks - halo
    dealt = d.select("source_id", "n", "exchange_us", "receive_us", "network_ms", F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))).alias("block"))
    rolled = dealt.groupBy("source_id", "block").applyInPandas(_rolled(samples, block_ranks), "source_id string, n bigint, last_exchange_us bigint, bunched int, n_recent int, median_ms double, short_ms double")
    early = d.filter(F.col("n") <= CALIBRATION).groupBy("source_id").agg(F.percentile("network_ms", 0.5).alias("base_ms"), F.count(F.lit(1)).alias("_c"))
    early = early.select("source_id", F.when(F.col("_c") == CALIBRATION, F.col("base_ms")).alias("base_ms"))
    return d.join(rolled, ["source_id", "n"]).join(early, "source_id", "left")


def _rolled(samples: int, block_ranks: int):
    def roll(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n", ignore_index=True)
        x, received = pdf["network_ms"], pdf["receive_us"].to_numpy()
        padded = np.concatenate((np.full(RECENT, np.iinfo(np.int64).min), received))
        before = np.lib.stride_tricks.sliding_window_view(padded, RECENT)[: len(pdf)]
        out = pd.DataFrame({
            "source_id": pdf["source_id"],
            "n": pdf["n"],
            "last_exchange_us": pdf["exchange_us"].astype("Int64").shift(1),
            "bunched": (before > received[:, None] - 1000).sum(1),
            "n_recent": np.minimum(pdf["n"] - 1, RECENT),
            "median_ms": x.rolling(samples, min_periods=1).median(),
            "short_ms": x.rolling(SHORT, min_periods=1).median(),
        })
        return out[(pdf["n"] - 1) // block_ranks == key[1]]

    return roll


def regression() -> Column:
    back = (F.col("exchange_us") - F.col("last_exchange_us")) / 1000.0
    return _anomaly("TIMESTAMP_REGRESSION", back < -10, F.least(F.lit(1.0), F.abs(back) / 1000), back)


def spike() -> Column:
    limit = F.col("median_ms") * 3
    over = F.try_divide(F.col("network_ms") - limit, limit)
    return _anomaly("LATENCY_SPIKE", (F.col("n") >= 50) & (F.col("network_ms") > limit) & (F.col("network_ms") > 50), F.least(F.lit(1.0), F.coalesce(over, F.lit(1.0))), F.col("network_ms"))


def bunching() -> Column:
    return _anomaly("DATA_BUNCHING", (F.col("n_recent") >= 10) & (F.col("bunched") >= 10), F.least(F.lit(1.0), F.col("bunched") / 30.0), F.col("bunched").cast("double"))


def drift() -> Column:
    off = F.col("short_ms") - F.col("base_ms")
    return _anomaly("CLOCK_DRIFT", (F.col("n") >= CALIBRATION) & (F.abs(off) > 100), F.least(F.lit(1.0), F.abs(off) / 300), off)


def detect(state: DataFrame, *detectors: Column) -> DataFrame:
    """One row per anomaly; without ``detectors`` all four, in their order."""
    found = F.array_compact(F.array(*(detectors or (regression(), spike(), bunching(), drift()))))
    return state.select("event_id", "source_id", "symbol", F.explode(found).alias("a")).select("event_id", "source_id", "symbol", "a.*")


def to_json(ticks: DataFrame) -> DataFrame:
    """Serialized triangulated timestamps: the three instants in ISO form, the source, the symbol and the latencies."""
    iso = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(iso("exchange_us").alias("t_exchange"), iso("receive_us").alias("t_receive"), iso("process_us").alias("t_process"), "source_id", "symbol", F.col("network_ms").alias("network_latency_ms"), F.col("processing_ms").alias("processing_latency_ms"), F.col("total_ms").alias("total_latency_ms"))
    return latencies(ticks).select("event_id", F.to_json(body).alias("record"))


def metrics(ticks: DataFrame) -> DataFrame:
    """Sample count, medians and nearest-rank p99 over each source's last 1000 ticks."""
    newest = Window.partitionBy("source_id").orderBy(F.desc("event_id"))
    last = latencies(ticks).withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= SAMPLES)
    agg = last.groupBy("source_id").agg(F.count(F.lit(1)).alias("sample_count"), F.percentile("network_ms", 0.5).alias("network_median_ms"), F.collect_list("network_ms").alias("all"), F.percentile("processing_ms", 0.5).alias("processing_median_ms"))
    p99 = F.when(F.col("sample_count") < 10, F.col("network_median_ms")).otherwise(nearest_rank(F.col("all"), 0.99))
    return agg.select("source_id", "sample_count", "network_median_ms", p99.alias("network_p99_ms"), "processing_median_ms")


def prometheus_lines(summary: DataFrame, prefix: str = "tickloom") -> DataFrame:
    """Three text-exposition lines per source."""
    gauges = (("network_latency_median_ms", "network_median_ms"), ("network_latency_p99_ms", "network_p99_ms"), ("processing_latency_median_ms", "processing_median_ms"))
    lines = F.array(*[F.format_string(f'{prefix}_{name}{{source="%s"}} %.2f', "source_id", c) for name, c in gauges])
    return summary.select(F.explode(lines).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.orderBy("line").coalesce(1).write.mode("overwrite").text(path)
