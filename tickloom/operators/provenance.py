"""Provenance scoring: hashes, plausibility, timestamp consistency, agreement and verdicts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom.functions.columns import clamp, hash16


@dataclass(frozen=True)
class Rules:
    sigma: float = 3.0
    max_gap_s: float = 10.0
    jitter_s: float = 0.1
    reliability: float = 0.3
    timestamp: float = 0.2
    plausibility: float = 0.3
    cross: float = 0.2
    min_quality: float = 0.7
    stale_ms: int = 2000
    cross_required: bool = False


DEFAULT = Rules()
STEP = "array<struct<transform_type:string,timestamp_ms:bigint,parameters:map<string,string>>>"


def data_hash(value: Column) -> Column:
    """16 hex digits over source, time and value."""
    return hash16(F.col("source_id"), F.col("source_us").cast("string"), value)


def attach(records: DataFrame, source_type: str = "exchange") -> DataFrame:
    """Records with an empty transformation chain and default flags."""
    return records.withColumns({"source_type": F.lit(source_type), "transform_chain": F.array().cast(STEP), "is_validated": F.lit(False), "validation_errors": F.array().cast("array<string>")})


def add_step(records: DataFrame, kind: str, at_ms: int, **parameters: object) -> DataFrame:
    """Append a transformation to the chain of every record."""
    pairs = [F.lit(str(x)) for kv in parameters.items() for x in kv]
    params = F.create_map(*pairs) if pairs else F.expr("cast(map() AS map<string,string>)")
    step = F.struct(F.lit(kind).alias("transform_type"), F.lit(at_ms).cast("long").alias("timestamp_ms"), params.alias("parameters"))
    return records.withColumn("transform_chain", F.array_append("transform_chain", step))


def staleness(as_of_us: Column) -> Column:
    return (as_of_us - F.col("source_us")) / 1000.0


def reliability(records: DataFrame, sources: DataFrame | None) -> DataFrame:
    """Adds reliability from a source table (uptime_ratio, error_rate); unknown sources get 0.8."""
    if sources is None:
        return records.withColumn("reliability", F.lit(0.8))
    dim = sources.select("source_id", clamp(F.col("uptime_ratio") * 0.6 + (1 - F.col("error_rate")) * 0.4).alias("_r"))
    return records.join(dim, "source_id", "left").withColumn("reliability", F.coalesce("_r", F.lit(0.8))).drop("_r")


def plausibility(records: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Adds plausibility: the z-score band against the 100 values before, per symbol and data type."""
    w = Window.partitionBy("symbol", "data_type").orderBy("event_id").rowsBetween(-100, -1)
    d = records.withColumns({"_n": F.count("value").over(w), "_m": F.avg("value").over(w), "_s": F.stddev_samp("value").over(w)})
    flat = F.when(F.col("_m") != 0, F.abs("_m") * 0.01).otherwise(F.lit(1.0))
    z = F.abs(F.col("value") - F.col("_m")) / F.when(F.col("_s") < 1e-10, flat).otherwise(F.col("_s"))
    band = F.when(F.col("_n") < 10, 1.0).when(z <= rules.sigma, 1.0).when(z <= 2 * rules.sigma, 0.5).otherwise(0.0)
    return d.withColumn("plausibility", F.when(F.col("value").isNull(), 1.0).otherwise(band)).drop("_n", "_m", "_s")


def consistency(records: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Adds consistency against the last accepted time of the source; a missing time gives null and moves nothing.

    Only accepted times move the state, so no bounded frame says what it is. Rows are sorted by source and arrival within
    partitions and folded batch by batch; a task holds one batch and one time, however long a source's history is.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, last = None, None
        for batch in batches:
            out = []
            for name, t in zip(batch.column("source_id").to_pylist(), batch.column("source_us").to_pylist(), strict=True):
                if name != source:
                    source, last = name, None
                if t is None:
                    out.append(None)
                    continue
                delta = 0.0 if last is None else (t - last) / 1e6
                if delta < -rules.jitter_s:
                    out.append(0.0)
                elif delta > rules.max_gap_s:
                    out.append(1.0 - min(1.0, delta / (rules.max_gap_s * 5)))
                else:
                    last = t
                    out.append(1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "consistency"])

    dealt = records.repartition("source_id").sortWithinPartitions("source_id", "event_id")
    return dealt.mapInArrow(fold, T.StructType([*records.schema.fields, T.StructField("consistency", T.DoubleType())]))


def cross_source(records: DataFrame, width_us: int = 3_600_000) -> DataFrame:
    """Adds cross: agreement with the mean of other sources' values for the symbol in the same time bucket."""
    key = ["symbol", "data_type", F.floor(F.col("source_us") / width_us)]
    all_, own = Window.partitionBy(*key), Window.partitionBy(*key, "source_id")
    n = F.count("value").over(all_) - F.count("value").over(own)
    total = F.sum("value").over(all_) - F.sum("value").over(own)
    d = records.withColumns({"n_others": n, "others_mean": F.try_divide(total, n)})
    off = F.when(F.col("others_mean") == 0, 0.0).otherwise(F.abs(F.col("value") - F.col("others_mean")) / F.abs("others_mean"))
    return d.withColumn("cross", F.when((F.col("n_others") == 0) | F.col("value").isNull(), 1.0).otherwise(F.greatest(F.lit(0.0), 1 - off * 10)))


def total_score(rules: Rules = DEFAULT) -> Column:
    parts = (("reliability", rules.reliability), ("consistency", rules.timestamp), ("plausibility", rules.plausibility), ("cross", rules.cross))
    return clamp(sum((F.col(c) * w for c, w in parts), F.lit(0.0)))


def validate(records: DataFrame, sources: DataFrame | None = None, rules: Rules = DEFAULT) -> DataFrame:
    """Verdicts: reject_reason (null when accepted) and quality (null for stale records).

    Stale records are turned away before scoring and leave no trace in the state of later ones.
    """
    stale = F.col("staleness_ms") > rules.stale_ms
    fresh = cross_source(plausibility(consistency(reliability(records.filter(~stale), sources), rules), rules)).withColumn("quality", total_score(rules))
    reason = F.when(F.col("quality") < rules.min_quality, "quality_too_low")
    if rules.cross_required:
        reason = reason.when(F.col("n_others") == 0, "cross_source_missing")
    judged = fresh.select("event_id", "source_id", "quality", reason.alias("reject_reason"))
    gone = records.filter(stale).select("event_id", "source_id", F.lit(None).cast("double").alias("quality"), F.lit("staleness_exceeded").alias("reject_reason"))
    return judged.unionByName(gone)


def stats(verdicts: DataFrame) -> DataFrame:
    """One row: totals, accept rate (0 when empty) and the count of each reason as a map."""
    n = verdicts.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    ok = F.coalesce(F.sum(F.when(F.col("reject_reason").isNull(), F.col("n"))), F.lit(0))
    all_ = F.coalesce(F.sum("n"), F.lit(0))
    reasons = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("reject_reason").isNotNull(), F.struct("reject_reason", "n")))))
    return n.agg(all_.alias("total_received"), ok.alias("total_accepted"), (all_ - ok).alias("total_rejected"), F.coalesce(F.try_divide(ok, all_), F.lit(0.0)).alias("accept_rate"), reasons.alias("rejection_reasons"))


def to_json(records: DataFrame) -> DataFrame:
    """Serialized record: its thirteen fields (identity, times in ISO form, chain, scores, hash and flags) in one JSON column.

    Columns that ``records`` lacks have the defaults of a fresh record.
    """
    iso = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    have = lambda c, default: F.col(c) if c in records.columns else default
    body = F.struct(
        "source_id",
        have("source_type", F.lit("exchange")).alias("source_type"),
        iso("source_us").alias("source_timestamp"),
        iso("receive_us" if "receive_us" in records.columns else "source_us").alias("receive_timestamp"),
        have("data_type", F.lit("price")).alias("data_type"),
        have("symbol", F.lit("")).alias("symbol"),
        have("value", F.lit(None).cast("double")).alias("value"),
        have("transform_chain", F.array().cast(STEP)).alias("transform_chain"),
        have("quality_score", F.lit(1.0)).alias("quality_score"),
        have("staleness_ms", F.lit(0.0)).alias("staleness_ms"),
        have("data_hash", data_hash(have("value", F.lit("")).cast("string"))).alias("data_hash"),
        have("is_validated", F.lit(False)).alias("is_validated"),
        have("validation_errors", F.array().cast("array<string>")).alias("validation_errors"),
    )
    return records.select("event_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("record"))
