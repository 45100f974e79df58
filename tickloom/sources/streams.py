"""Stream sources and sinks: message log by Kafka protocol, files, and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

#: topic -> (partitions, days kept)
TOPICS = {"raw_market_data": (12, 7), "quality_scores": (6, 14), "causal_events": (3, 30), "features_computed": (6, 90)}


def kafka_options(servers: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Connection options, with SCRAM over SASL where a user is given."""
    out = {"kafka.bootstrap.servers": servers, "kafka.fetch.min.bytes": "1", "kafka.fetch.max.wait.ms": "100"}
    if user is not None:
        login = f'org.apache.kafka.common.security.scram.ScramLoginModule required username="{user}" password="{password}";'
        out |= {"kafka.security.protocol": "SASL_PLAINTEXT", "kafka.sasl.mechanism": "SCRAM-SHA-256", "kafka.sasl.jaas.config": login}
    return out


def read_kafka(spark: SparkSession, servers: str, topic: str = "raw_market_data", start: str = "earliest", flush: tuple[int, str] | None = None, **login: str) -> DataFrame:
    """Messages (value, seq) of a topic; needs the Kafka connector on the class path.

    ``seq`` orders the messages of a partition; a symbol must always go to one partition. ``flush`` (rows, age) holds a
    batch back until so many messages wait or the oldest has waited so long.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, **login), **flush_options(flush)).option("subscribe", topic).option("startingOffsets", start).load()
    return raw.selectExpr("cast(value AS string) AS value", "offset AS seq", "unix_millis(timestamp) AS now_ms")


def flush_options(flush: tuple[int, str] | None) -> dict[str, str]:
    """Source options of a flush by size or age."""
    return {} if flush is None else {"minOffsetsPerTrigger": str(flush[0]), "maxTriggerDelay": flush[1]}


def write_kafka(envelopes: DataFrame, servers: str, checkpoint: str, topic: str = "quality_scores", every: str = "60 seconds", **login: str) -> DataStreamWriter:
    return envelopes.writeStream.format("kafka").options(**kafka_options(servers, **login)).option("topic", topic).option("checkpointLocation", checkpoint).option("kafka.compression.type", "lz4").trigger(processingTime=every)


def read_files(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """A folder of files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)


def catalog(spark: SparkSession) -> DataFrame:
    """Tables known to the session."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, kind string, temporary boolean")


def progress_samples(progress: dict, running: bool = True) -> list[tuple[str, dict, int, float]]:
    """Samples (metric, labels, ts_ms, value) from one progress report of a streaming query, for the alert rules."""
    import datetime as dt

    at = int(dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00")).timestamp() * 1000)
    labels = {"query": progress.get("name") or progress["id"]}
    spent = progress.get("durationMs", {})
    sources = progress.get("sources", [])
    behind = [float((s.get("metrics") or {}).get("maxOffsetsBehindLatest") or 0.0) for s in sources]
    return [
        ("messages_processed_rate", labels, at, float(progress.get("processedRowsPerSecond") or 0.0)),
        ("stream_last_checkpoint_ms", labels, at, float(spent.get("walCommit", 0) + spent.get("commitOffsets", 0))),
        ("stream_running_jobs", labels, at, 1.0 if running else 0.0),
        ("consumergroup_lag", labels, at, max(behind, default=0.0)),
    ]


def query_samples(query, at_ms: int | None = None) -> list[tuple[str, dict, int, float]]:
    """Samples of a query as it is now: one that has failed or ended reports no running job, whatever its last progress said."""
    import json
    import time

    at = at_ms or int(time.time() * 1000)
    running = query.isActive and query.exception() is None
    last = query.lastProgress
    if last is None:
        return [("stream_running_jobs", {"query": query.name or query.id}, at, 1.0 if running else 0.0)]
    report = json.loads(last.json) if hasattr(last, "json") else last
    return [(m, k, at, v) for m, k, _, v in progress_samples(report, running)]
