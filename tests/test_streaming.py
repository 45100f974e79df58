"""Streams give what the batch operators give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality as q
from tickloom.sources import fixtures as fx
from tickloom.sources import streams
from tickloom.sources.parse import parse_ticks
from tickloom.streaming import scorer

from .conftest import DATA

MESSAGES = "event_id bigint, seq bigint, now_ms bigint, value string"


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """The fixture's payloads as three files in arrival order."""
    path = tmp_path_factory.mktemp("messages")
    raw = fx.raw_messages(spark, DATA).filter("event_id < 200").cache()
    cuts = [0, 150, 10_000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        raw.filter((F.col("seq") >= a) & (F.col("seq") < b)).coalesce(1).write.mode("append").parquet(f"{path}/part={i}")
    scorer.configure(spark, replay=True)
    return raw, str(path)


def run(stream, tmp_path, sink=None, name="out"):
    w = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    w = w.foreachBatch(sink) if sink else w.format("memory").queryName(name).outputMode("append")
    query = w.start()
    assert query.awaitTermination(180)
    return query


def test_stream_equals_batch(spark, messages, tmp_path):
    raw, path = messages
    stream = streams.read_files(spark, f"{path}/part=*", MESSAGES, per_trigger=1)
    query = run(scorer.score_stream(parse_ticks(stream)), tmp_path, name="scored_stream")
    cols = ["seq", "symbol", "quality_score", F.array_join("issues", ",").alias("issues")]
    got = {tuple(r) for r in spark.table("scored_stream").select(*cols).collect()}
    want = {tuple(r) for r in q.score_parsed(parse_ticks(raw)).select(*cols).collect()}
    assert got == want
    samples = streams.progress_samples(__import__("json").loads(query.lastProgress.json))
    assert {m for m, *_ in samples} == {"messages_processed_rate", "stream_last_checkpoint_ms", "stream_running_jobs", "consumergroup_lag"}
    assert {v for m, _, _, v in streams.query_samples(query) if m == "stream_running_jobs"} == {0.0}


def test_state_expires(spark, tmp_path):
    """A symbol that was silent for longer than the time to live starts anew."""
    import time

    scorer.configure(spark, replay=True)
    body = '{{"symbol":"A","price":{},"volume":1,"exchange":"kraken","timestamp":{}}}'
    feed = tmp_path / "feed"

    def step(n, price, ts, ttl_ms):
        spark.createDataFrame([(n, n, 0, body.format(price, ts))], MESSAGES).coalesce(1).write.parquet(str(feed / f"n={n}"))
        stream = streams.read_files(spark, str(feed / "n=*"), MESSAGES, per_trigger=1)
        run(scorer.score_stream(parse_ticks(stream), ttl_ms=ttl_ms), tmp_path, lambda df, i: df.select("seq", "issues").coalesce(1).write.mode("append").parquet(str(tmp_path / "out")))

    step(1, 100, 5, 1500)
    time.sleep(3)
    step(2, 150, 5, 1500)
    got = {r["seq"]: set(r["issues"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert not {"DUPLICATE_TIMESTAMP", "EXTREME_PRICE_MOVE"} & got[2]


def test_a_failed_query_reports_no_running_job(spark, messages, tmp_path):
    """It is started again from its checkpoint, and then its samples say that nothing runs."""
    from pyspark.errors import StreamingQueryException

    _, path = messages
    started = []

    def fail(batch, batch_id):
        raise ValueError("no sink")

    def start():
        stream = streams.read_files(spark, f"{path}/part=*", MESSAGES, per_trigger=1)
        started.append(stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).foreachBatch(fail).start())
        return started[-1]

    with pytest.raises(StreamingQueryException):
        scorer.run_with_restarts(start, attempts=1, wait_s=0.1)
    assert len(started) == 2 and ("stream_running_jobs", 0.0) in [(m, v) for m, _, _, v in streams.query_samples(started[-1])]


def test_sinks_repeat_safely(spark, messages, tmp_path):
    raw, _ = messages
    scored = q.score_parsed(parse_ticks(raw)).join(raw.select("seq", "now_ms"), "seq")
    ticks = parse_ticks(raw).select("seq", "price", "volume", "exchange")
    batch = scored.join(ticks, "seq")
    write = scorer.store_writer(str(tmp_path / "store"))
    write(batch, 0)
    write(batch, 0)
    ok = spark.read.parquet(f"{tmp_path}/store/market_data").count()
    bad = spark.read.parquet(f"{tmp_path}/store/quarantine").count()
    assert ok + bad == batch.count() and ok == batch.filter(q.valid_row()).count()
    latest = scorer.latest_writer(str(tmp_path / "latest"))
    latest(batch.filter("seq < 200"), 0)
    latest(batch.filter("seq >= 200"), 1)
    latest(batch.filter("seq >= 200"), 1)
    got = {r["symbol"]: r["seq"] for r in spark.read.parquet(f"{tmp_path}/latest/version=1").collect()}
    want = {r["symbol"]: r["m"] for r in batch.filter("symbol <> 'ERROR'").groupBy("symbol").agg(F.max("seq").alias("m")).collect()}
    assert got == want


def test_history_and_expiry(spark, messages, tmp_path):
    """Three batches, one of them twice, leave the newest members; rows that expired are not in the latest view."""
    raw, _ = messages
    scored = q.score_parsed(parse_ticks(raw)).join(parse_ticks(raw).select("seq", "price", "volume", "exchange"), "seq").filter("symbol <> 'ERROR'").cache()
    write = scorer.history_writer(str(tmp_path / "history"), keep=5)
    cuts = [0, 100, 200, 10_000]
    for batch in (0, 1, 1, 2):
        write(scored.filter(F.col("seq").between(cuts[batch], cuts[batch + 1] - 1)), batch)
    from tickloom.operators import features

    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/history/version=2").select("symbol", "ts_ms", "member").collect()}
    want = {tuple(r) for r in features.history(features.member_json(scored), 5).select("symbol", "ts_ms", "member").collect()}
    assert got == want and not (tmp_path / "history" / "version=0").exists()
    newest = scored.agg(F.max("ts_ms")).first()[0]
    latest = scorer.latest_writer(str(tmp_path / "latest"), now_ms=lambda: newest + features.TTL_MS - 1)
    latest(scored, 0)
    alive = spark.read.parquet(f"{tmp_path}/latest/version=0")
    assert {r["ts_ms"] for r in alive.collect()} == {newest}


def test_refreshes_keep_the_rest(spark, tmp_path):
    """Bars refreshed at 6 to 12 hours equal those from raw data, also after a refresh that finds a bucket empty."""
    from tickloom.operators import ohlcv
    from tickloom.streaming.scorer import refresh_bars

    H = ohlcv.HOUR
    d = spark.range(0, 13 * 60, 7).select((F.col("id") * 60_000).alias("ts_ms"), F.col("id").alias("seq"), F.lit("A").alias("symbol"), F.lit("x").alias("exchange"), (100 + F.col("id") % 17).cast("double").alias("price"), F.lit(2.0).alias("volume"))
    path = str(tmp_path / "bars")
    for at in (6 * H, 15 * H // 2, 9 * H, 21 * H // 2, 12 * H, 12 * H):
        refresh_bars(d, "ohlcv_5min", at, path)
    cols = ["bucket_ms", "open", "close", "trade_count"]
    rows = lambda x: sorted(map(tuple, x.select(*cols).collect()))
    want = ohlcv.ohlcv(d).filter((F.col("bucket_ms") >= 4 * H) & (F.col("bucket_ms") < 12 * H - 300_000))
    assert rows(spark.read.parquet(path)) == rows(want)
    refresh_bars(d.filter("ts_ms < 0"), "ohlcv_5min", 12 * H, path)
    assert rows(spark.read.parquet(path)) == rows(want.filter(F.col("bucket_ms") < 10 * H))


def test_retry_and_dispatch(spark):
    seen = []
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "kind string, n int")
    take = lambda name: lambda df, i: seen.append((name, i, sorted(r["n"] for r in df.collect())))
    scorer.dispatch("kind", {"a": take("a"), "b": take("b")}, take("rest"))(batch, 7)
    assert seen == [("a", 7, [1]), ("b", 7, [2]), ("rest", 7, [3, 4])]
    tries = []

    def flaky(df, i):
        tries.append(i)
        if len(tries) < 3:
            raise OSError("store away")

    scorer.with_retry(flaky, attempts=3, wait_s=0.01)(batch, 1)
    assert len(tries) == 3
    with pytest.raises(OSError):
        scorer.with_retry(lambda df, i: (_ for _ in ()).throw(OSError()), attempts=2, wait_s=0.01)(batch, 1)


def test_graph_sink(spark, tmp_path):
    """A stream of causal events in three batches becomes node and edge tables; a repeated batch changes nothing."""
    from tickloom.operators import graph
    from tickloom.streaming import graph as sink

    names = [c.split(" ")[0] for c in sink.EVENTS.split(", ")]
    make = lambda *rows: spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], sink.EVENTS)
    feed = [
        make({"seq": 1, "event_type": "cascade", "id": 1, "ts_ms": 5, "severity": 0.5, "origin_exchange": "kraken", "affected_pairs": ["BTC/USDT", "NONE"]}, {"seq": 2, "type": "whale_transfer", "id": 9, "asset": "BTC", "from_exchange": "binance", "to_exchange": "nowhere"}),
        make({"seq": 3, "event_type": "cascade", "id": 1, "ts_ms": 6, "severity": 0.9, "origin_exchange": "kraken", "affected_pairs": ["ETH/USDT"]}, {"seq": 4, "event_type": "price_movement", "id": 20, "symbol": "SOL/USDT", "exchange": "bybit"}, {"seq": 5, "id": 30, "symbol": "BTC", "quality_score": 0.2}),
        make({"seq": 6, "id": 31, "symbol": "ETH", "quality_score": 0.9}, {"seq": 7, "event_type": "price_movement", "id": 21, "symbol": "none", "exchange": "bybit"}),
    ]
    for k, part in enumerate(feed):
        part.coalesce(1).write.parquet(f"{tmp_path}/events/n={k}")
    stream = streams.read_files(spark, f"{tmp_path}/events/n=*", sink.EVENTS, per_trigger=1)
    write = sink.graph_writer(str(tmp_path / "graph"), graph.seed(spark))
    run(stream, tmp_path, write)
    write(feed[2], 2)
    read = lambda t: spark.read.parquet(f"{tmp_path}/graph/{t}")
    assert [(r["id"], r["severity"]) for r in read("cascade/version=2").collect()] == [(1, 0.9)]
    assert sorted(r["id"] for r in read("price_movement").collect()) == [20, 21] and sorted(r["id"] for r in read("quality").collect()) == [30, 31]
    assert sorted(map(tuple, read("edges/version=2").collect())) == [("AFFECTED", 1, "BTC/USDT"), ("AFFECTED", 1, "ETH/USDT"), ("FROM_EXCHANGE", 9, "binance"), ("LOW_QUALITY_ON", 30, "BTC/USDT"), ("ON_EXCHANGE", 20, "bybit"), ("ON_PAIR", 20, "SOL/USDT"), ("ORIGINATED", 1, "kraken"), ("TRANSFERRED", 9, "BTC")]


def test_bars_stream_plan(spark, messages, tmp_path):
    _, path = messages
    stream = streams.read_files(spark, f"{path}/part=*", MESSAGES, per_trigger=1)
    scored = parse_ticks(stream).filter("NOT parse_error").withColumn("quality_score", F.lit(1.0))
    run(scorer.bars_stream(scored), tmp_path, name="bars_stream")
    from tickloom.operators import ohlcv

    rows = lambda d, at: {(r[at], r["symbol"], r["exchange"], r["open"], r["close"], r["trade_count"]) for r in d.collect()}
    got = rows(spark.table("bars_stream").withColumn("bucket_ms", F.unix_millis("window.start")), "bucket_ms")
    raw, _ = messages
    want = rows(ohlcv.ohlcv(parse_ticks(raw).filter("NOT parse_error").withColumn("quality_score", F.lit(1.0)).filter(q.valid_row())), "bucket_ms")
    assert got and got <= want


def test_kafka_options():
    o = streams.kafka_options("h:9092", "u", "p")
    assert o["kafka.sasl.mechanism"] == "SCRAM-SHA-256" and "u" in o["kafka.sasl.jaas.config"]
    assert "kafka.sasl.mechanism" not in streams.kafka_options("h:9092")
    assert streams.flush_options((100, "50ms")) == {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "50ms"} and streams.flush_options(None) == {}


def test_switch_escalates_and_halts(spark, tmp_path):
    """One beat, then silence: timers count misses until the halt; a later beat is ignored until acknowledged."""
    import time

    from tickloom.streaming import heartbeats

    scorer.configure(spark)
    schema = "strategy_id string, ts_ms bigint, kind string, positions_hash string"
    feed = tmp_path / "beats"

    def send(i, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(str(feed / f"n={i}"))

    send(0, ("s", 1, "beat", "h"))
    stream = streams.read_files(spark, str(feed / "n=*"), schema, per_trigger=1)
    query = heartbeats.watch(stream, 200).writeStream.option("checkpointLocation", str(tmp_path / "cp")).format("memory").queryName("switch").outputMode("append").start()

    def wait(kind, level):
        end = time.time() + 120
        while time.time() < end:
            if spark.table("switch").filter(f"kind = '{kind}' AND level = '{level}'").count():
                return True
            time.sleep(0.5)
        return False

    try:
        assert wait("escalated", "HALTED")
        levels = [r["level"] for r in spark.table("switch").filter("kind = 'escalated'").orderBy("missed").collect()]
        assert levels == ["WARNING", "ALERT", "CANCEL_ALL", "CANCEL_ALL", "HALTED"]
        send(1, ("s", 2, "beat", "h"))
        assert wait("ignored", "HALTED")
        send(2, ("s", 3, "ack", None))
        assert wait("acknowledged", "NORMAL")
    finally:
        query.stop()
