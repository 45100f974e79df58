"""Tick payloads: JSON (or msgpack) messages to columns, malformed ones marked."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Everything is read as text first, so that numbers sent as strings are numbers too.
_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in ("symbol", "price", "volume", "exchange", "timestamp", "_bad")])


def epoch_ms(text: Column) -> Column:
    """Epoch milliseconds from an integer or an ISO-8601 text."""
    iso = F.unix_millis(F.try_to_timestamp(text))
    return F.coalesce(text.try_cast("bigint"), F.floor(text.try_cast("double")).cast("bigint"), iso)


def parse_ticks(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds symbol, price, volume, exchange, ts_ms and parse_error.

    A payload that is no JSON object, lacks a field, or holds one of the wrong kind is a parse error; so is
    a null exchange and a missing timestamp. Negative, zero and NaN numbers are values.
    """
    d = messages.withColumn("_m", F.from_json(value, _FIELDS, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    get = lambda n: F.col(f"_m.{n}")
    price, volume, ts = get("price").try_cast("double"), get("volume").try_cast("double"), epoch_ms(get("timestamp"))
    needed = [get("symbol"), price, volume, get("exchange"), ts]
    bad = F.col("_m").isNull() | get("_bad").isNotNull()
    for c in needed:
        bad = bad | c.isNull()
    bad = F.coalesce(bad, F.lit(True))
    ok = lambda c: F.when(~bad, c)
    return d.select(*messages.columns, ok(get("symbol")).alias("symbol"), ok(price).alias("price"), ok(volume).alias("volume"), ok(F.lower(get("exchange"))).alias("exchange"), ok(ts).alias("ts_ms"), bad.alias("parse_error"))


def decode_msgpack(messages: DataFrame, value: str = "value") -> DataFrame:
    """msgpack bodies as JSON text, in Arrow batches; a body that is no msgpack becomes an empty text, which no parser takes."""
    @F.pandas_udf("string")
    def decode(bodies: pd.Series) -> pd.Series:
        import json

        from tickloom.functions import msgpack

        def one(body: bytes | None) -> str | None:
            if body is None:
                return None
            try:
                return json.dumps(msgpack.unpack(bytes(body)))
            except (ValueError, TypeError, RecursionError):
                return ""

        return bodies.map(one)

    return messages.withColumn(value, decode(value))


def encode_msgpack(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON texts as msgpack bodies, in Arrow batches."""
    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        import json

        from tickloom.functions import msgpack

        return texts.map(lambda t: None if t is None else msgpack.pack(json.loads(t)))

    return messages.withColumn(value, encode(value))
