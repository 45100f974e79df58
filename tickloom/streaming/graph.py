"""Streaming graph sink: causal events to node and edge tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import graph as g
from tickloom.sources import tables

#: Columns of the event stream that each kind of node keeps; events of other kinds leave them null.
NODES = {
    "cascade": ("id", "ts_ms", "severity", "spread_velocity", "max_drawdown", "origin_exchange", "affected_pairs"),
    "whale_transfer": ("id", "ts_ms", "amount", "amount_usd", "asset", "from_exchange", "to_exchange"),
    "price_movement": ("id", "ts_ms", "symbol", "exchange", "price_change_pct"),
    "quality": ("id", "ts_ms", "symbol", "quality_score", "issues"),
}
EVENTS = (
    "seq bigint, event_type string, type string, id bigint, ts_ms bigint, severity double, spread_velocity double, max_drawdown double, origin_exchange string, affected_pairs array<string>, "
    "amount double, amount_usd double, asset string, from_exchange string, to_exchange string, symbol string, exchange string, price_change_pct double, quality_score double, issues array<string>"
)


def edges_of(parts: dict[str, DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """All edges (kind, src, dst) that the routed events make with the known exchanges, pairs and assets."""
    origin, hit = g.cascade_edges(parts["cascade"], dims["exchange"], dims["pair"])
    whale = g.whale_edges(parts["whale_transfer"].withColumnRenamed("id", "tx_id"), dims["asset"], dims["exchange"])
    on, at = g.move_edges(parts["price_movement"], dims["pair"], dims["exchange"])
    low = g.low_quality_edges(parts["quality"].withColumnRenamed("id", "event_id"), dims["pair"])
    made = [
        ("ORIGINATED", origin, "cascade_id", "exchange"),
        ("AFFECTED", hit, "cascade_id", "pair"),
        ("TRANSFERRED", whale["transferred"], "tx_id", "dst"),
        ("FROM_EXCHANGE", whale["from_exchange"], "tx_id", "dst"),
        ("TO_EXCHANGE", whale["to_exchange"], "tx_id", "dst"),
        ("ON_PAIR", on, "id", "symbol"),
        ("ON_EXCHANGE", at, "id", "exchange"),
        ("LOW_QUALITY_ON", low, "event_id", "pair"),
    ]
    out = None
    for kind, d, src, dst in made:
        part = d.select(F.lit(kind).alias("kind"), F.col(src).alias("src"), F.col(dst).alias("dst"))
        out = part if out is None else out.unionByName(part)
    return out


def graph_writer(path: str, dims: dict[str, DataFrame]) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: routes a batch of ``EVENTS``, merges cascades and transfers by id, appends moves and quality events, and merges edges.

    A merged table has a version per batch, made from the one before; an appended one has a folder per batch. Both are
    named by batch id, so a batch that runs again leaves the same tables.
    """

    def merged(name: str, fresh: DataFrame, batch_id: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        spark, before = fresh.sparkSession, f"{path}/{name}/version={batch_id - 1}"
        if tables.exists(spark, before):
            fresh = merge(spark.read.parquet(before), fresh)
        fresh.write.mode("overwrite").parquet(f"{path}/{name}/version={batch_id}")
        tables.delete(spark, f"{path}/{name}/version={batch_id - 2}")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        parts = g.routed(kept)
        nodes = {k: parts[k].select("seq", *NODES[k]) for k in NODES}
        for k in ("cascade", "whale_transfer"):
            newest = g.upsert_nodes(nodes[k].filter("false"), nodes[k], "id", "seq")
            merged(k, newest, batch_id, lambda old, new: g.upsert_nodes(old, new, "id", "seq"))
        for k in ("price_movement", "quality"):
            nodes[k].write.mode("overwrite").parquet(f"{path}/{k}/batch={batch_id}")
        merged("edges", edges_of(parts, dims).distinct(), batch_id, g.upsert_edges)
        kept.unpersist()

    return write
