"""Dead-man's switch in closed form: missed checks, escalation and the state at any instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TIMEOUT_MS, CANCEL, PANIC = 150, 3, 5
# Levels and their codes.
LEVELS = {"NORMAL": 0, "WARNING": 1, "ALERT": 2, "CANCEL_ALL": 3, "PANIC_CLOSE": 5, "HALTED": 99}


def positions_hash(positions: Column) -> Column:
    """16 hex digits over a map of positions, whatever the order of its entries."""
    return F.substring(F.sha2(F.to_json(F.array_sort(F.map_entries(positions))), 256), 1, 16)


def status(beats: DataFrame, as_of_ms: int, timeout_ms: int = TIMEOUT_MS, registered: DataFrame | None = None) -> DataFrame:
    """State of every strategy at ``as_of``: last_ms, missed, level, is_halted, halt_reason, healthy.

    ``registered`` (strategy_id) adds strategies without a heartbeat, which are in their normal state.
    """
    past = beats.filter(F.col("ts_ms") <= as_of_ms)
    ladder = escalations(past, timeout_ms, as_of_ms)
    last = ladder.groupBy("strategy_id").agg(F.max(F.when(F.col("accepted"), F.col("ts_ms"))).alias("last_ms"), F.max("missed").alias("worst"), F.max_by("missed", F.struct("ts_ms", "event_id")).alias("now"))
    halted = F.col("worst") >= PANIC
    out = last.select("strategy_id", "last_ms", F.when(halted, F.lit(PANIC)).otherwise(F.col("now")).cast("long").alias("missed"), F.when(halted, "HALTED").otherwise(level(F.col("now"))).alias("level"), halted.alias("is_halted"))
    if registered is not None:
        out = registered.select("strategy_id").distinct().join(out, "strategy_id", "full")
    out = out.select("strategy_id", "last_ms", F.coalesce("missed", F.lit(0).cast("long")).alias("missed"), F.coalesce("level", F.lit("NORMAL")).alias("level"), F.coalesce("is_halted", F.lit(False)).alias("is_halted"))
    reason = F.when(F.col("is_halted"), F.concat(F.lit(f"{PANIC} missed heartbeats")))
    return out.withColumn("halt_reason", reason).withColumn("healthy", ~F.col("is_halted") & (F.col("level") == "NORMAL"))


def level(missed: Column, cancel: int = CANCEL, panic: int = PANIC) -> Column:
    """Escalation after ``missed`` consecutive failed checks; panic closes and halts at once."""
    return F.when(missed >= panic, "HALTED").when(missed >= cancel, "CANCEL_ALL").when(missed >= 2, "ALERT").when(missed >= 1, "WARNING").otherwise("NORMAL")


def gaps(beats: DataFrame, timeout_ms: int = TIMEOUT_MS, end_ms: int | None = None) -> DataFrame:
    """Each heartbeat with the checks that fail before the next one.

    Checks run at multiples of the timeout. One fails when more than the timeout has passed since the last
    heartbeat. ``end_ms`` closes the last gap of each strategy.
    """
    w = Window.partitionBy("strategy_id").orderBy("ts_ms", "event_id")
    d = beats.withColumns({"next_ms": F.coalesce(F.lead("ts_ms").over(w), F.lit(end_ms).cast("long")), "hash_changed": F.coalesce(F.lag("positions_hash").over(w) != F.col("positions_hash"), F.lit(False))})
    last_check = F.floor((F.col("next_ms") - 1) / timeout_ms)
    first_late = F.floor((F.col("ts_ms") + timeout_ms) / timeout_ms)
    return d.withColumn("missed", F.coalesce(F.greatest(F.lit(0), last_check - first_late), F.lit(0)))


def escalations(beats: DataFrame, timeout_ms: int = TIMEOUT_MS, end_ms: int | None = None) -> DataFrame:
    """Heartbeats up to each strategy's halt, with the level that the gap after them reaches and whether they recover one."""
    g = gaps(beats, timeout_ms, end_ms)
    w = Window.partitionBy("strategy_id").orderBy("ts_ms", "event_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_halted", F.coalesce(F.max((F.col("missed") >= PANIC).cast("int")).over(before), F.lit(0))).withColumn("_was", F.lag("missed").over(w))
    return g.select("strategy_id", "event_id", "ts_ms", "missed", F.when(F.col("_halted") == 1, "HALTED").otherwise(level(F.col("missed"))).alias("level"), ((F.col("_halted") == 0) & (F.coalesce("_was", F.lit(0)) > 0)).alias("recovers"), (F.col("_halted") == 0).alias("accepted"), "hash_changed")


def as_of(checks: DataFrame, beats: DataFrame, timeout_ms: int = TIMEOUT_MS) -> DataFrame:
    """Last heartbeat at or before each check, by a union-ordered window; checks: (strategy_id, check_ms)."""
    a = beats.select("strategy_id", F.col("ts_ms").alias("at"), F.lit(0).alias("kind"), F.col("ts_ms").alias("beat"))
    b = checks.select("strategy_id", F.col("check_ms").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("beat"))
    w = Window.partitionBy("strategy_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    d = a.unionByName(b).withColumn("last_ms", F.last("beat", ignorenulls=True).over(w)).filter("kind = 1")
    return d.select("strategy_id", F.col("at").alias("check_ms"), "last_ms", F.coalesce(F.col("at") - F.col("last_ms") > timeout_ms, F.lit(False)).alias("late"))
