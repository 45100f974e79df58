"""Streaming dead-man's switch: processing-time timers escalate silent strategies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.heartbeat import CANCEL, PANIC, TIMEOUT_MS

STATE = T.StructType([T.StructField("last_ms", T.LongType()), T.StructField("missed", T.IntegerType()), T.StructField("halted", T.BooleanType()), T.StructField("hash", T.StringType())])
OUT = "strategy_id string, at_ms bigint, kind string, level string, missed int"


def level_of(missed: int) -> str:
    if missed >= PANIC:
        return "HALTED"
    if missed >= CANCEL:
        return "CANCEL_ALL"
    return ("NORMAL", "WARNING", "ALERT")[missed]


class Switch(StatefulProcessor):
    """Input rows (strategy_id, ts_ms, kind, positions_hash); kind is ``beat`` or ``ack``.

    A beat resets the count unless the strategy is halted; an acknowledgement ends a halt. Every beat sets a timer
    one timeout ahead, and a timer that fires counts a miss, escalates, and sets the next until the halt.
    Unknown strategies register themselves with their first beat; a row of kind ``register`` does so without one, and
    is watched from its first beat on. With ``needs_ack`` off, a beat ends a halt like any other escalation.
    """

    def __init__(self, timeout_ms: int = TIMEOUT_MS, needs_ack: bool = True):
        self.timeout_ms, self.needs_ack = timeout_ms, needs_ack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("switch", STATE)

    def _emit(self, key, at: int, kind: str, missed: int) -> pd.DataFrame:
        return pd.DataFrame([(key[0], at, kind, level_of(missed), missed)], columns=["strategy_id", "at_ms", "kind", "level", "missed"])

    def _rearm(self, now: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(now + self.timeout_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, missed, halted, held = tuple(self.state.get()) if self.state.exists() else (None, 0, False, None)
        out = []
        for r in pd.concat(list(rows)).sort_values("ts_ms", kind="stable").itertuples(index=False):
            if r.kind == "ack":
                if halted:
                    out.append(self._emit(key, int(r.ts_ms), "acknowledged", 0))
                halted, missed = False, 0
            elif r.kind == "register":
                if last is None:
                    out.append(self._emit(key, int(r.ts_ms), "registered", 0))
            elif halted and self.needs_ack:
                out.append(self._emit(key, int(r.ts_ms), "ignored", missed))
            else:
                if held is not None and r.positions_hash != held:
                    out.append(self._emit(key, int(r.ts_ms), "hash_changed", missed))
                if missed:
                    out.append(self._emit(key, int(r.ts_ms), "recovered", 0))
                last, missed, halted, held = int(r.ts_ms), 0, False, r.positions_hash
        self.state.update((last, missed, halted, held))
        if not halted and last is not None:
            self._rearm(timerValues.getCurrentProcessingTimeInMs())
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, missed, halted, held = tuple(self.state.get())
        if halted:
            return
        missed += 1
        halted = missed >= PANIC
        self.state.update((last, missed, halted, held))
        now = timerValues.getCurrentProcessingTimeInMs()
        if not halted:
            self.handle.registerTimer(now + self.timeout_ms)
        yield self._emit(key, now, "escalated", missed)

    def close(self) -> None:
        pass


def watch(beats: DataFrame, timeout_ms: int = TIMEOUT_MS, needs_ack: bool = True) -> DataFrame:
    """Escalation events of a stream of beats and acknowledgements."""
    return beats.groupBy("strategy_id").transformWithStateInPandas(Switch(timeout_ms, needs_ack), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")
