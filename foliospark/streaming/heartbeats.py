"""Heartbeats of quiet streams: keyed state with processing-time timers, and the same over a finished log."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

QUIET, EVERY = 30.0, 5.0
BEATS = "job string, kind string, sequence bigint, parts int, at_ms bigint"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Heartbeat(StatefulProcessor):
    """Passes a job's deliveries on and adds an empty one whenever it was quiet for so long.

    State per job is its last sequence and the time of its one timer: bounded
    whatever a job delivers. A row of kind closed ends the job, its timer and state.
    """

    def __init__(self, quiet: float):
        self.quiet = int(quiet * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "sequence bigint, due bigint")

    def _due(self, now: int, sequence: int, before: int | None) -> None:
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(now + self.quiet)
        self.state.update((sequence, now + self.quiet))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        sequence, due = self.state.get() if self.state.exists() else (0, None)
        closed = False
        out = []
        for pdf in rows:
            for r in pdf.sort_values("sequence").itertuples():
                closed |= r.kind == "closed"
                sequence = max(sequence, int(r.sequence))
                out.append((key[0], r.kind, int(r.sequence), int(r.parts), now))
        if closed:
            if due is not None:
                self.handle.deleteTimer(due)
            self.state.clear()
        else:
            self._due(now, sequence, due)
        yield pd.DataFrame(out, columns=["job", "kind", "sequence", "parts", "at_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        if not self.state.exists():
            return
        sequence, _ = self.state.get()
        self._due(now, sequence + 1, None)  # the timer that rang is gone
        yield pd.DataFrame([(key[0], "heartbeat", sequence + 1, 0, now)], columns=["job", "kind", "sequence", "parts", "at_ms"])

    def close(self) -> None:
        pass


def with_heartbeats(deliveries: DataFrame, quiet: float = QUIET) -> DataFrame:
    """A stream of (job, kind, sequence, parts) with heartbeats in it: (job, kind, sequence, parts, at_ms), in append mode.

    The session's state store must be one that keeps timers (``STORE``). Spark runs
    no batch without rows right after a restart: beats go on with the next delivery
    of any job.
    """
    own = deliveries.select("job", "kind", F.col("sequence").cast("long").alias("sequence"), F.col("parts").cast("int").alias("parts"))
    return own.groupBy("job").transformWithStateInPandas(Heartbeat(quiet), BEATS, "append", "ProcessingTime")


def quiet_beats(deliveries: DataFrame, end: Column, every: float = EVERY, quiet: float = QUIET) -> DataFrame:
    """(job, at, beats, first, last): how many heartbeats follow each delivery (job, at in seconds) until the next one or ``end``.

    A writer looks every ``every`` seconds from the job's first delivery, and sends
    an empty batch when the last one, empty or not, is ``quiet`` seconds old. Beats
    are counted by arithmetic, however long the silence.
    """
    w = Window.partitionBy("job").orderBy("at")
    own = deliveries.select("job", F.col("at").cast("double").alias("at"), F.min("at").over(Window.partitionBy("job")).cast("double").alias("__start"), F.lead("at").over(w).cast("double").alias("__next"))
    ticks = lambda seconds: F.ceil(seconds / every)
    first = F.col("__start") + ticks(F.col("at") + quiet - F.col("__start")) * F.lit(every)
    until = F.coalesce("__next", end.cast("double"))
    step = math.ceil(quiet / every) * every
    beats = F.greatest(F.lit(0), F.ceil((until - first) / step)).cast("long")
    return own.select("job", "at", beats.alias("beats"), F.when(beats > 0, first).alias("first"), F.when(beats > 0, first + (beats - 1) * F.lit(step)).alias("last"))
