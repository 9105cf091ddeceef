"""Micro-batches of message parts: numbering, bounded batches, idempotent delivery, timings."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_PARTS, BATCH_BYTES = 4, 250 << 10
LAST = 9998


#: Sequences of parts that have one of their own.
FIXED = {"agent-status": 10_000, "answer": 9_999}
MOST_PARTS = 10_000


def wanted(key: Column) -> Column:
    """The sequence that a part asks for: its own, a step's number plus one, 1 for reasoning; null: the next after those that are there."""
    step = F.regexp_extract(key, "^step:([0-9]+)", 1)
    own = F.when(step != "", step.cast("long") + 1).when(key == "reasoning", F.lit(1))
    for name, sequence in FIXED.items():
        own = own.when(key == name, F.lit(sequence))
    return own.cast("long")


def numbered(parts: DataFrame) -> DataFrame:
    """(message, key, sequence) in order of arrival: a part keeps its first sequence, one that is taken moves up, none beyond 9998.

    parts: message, arrival, key. A message's parts are at most 10,000. Requests
    are columns; in a message each takes the first free place at or after the one
    it wants, found over links from taken places to the places behind them.
    """
    first = parts.groupBy("message", "key").agg(F.min("arrival").alias("arrival"))
    asked = first.select("message", "key", "arrival", wanted(F.col("key")).alias("want"), F.col("key").isin(*FIXED).alias("fixed"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        behind: dict[int, int] = {}

        def free(at: int) -> int:
            way = []
            while at in behind:
                way.append(at)
                at = behind[at]
            behind.update((w, at) for w in way)
            return at

        out: list[tuple] = []
        for r in pdf.sort_values("arrival").itertuples():
            at = len(out) + 1 if pd.isna(r.want) else int(r.want)
            at = at if r.fixed else free(at)
            if len(out) < MOST_PARTS and (r.fixed or at <= LAST):
                behind[at] = at + 1
                out.append((r.message, r.key, at))
        return pd.DataFrame(out, columns=["message", "key", "sequence"])

    schema = f"message {parts.schema['message'].dataType.simpleString()}, key string, sequence long"
    return asked.groupBy("message").applyInPandas(place, schema)


def batched(parts: DataFrame, most_parts: int = BATCH_PARTS, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """(message, sequence, batch): parts in order, a new batch after ``most_parts`` or where ``most_bytes`` would be exceeded."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        batch, n, size, out = 1, 0, 0, []
        for r in pdf.sort_values("sequence").itertuples():
            if n and (n >= most_parts or size + r.bytes > most_bytes):
                batch, n, size = batch + 1, 0, 0
            n, size = n + 1, size + r.bytes
            out.append((r.message, r.sequence, batch))
        return pd.DataFrame(out, columns=["message", "sequence", "batch"])

    kind = lambda c: parts.schema[c].dataType.simpleString()
    return parts.groupBy("message").applyInPandas(fold, f"message {kind('message')}, sequence {kind('sequence')}, batch int")


def kept_within(parts: DataFrame, most_parts: int = 500, most_bytes: int = (2 << 20) - 4096) -> DataFrame:
    """(message, sequence, kept): a byte budget that goes on after a part that doesn't fit; smaller ones may."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        size, out = 0, []
        for i, r in enumerate(pdf.sort_values("sequence").itertuples()):
            fits = i < most_parts and size + r.bytes + 2 <= most_bytes
            size += r.bytes + 2 if fits else 0
            out.append((r.message, r.sequence, fits))
        return pd.DataFrame(out, columns=["message", "sequence", "kept"])

    kind = lambda c: parts.schema[c].dataType.simpleString()
    return parts.groupBy("message").applyInPandas(fold, f"message {kind('message')}, sequence {kind('sequence')}, kept boolean")


def deliver(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str):
    """Start delivery of a stream's batches; a batch that was interrupted comes again with the same id and the same rows."""
    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def heartbeat_due(now: float | Column, flushed: Column, quiet: float = 30.0) -> Column:
    """Whether an empty batch is forced: nothing was sent for ``quiet`` seconds."""
    return (F.lit(now) if isinstance(now, (int, float)) else now) - flushed >= quiet
