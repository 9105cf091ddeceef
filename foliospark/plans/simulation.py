"""Deterministic models of schedulers, over logs and planned work. No clock, no randomness: ties go to the lower index."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def acquired(pools: DataFrame, rpm: float, spread: float = 1.1) -> DataFrame:
    """(pool, pick, bucket, key, at): each pool's picks in order; the least used bucket that is free first, then the longest idle.

    pools: pool, bucket, keys (array), picks. A bucket's picks are 60 / rpm * spread
    seconds apart, the pool's at least a share of that; keys take turns.
    """
    gap = 60.0 / rpm * spread

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        buckets = [{"name": r.bucket, "keys": list(r.keys), "free": 0.0, "used": 0, "last": -1.0} for r in pdf.sort_values("bucket").itertuples()]
        between, now, out = min(0.25, gap / len(buckets)), 0.0, []
        for pick in range(int(pdf["picks"].max())):
            ready = [b for b in buckets if b["free"] <= now]
            if not ready:
                now = min(b["free"] for b in buckets)
                ready = [b for b in buckets if b["free"] <= now]
            b = min(ready, key=lambda b: (b["used"], b["last"]))
            out.append((pdf["pool"].iloc[0], pick, b["name"], b["keys"][b["used"] % len(b["keys"])], now))
            b.update(free=now + gap, used=b["used"] + 1, last=now)
            now += between
        return pd.DataFrame(out, columns=["pool", "pick", "bucket", "key", "at"])

    return pools.groupBy("pool").applyInPandas(run, "pool string, pick int, bucket string, key string, at double")


def cooled_until(at: Column, strikes: Column, server: Column) -> Column:
    """When a rate-limited bucket is free again: its back-off, or longer if the server says so."""
    own = F.least(F.lit(300.0), 20.0 * F.pow(F.lit(2.0), F.least(F.lit(4), strikes - 1)))
    return at + F.greatest(own, F.coalesce(server, F.lit(0.0)))


def race(primary: Column, copy: Column, delay: Column) -> Column:
    """Struct (seconds, winner) of a request and its copy that starts after ``delay``; null: it fails. The primary wins ties."""
    late = F.when(F.coalesce(primary, F.lit(float("inf"))) > delay, delay + copy)
    seconds = F.least(primary, late)
    return F.struct(seconds.alias("seconds"), F.when(primary == seconds, "primary").when(late == seconds, "copy").alias("winner"))


def page_source(answer: Column, draft: Column) -> Column:
    """Where a page's text comes from: model, ocr (the draft alone) or both; null without either."""
    return F.when(answer.isNotNull() & draft.isNotNull(), "ocr+model").when(answer.isNotNull(), "model").when(draft.isNotNull(), "ocr")


def first_available(attempts: DataFrame, key: list[str], order: str) -> DataFrame:
    """The outcome of a fallback chain: the first attempt whose state isn't unavailable."""
    return attempts.filter(F.col("state") != "unavailable").groupBy(*key).agg(F.min_by("state", order).alias("state"), F.min(order).alias("attempt"))


def failover(attempts: DataFrame, key: list[str], order: str) -> DataFrame:
    """The attempts that a failover makes: up to and with the first that succeeds."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return attempts.withColumn("__done", F.coalesce(F.max(F.col("ok").cast("int")).over(w), F.lit(0))).filter("__done = 0").drop("__done")


def ready_first(units: DataFrame, lookahead: int) -> DataFrame:
    """(unit, place): units in the order of readiness; none before the unit ``lookahead`` places ahead of it in line is out.

    units: unit, nth, ready. A unit's release waits for the readiness of those that
    must leave before it, which is a running maximum.
    """
    w = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -lookahead)
    gated = units.withColumn("release", F.greatest(F.col("ready"), F.coalesce(F.min("ready").over(w), F.lit(0.0))))
    return gated.withColumn("place", F.row_number().over(Window.orderBy("release", "nth")))


def retry_rounds(units: DataFrame, rounds: int) -> DataFrame:
    """(unit, attempts, status) of units that fail ``failures`` times before they succeed, at most ``rounds`` attempts."""
    n = F.least(F.col("failures") + 1, F.lit(rounds))
    return units.select("unit", n.alias("attempts"), F.when(F.col("failures") < rounds, "ok").otherwise("failed").alias("status"))


def unit_status(statuses: Column) -> Column:
    """A batch's status: failed if any page failed, blank if all are blank."""
    return F.when(F.exists(statuses, lambda s: s == "failed"), "failed").when(F.forall(statuses, lambda s: s == "blank"), "blank").otherwise("ok")


def submitted_route(strikes_link: Column, strikes_relay: Column, most: int = 2) -> Column:
    """The route that is left after strikes: by link, then through the relay, then uploaded."""
    return F.when(strikes_link < most, "link").when(strikes_relay < most, "relay").otherwise("upload")
