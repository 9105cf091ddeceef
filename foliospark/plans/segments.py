"""Page ranges cut into segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAMP = (5, 10, 15)


def segments(ranges: DataFrame, size: int) -> DataFrame:
    """Segments of ``size`` pages, the last one short. ranges: first, last and any keys."""
    rest = [c for c in ranges.columns if c not in ("first", "last")]
    starts = F.explode(F.sequence("first", "last", F.lit(size).cast("long"))).alias("start")
    return ranges.select(*rest, "last", starts).select(*rest, F.col("start").alias("first"), F.least("last", F.col("start") + (size - 1)).alias("last"))


def ramp(ranges: DataFrame, size: int, steps: tuple[int, ...] = RAMP) -> DataFrame:
    """Small segments first, as long as they are smaller than ``size``, then segments of ``size``."""
    rest = [c for c in ranges.columns if c not in ("first", "last")]
    bounds, at = [], 0
    for step in steps:
        if step >= size:
            break
        bounds.append((at, step))
        at += step
    small = None
    if bounds:
        each = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for a, n in bounds])).alias("s")
        own = ranges.select(*rest, "first", "last", each).select(*rest, (F.col("first") + F.col("s.a")).alias("first"), "last", "s.n").filter("first <= last")
        small = own.select(*rest, "first", F.least("last", F.col("first") + F.col("n") - 1).alias("last"))
    after = segments(ranges.withColumn("first", F.col("first") + at).filter("first <= last"), size)
    return after if small is None else small.unionByName(after)


def halved(ranges: DataFrame, most: int, depth: int = 40) -> DataFrame:
    """Ranges halved until none has more than ``most`` pages: halving commutes over levels, so each level is one union."""
    rest = [c for c in ranges.columns if c not in ("first", "last")]
    key = ", ".join(rest)
    return ranges.sparkSession.sql(
        f"""WITH RECURSIVE h({key}, first, last) AS (SELECT {key}, CAST(first AS BIGINT), CAST(last AS BIGINT) FROM {{ranges}} UNION ALL
        SELECT {key}, CASE side WHEN 0 THEN first ELSE (first + last) DIV 2 + 1 END, CASE side WHEN 0 THEN (first + last) DIV 2 ELSE last END
        FROM h LATERAL VIEW explode(array(0, 1)) t AS side WHERE last - first + 1 > {int(most)})
        SELECT {key}, first, last FROM h WHERE last - first + 1 <= {int(most)}""",
        ranges=ranges,
    )
