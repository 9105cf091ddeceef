"""Window-like computations: islands, runs, neighbours, bounded histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, key: list[str], number: str) -> DataFrame:
    """(key, first, last) of the runs of consecutive numbers; repeated numbers count once."""
    distinct = rows.select(*key, number).filter(F.col(number).isNotNull()).distinct()
    w = Window.partitionBy(*key).orderBy(number)
    return distinct.withColumn("__g", F.col(number) - F.row_number().over(w)).groupBy(*key, "__g").agg(F.min(number).alias("first"), F.max(number).alias("last")).drop("__g")


def numbered(rows: DataFrame, key: str, order: str, number: str, block: int = 65536) -> DataFrame:
    """Rows of each key numbered from 1 along the whole-number column ``order`` (ties in no fixed order).

    Windows hold one block of ``order`` values; a block's first number comes from the counts of
    the blocks before it, so that a key with a third of all rows is spread over many tasks.
    """
    own = rows.withColumn("__b", F.floor(F.col(order) / block))
    counts = own.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__c")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__k").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__k", "__c", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    within = own.withColumn(number, F.row_number().over(Window.partitionBy(key, "__b").orderBy(order)).cast("long"))
    same = F.col(key).eqNullSafe(F.col("__k")) & F.col("__b").eqNullSafe(F.col("__c"))
    return within.join(counts, same).withColumn(number, F.col(number) + F.col("__o")).drop("__b", "__k", "__c", "__o")


def range_label(first: Column, last: Column) -> Column:
    return F.when(first == last, first.cast("string")).otherwise(F.concat(first.cast("string"), F.lit("–"), last.cast("string")))


def page_ranges(rows: DataFrame, key: list[str], number: str) -> DataFrame:
    """(key, ranges): islands as text, in order, joined by an ideographic comma."""
    own = islands(rows, key, number).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("__r"))
    return own.select(*key, F.array_join(F.transform("__r", lambda r: range_label(r["first"], r["last"])), "、").alias("ranges"))


def batches(rows: DataFrame, key: list[str], order: str, size: int) -> DataFrame:
    """Consecutive groups of ``size`` rows, the last one short."""
    w = Window.partitionBy(*key).orderBy(order)
    return rows.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size))


def neighbours(rows: DataFrame, key: list[str], number: str) -> DataFrame:
    """Previous and next numbers where they are adjacent, null elsewhere."""
    w = Window.partitionBy(*key).orderBy(number)
    near = lambda c, step: F.when(c == F.col(number) + step, c)
    return rows.withColumn("previous", near(F.lag(number).over(w), -1)).withColumn("next", near(F.lead(number).over(w), 1))


def step_deltas(steps: DataFrame, key: list[str], order: str, elapsed: str, baseline: Column, cap: int = 100) -> DataFrame:
    """Seconds since the step before, since ``baseline`` for the first, never negative; at most ``cap`` steps."""
    w = Window.partitionBy(*key).orderBy(order)
    own = steps.withColumn("__r", F.row_number().over(w)).withColumn("delta", F.greatest(F.lit(0.0), F.col(elapsed) - F.coalesce(F.lag(elapsed).over(w), baseline)))
    return own.filter(F.col("__r") <= cap).drop("__r")


def rolling_share(rows: DataFrame, key: list[str], order: str, hit: Column, size: int = 20) -> DataFrame:
    """Share of hits among the last ``size`` rows, this one included."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-(size - 1), 0)
    return rows.withColumn("share", F.avg(hit.cast("double")).over(w))


def latest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return rows.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def runs(rows: DataFrame, key: list[str], order: str, breaks: Column) -> DataFrame:
    """A run number that grows by one wherever ``breaks`` holds."""
    w = Window.partitionBy(*key).orderBy(order)
    return rows.withColumn("run", F.sum(F.when(breaks, 1).otherwise(0)).over(w))


def merged_runs(rows: DataFrame, key: list[str], order: str, kind: str, text: str) -> DataFrame:
    """Adjacent rows of one kind joined into one: (key, run, kind, text, n)."""
    w = Window.partitionBy(*key).orderBy(order)
    changed = ~F.col(kind).eqNullSafe(F.lag(kind).over(w)) | (F.row_number().over(w) == 1)
    own = runs(rows.withColumn("__new", changed), key, order, F.col("__new"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(text).alias("t")))), lambda r: r["t"]), "")
    return own.groupBy(*key, "run", kind).agg(joined.alias(text), F.count("*").alias("n"))


def within_seconds(rows: DataFrame, key: list[str], at: str, seconds: int) -> DataFrame:
    """How many rows of the key lie in the ``seconds`` up to and with this one, and the gap to the one before."""
    w = Window.partitionBy(*key).orderBy(at)
    return rows.withColumn("n_within", F.count("*").over(w.rangeBetween(-seconds + 1, 0))).withColumn("gap", F.col(at) - F.lag(at).over(w))
