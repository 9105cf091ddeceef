"""Aggregations over page results, request logs and usage counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_counts(pages: DataFrame, *keys: str) -> DataFrame:
    """Counts by status, percent of all pages to one decimal unrounded, and the overall state."""
    n = lambda s: F.count_if(F.col("status") == s)
    done = n("ok") + n("blank")
    return pages.groupBy(*keys).agg(
        F.count("*").alias("total"), n("ok").alias("ok"), n("blank").alias("blank"), n("failed").alias("failed"),
        F.greatest(F.lit(0), F.count("*") - done).alias("pending"), (100.0 * done / F.count("*")).alias("percent"),
    )


def overall_state(failed: Column, missing: Column) -> Column:
    return F.when(failed, "failed").when(missing, "partial").otherwise("completed")


def flattened(units: DataFrame) -> DataFrame:
    """Page rows of units: their page_results, or the unit itself where it has none."""
    own = F.array(F.struct("chunk", "status"))
    return units.select(F.explode(F.coalesce("page_results", own)).alias("p")).select("p.*")


def zero_filled(counts: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Counts for exactly the given values, zero where there are none. counts: key, n."""
    fixed = counts.sparkSession.createDataFrame([(v,) for v in values], f"{key} string")
    return fixed.join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def nearest_rank(values: DataFrame, key: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Values at the nearest rank round((n - 1) * share), half to even, for each key.

    Ranks come from a window, so that a group's values are sorted on disk if need
    be and never gathered in a row.
    """
    order = Window.partitionBy(*key)
    ranked = values.filter(F.col(value).isNotNull()).withColumn("__r", F.row_number().over(order.orderBy(value)) - 1).withColumn("__n", F.count("*").over(order))
    picked = [F.max(F.when(F.col("__r") == F.bround((F.col("__n") - 1) * F.lit(float(p))), F.col(value))).alias(name) for name, p in shares.items()]
    return ranked.groupBy(*key).agg(F.count("*").alias("n"), *picked)


def recent(rows: DataFrame, key: list[str], order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return rows.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def status_class(status: Column) -> Column:
    return F.when(status == 200, "200").when(status == 429, "429").when(status == 503, "503").otherwise("other")


def usage_totals(rows: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """Sums that are null where no row reports the counter, and how many rows report any."""
    any_reported = F.coalesce(*counters).isNotNull()
    return rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in counters], F.count_if(any_reported).alias("reporting"))


def cumulative_usage(rows: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """The largest value of each counter: polls repeat what was counted before and must not be added."""
    return rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in counters])


def last_value(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The last non-null value of each key."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*key).agg(F.max_by(value, order).alias(value))


def duplicate_groups(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
