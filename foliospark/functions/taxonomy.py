"""Errors and their classes: a lattice of classes and the facts that tell them, as two small tables.

An error's facts are (field, value) pairs: where it came from, a status, a code, a
finish reason. Each rule says which class a fact of a source stands for and with
what precedence; an error belongs to the class of the first rule that one of its
facts meets. The rules are a fixed table, looked up in one broadcast join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes: what each is a kind of, whether another try may help, whether the work as a whole ends with it. Fixed values.
CLASSES = {
    "error": (None, True, False), "permanent": ("error", False, False), "truncated": ("permanent", False, False), "rejected request": ("permanent", False, False), "blocked": ("error", False, False),
    "exhausted": ("error", False, True), "invalid": ("error", False, False), "empty answer": ("error", True, False), "unusable answer": ("error", True, False), "batch answer": ("unusable answer", True, False),
    "unavailable": ("error", True, False), "rate limited": ("error", True, False), "credential retired": ("error", True, False), "transport": ("error", True, False),
    "ocr": ("error", True, False), "ocr fatal": ("ocr", False, True), "ocr retryable": ("ocr", True, False), "ocr job failed": ("ocr retryable", True, False), "ocr token retired": ("ocr retryable", True, False),
    "ocr fetch timeout": ("ocr retryable", True, False), "ocr source rejected": ("ocr", False, False), "source": ("error", False, True), "ranges unsupported": ("source", True, False), "source gone": ("source", False, True), "canceled": ("error", False, True),
}
ANY = "*"


def _rules() -> list[tuple[int, str, str, str, str]]:
    """(precedence, source, field, value, class); lower precedence first."""
    every: list[tuple[int, str, str, str, str]] = []

    def add(rank: int, source: str, field: str, cls: str, *values) -> None:
        every.extend((rank, source, field, str(v), cls) for v in values)

    add(0, ANY, "state", "canceled", "canceled", "cancelled")
    add(5, ANY, "kind", "invalid", "argument")
    add(5, ANY, "kind", "transport", "connection", "timeout")
    add(10, "model", "scope", "credential retired", "key", "bucket")
    add(11, "model", "pool", "exhausted", "empty")
    add(20, "model", "status", "rate limited", 429)
    add(21, "model", "status", "rejected request", 400, 401, 402, 403, 405, 422)
    add(22, "model", "status", "unavailable", 404, *range(500, 600))
    add(30, "model", "answer", "truncated", "truncated")
    add(31, "model", "answer", "blocked", "blocked")
    add(32, "model", "answer", "empty answer", "empty")
    add(33, "model", "answer", "batch answer", "page marks")
    add(34, "model", "answer", "unusable answer", "faulty", "no JSON")
    add(40, "ocr", "code", "ocr fatal", 401, 12001)
    add(40, "ocr", "status", "ocr fatal", 401, 403)
    add(41, "ocr", "code", "ocr source rejected", 10002, 10004, 10005)
    add(42, "ocr", "status", "ocr fetch timeout", 408, 504)
    add(42, "ocr", "code", "ocr fetch timeout", 408, 504)
    add(43, "ocr", "code", "ocr retryable", 10010, 12002, 500)
    add(43, "ocr", "status", "ocr retryable", 429, *range(500, 600))
    add(44, "ocr", "job", "ocr job failed", "failed")
    add(45, "ocr", "token", "ocr token retired", "retired")
    add(50, "source", "range", "ranges unsupported", "other range", "whole file")
    add(51, "source", "status", "source gone", 404, 410)
    return every


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_rules(), "precedence int, source string, field string, value string, class string")


def classes(spark: SparkSession) -> DataFrame:
    """(class, parent, retryable, terminal, ancestors): ancestors from the class itself to the root."""

    def line(c: str) -> list[str]:
        parent = CLASSES[c][0]
        return [c, *(line(parent) if parent else [])]

    return spark.createDataFrame([(c, *facts, line(c)) for c, facts in CLASSES.items()], "class string, parent string, retryable boolean, terminal boolean, ancestors array<string>")


def classified(errors: DataFrame, key: str, source: str = "source", facts: str = "facts") -> DataFrame:
    """(key, class, retryable, terminal, ancestors) of errors with a map of facts; one that no rule knows is an error.

    One pass over the errors: their facts meet the rules, a few hundred, by broadcast.
    """
    spark = errors.sparkSession
    told = errors.select(key, F.col(source).alias("__source"), F.explode_outer(facts).alias("field", "value"))
    listed = rules(spark).withColumnRenamed("source", "__of")
    known = told.join(F.broadcast(listed), ["field", "value"], "left").withColumn("__fits", (F.col("__of") == ANY) | F.col("__of").eqNullSafe(F.col("__source")))
    best = known.groupBy(key).agg(F.min(F.when(F.col("__fits"), F.struct("precedence", "class"))).alias("r"))
    own = best.select(key, F.coalesce("r.class", F.lit("error")).alias("class"))
    return own.join(F.broadcast(classes(spark)), "class").select(key, "class", "retryable", "terminal", "ancestors")


def is_a(ancestors: Column, cls: str) -> Column:
    return F.array_contains(ancestors, cls)
