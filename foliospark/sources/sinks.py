"""Sinks: summaries, page files, merged documents, idempotent upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.aggregates import status_counts
from ..operators.windows import page_ranges


def summary_rows(pages: DataFrame, key: str) -> DataFrame:
    """Label and value rows of a run's summary."""
    c = status_counts(pages, key)
    s = lambda n: F.col(n).cast("string")
    rows = F.array(
        F.struct(F.lit("completed").alias("metric"), F.concat_ws("/", (F.col("ok") + F.col("blank")).cast("string"), s("total")).alias("result")),
        F.struct(F.lit("successful / blank / failed").alias("metric"), F.concat_ws(" / ", s("ok"), s("blank"), s("failed")).alias("result")),
    )
    return c.select(key, F.explode(rows).alias("r")).select(key, "r.*")


def merged_documents(pages: DataFrame, key: str) -> DataFrame:
    """One text for each document: a mark and the text of each completed page, in order, a blank line between.

    pages: key, number, status, text. A document is one row, so its pages must fit
    into one, as they do in the file that is written.
    """
    body = F.concat(F.lit("<!-- 第 "), F.col("number").cast("string"), F.lit(" 页 -->\n\n"), X.strip(F.col("text")))
    own = pages.filter((F.col("status") == "ok") & (X.strip(F.col("text")) != ""))
    ordered = F.array_sort(F.collect_list(F.struct("number", body.alias("body"))))
    return own.groupBy(key).agg(F.array_join(F.transform(ordered, lambda r: r["body"]), "\n\n").alias("body"))


def missing_ranges(pages: DataFrame, key: str) -> DataFrame:
    """(key, missing): page ranges between the first and last page that are not completed."""
    planned = pages.groupBy(key).agg(F.explode(F.sequence(F.min("number"), F.max("number"))).alias("number"))
    left = planned.join(pages.filter(F.col("status").isin("ok", "blank")), [key, "number"], "left_anti")
    return page_ranges(left, [key], "number").withColumnRenamed("ranges", "missing")


def header(total: Column, first: Column, last: Column, done: Column, missing: Column) -> Column:
    """The head of a merged document: its range, how much of it is there, what is missing."""
    whole = missing.isNull()
    lines = F.array_compact(
        F.array(
            F.lit("# 文档信息"), F.lit(""), F.concat(F.lit("- 原始页数："), total.cast("string")),
            F.concat(F.lit("- 转换范围："), first.cast("string"), F.lit("–"), last.cast("string"), F.lit(" 页")),
            F.concat(F.lit("- 转换结果："), F.when(whole, "完成").otherwise("部分完成"), F.lit("（"), done.cast("string"), F.lit("/"), (last - first + 1).cast("string"), F.lit(" 页）")),
            F.when(~whole, F.concat(F.lit("- 未完成页码："), missing)),
        )
    )
    return F.array_join(lines, "\n")


def write_pages(pages: DataFrame, path: str, key: str) -> None:
    """Page texts with links as seen from a folder below, partitioned by document; pages of documents that are rewritten are replaced."""
    own = pages.select(key, "number", X.page_links(F.col("text")).alias("text"))
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def upserted(saved: DataFrame, batch: DataFrame, key: list[str], version: str) -> DataFrame:
    """``saved`` with the rows of ``batch`` in place of those with the same key; the same batch again changes nothing."""
    both = saved.unionByName(batch)
    rest = [c for c in saved.columns if c not in key]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(*key, *[F.col(f"r.{c}") for c in rest])
