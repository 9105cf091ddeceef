"""Ranged downloads planned over header columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, LEAST = 16 << 20, 32 << 20


def blocks(files: DataFrame, total: str, size: int = BLOCK) -> DataFrame:
    """Byte blocks [start, last] of ``size`` bytes, the last one short."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col(total).cast("long") - 1, F.lit(size).cast("long"))).alias("start")
    return files.filter(F.col(total) > 0).select("*", starts).withColumn("last", F.least(F.col(total).cast("long"), F.col("start") + size) - 1)


def range_plan(accept: Column, encoding: Column, length: Column, etag: Column) -> Column:
    """Whether a file can be fetched in ranges, and the validator to send along: none for a weak one."""
    ok = (F.lower(accept) == "bytes") & F.coalesce(F.lower(encoding), F.lit("identity")).isin("identity", "") & (length >= LEAST)
    strong = F.when(~F.startswith(etag, F.lit("W/")), etag)
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(length.alias("total"), strong.alias("if_range")))


def is_pdf(content: Column) -> Column:
    """The magic bytes of a PDF."""
    return F.substring(content, 1, 5) == F.lit("%PDF-").cast("binary")
