"""Views that give the operators' inputs their shape from the driver's tables.

They stand in for page results, request logs and message parts; what is checked
on them is an operator's logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.windows import numbered
from .session import table

#: The same views for SQL; each is a common table expression.
PAGES_SQL = """pg AS (SELECT d.doc_id, d.source AS doc, row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) AS number, d.text, d.n_chars,
CASE WHEN l.doc_id IS NULL THEN 'failed' WHEN d.n_chars < 200 THEN 'blank' ELSE 'ok' END AS status,
CASE WHEN l.quality = 1 THEN 'model' WHEN l.quality = 0 THEN 'ocr' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id))"""
REQUESTS_SQL = """rq AS (SELECT event_id AS seq, user_id AS bucket, event_type, value AS seconds, ts,
CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 429 ELSE 503 END ELSE 200 END AS status FROM events)"""


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of documents: doc, number from 1, status ok, blank or failed, origin model or ocr."""
    labels = table(spark, folder, "labels").select("doc_id", "quality", F.lit(True).alias("seen"))
    own = numbered(table(spark, folder, "documents"), "source", "doc_id", "number")
    status = F.when(F.col("seen").isNull(), "failed").when(F.col("n_chars") < 200, "blank").otherwise("ok")
    origin = F.when(F.col("quality") == 1, "model").when(F.col("quality") == 0, "ocr")
    return own.join(labels, "doc_id", "left").select("doc_id", F.col("source").alias("doc"), "number", "text", "n_chars", status.alias("status"), origin.alias("origin"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """A request log: seq, bucket, status 200, 429 or 503, seconds, ts."""
    status = F.when(F.col("event_type") != "error", 200).when(F.col("event_id") % 2 == 0, 429).otherwise(503)
    return table(spark, folder, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("bucket"), "event_type", F.col("value").alias("seconds"), "ts", status.alias("status"))


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Message parts: message, sequence, kind, content."""
    return table(spark, folder, "conversations").select(F.col("conv_id").alias("message"), F.col("turn").alias("sequence"), F.col("role").alias("kind"), F.col("text").alias("content"))
