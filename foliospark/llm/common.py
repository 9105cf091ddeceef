"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import tempfile
import time
import types
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that Arrow hands to a Python worker at once; bounds a task's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Keep Arrow batches small: one text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))  # one machine: any folder is shared
    return sc.getCheckpointDir()


def stored(df: DataFrame, large: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, in folders by the columns ``by``, and read it back.

    Cuts the lineage and is columnar and compressed, unlike checkpoint(); a lost
    executor costs nothing that was written. After a ``large`` one the shuffle
    files behind it are let go at once.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    spark, schema = df.sparkSession, df.schema
    df.write.partitionBy(*by).parquet(path)
    if large:
        del df
        tidy(spark)
    read = spark.read.schema(schema).parquet(path)
    read.stored_at = path
    return read


def dropped(table: DataFrame, folder: str = "") -> None:
    """Remove the files of a ``stored`` table, or of one of its folders, that nothing will read any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.stored_at}/{folder}" if folder else table.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs now, not at its next periodic collection."""
    for _ in range(3):  # what still refers to a job lets go of it a moment after its end
        time.sleep(0.3)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


Batches = TypeVar("Batches", Iterator[pa.RecordBatch], Iterator[pa.Array])


def handing_back(rows: Callable[[Batches], Batches], cached: bool = True) -> Callable[[Batches], Batches]:
    """``rows`` for mapInArrow or an arrow_udf over iterators; at its end the worker, which lives on, hands what was freed back to the machine.

    Unless ``cached``, what earlier operators left in ``worker_cache`` goes first: ``rows`` does not use it.
    """

    @functools.wraps(rows)
    def wrapped(batches: Batches) -> Batches:
        if not cached:
            worker_cache().clear()
        yield from rows(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return wrapped


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions that travel by value bring new globals with every task; this one
    sits in a module of its own, so that what one task has loaded serves the next.
    """
    return vars(sys.modules.setdefault("_foliospark_worker", types.ModuleType("_foliospark_worker"))).setdefault("cache", {})
