"""Tables kept in the shared folder between the steps of an operator, and checked broadcasts."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import configure, small_side, work_path

#: Text rows handed to Python at a time; the session's default of 10,000 can be gigabytes of text.
TEXT_ROWS = 256
#: A join side is broadcast up to this size, measured on the rows themselves.
BROADCAST_BYTES = 16 * 1024 * 1024
#: UTF-8 bytes that count as white space: `[^\x20\x09-\x0D]+` are words.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = TEXT_ROWS):
    """Rows per Arrow batch for the actions run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: a lost executor recomputes nothing before this."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(*frames: DataFrame) -> None:
    """Deletes the files of staged() tables that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tidemark/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
    # plans that nothing refers to take their shuffle files and broadcasts with them
    for df in frames[:1]:
        df.sparkSession._jvm.System.gc()


def give_back() -> None:
    """Return a Python worker's free memory to the system. Workers live on idle while stages of the JVM run, and would
    keep the most that any of their batches took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow, which returns its worker's free memory when a task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def small(df: DataFrame, computed: bool = False) -> DataFrame:
    return small_side(df, BROADCAST_BYTES, computed=computed)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # where the package is not installed, Python workers find it beside the driver's
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    return configure(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra ones cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
