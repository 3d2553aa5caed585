"""Text files as ordered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import decode_cp1252
from tidemark.session import cut_lineage, small_side


def plain_path(path: Column) -> Column:
    """One spelling for a file's path, however many slashes follow the scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8", by_path: bool = False) -> DataFrame:
    """(file, block, seq, line): the file split's start offset and the line's place in that split.

    `(block, seq)` is the order of lines within a file, and `block` the slice that ordered scans work
    on, so even one huge file is read and scanned by many tasks. `by_path` names files by their whole
    path, for folders that repeat file names. Files are split by the cores at hand, so positions can differ between two
    jobs; what compares them across jobs uses fixed_lines().
    """
    raw = spark.read.text(path).select(
        (plain_path(F.col("_metadata.file_path")) if by_path else F.col("_metadata.file_name")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    return raw.withColumn("line", decode_cp1252(F.col("line"))) if encoding == "cp1252" else raw


def fixed_lines(lines: DataFrame) -> DataFrame:
    """The lines written once, so that every later job sees the same positions."""
    return cut_lineage(lines)


def detail_lines(lines: DataFrame, fixed: bool = False) -> DataFrame:
    """Non-blank lines without the first (header) and last (trailer) of each file. `fixed` says that the lines come from
    fixed_lines()."""
    full = (lines if fixed else fixed_lines(lines)).filter(F.trim("line") != "")
    place = F.struct("block", "seq")
    ends = small_side(full.groupBy("file").agg(F.min(place).alias("_first"), F.max(place).alias("_last")))
    return full.join(ends, "file").filter((place > F.col("_first")) & (place < F.col("_last"))).drop("_first", "_last")
