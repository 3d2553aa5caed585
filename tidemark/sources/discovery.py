"""Finding the files of a run."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import cut_lineage

#: Files that one read, and one commit, takes.
FILES_AT_ONCE = 10_000


def listing(spark: SparkSession, path: str, pattern: str | None = None, glob: str | None = None) -> DataFrame:
    """(name, path, length, modified) of the files below a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", F.col("modificationTime").alias("modified")
    )
    return files.filter(F.col("name").rlike(pattern)) if pattern else files


def newest_file(files: DataFrame) -> DataFrame:
    best = files.agg(F.max_by(F.struct(*files.columns), F.struct("modified", "name")).alias("f"))
    return best.filter(F.col("f").isNotNull()).select("f.*")


def unseen_files(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files not yet processed, in name order."""
    return files.join(processed.select("name"), "name", "left_anti").orderBy("name")


def path_batches(unseen: DataFrame, size: int = FILES_AT_ONCE) -> Iterator[list[str]]:
    """The paths of `unseen` (name, path) in order of name and path, at most `size` at a time: a reader needs its paths on the
    driver, but never those of a whole backlog."""
    unseen = cut_lineage(unseen.select("name", "path"))
    place, last = F.struct("name", "path"), None
    while True:
        rest = unseen if last is None else unseen.filter(place > F.struct(F.lit(last["name"]), F.lit(last["path"])))
        batch = rest.orderBy("name", "path").limit(size).collect()
        if not batch:
            return
        yield [r["path"] for r in batch]
        last = batch[-1]
