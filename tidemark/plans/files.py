"""Flow of one fixed-width table: find new files, check, parse, mark deletions, commit."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.changes import soft_deletes
from tidemark.operators.ordering import keep_one
from tidemark.operators.quality import trailer_check, whole_files
from tidemark.session import cut_lineage, small_side
from tidemark.sinks.group import TableGroup
from tidemark.sinks.versioned import VersionedTable
from tidemark.sources import discovery
from tidemark.sources.fixed_width import FixedField, parse
from tidemark.sources.lines import fixed_lines, plain_path, read_lines

#: The order of rows: by file, then by line.
PLACE = ("file", "_block", "_seq")
#: The table of processed files beside each loaded table.
LEDGER = "files"


@dataclass(frozen=True)
class FileSpec:
    fields: tuple[FixedField, ...]
    pattern: str
    trailer_start: int
    trailer_length: int
    trailer_includes_header: bool = True
    purge: bool = False
    encoding: str = "cp1252"


def accepted_rows(lines: DataFrame, spec: FileSpec) -> tuple[DataFrame, DataFrame]:
    """(typed rows of files whose trailer count and every line are right, with their place; status per file)."""
    lines = fixed_lines(lines.withColumnsRenamed({"block": "_block", "seq": "_seq"}))
    verdicts = trailer_check(lines, "file", ["_block", "_seq"], spec.trailer_start, spec.trailer_length, spec.trailer_includes_header)
    status = cut_lineage(verdicts.select("file", "status"))
    ok = small_side(status.filter(F.col("status") == "ok").select("file"), computed=True)
    mine = lines.join(ok, "file", "left_semi").withColumns({"block": F.col("_block"), "seq": F.col("_seq")})
    parsed = parse(mine, list(spec.fields), fixed=True, keep=PLACE[1:])
    good, failed = whole_files(parsed, "file", F.col("malformed"))
    bad = failed.select("file", F.lit("malformed").alias("status"))
    merged = status.join(bad.withColumnRenamed("status", "_bad"), "file", "left")
    return good.drop("malformed"), merged.select("file", F.coalesce("_bad", "status").alias("status"))


def file_tables(spark: SparkSession, path: str, name: str, keys: list[str], buckets: int = 16) -> TableGroup:
    """A table and the ledger of the files it was loaded from."""
    return TableGroup(spark, path, {name: keys, LEDGER: ["file"]}, buckets)


def _load(table: VersionedTable, ledger: VersionedTable, rows: DataFrame, files: DataFrame) -> None:
    """Rows and ledger entries, into tables that may not exist yet."""
    if table.manifest() is None:
        table.replace(keep_one(rows, table.keys, list(PLACE), "last").drop(*PLACE))
    else:
        table.merge(rows, list(PLACE))
    if ledger.manifest() is None:
        ledger.replace(files.select("file"))
    else:
        ledger.merge(files.select("file"), ["file"])


def sync_files(spark: SparkSession, folder: str, group: TableGroup, name: str, spec: FileSpec) -> DataFrame:
    """Load the files that the ledger of `group` does not have, all or nothing per file; (file, status) of this run.

    The file name last in order wins a key, and within a file the last line. Files are read in batches; rows and ledger
    entries of a batch are one commit. A failed file gets no entry and is tried again in the next run. With `purge` the files
    of a run together are the whole table: they are one commit, keys they no longer have stay as rows flagged
    deleted, and nothing is committed while one of them is bad, since a gap would look like deletions.
    """
    found = discovery.listing(spark, folder, spec.pattern).withColumn("name", plain_path(F.col("path")))
    if group.has(LEDGER):
        found = discovery.unseen_files(found, group.read(LEDGER).withColumnRenamed("file", "name"))
    loads = []
    for paths in discovery.path_batches(found, discovery.FILES_AT_ONCE):
        good, status = accepted_rows(read_lines(spark, paths, spec.encoding, by_path=True), spec)
        status = cut_lineage(status)
        ok = status.filter(F.col("status") == "ok")
        loads.append((good, status))
        if not spec.purge and not ok.isEmpty():
            with group.commit() as tables:
                _load(tables[name], tables[LEDGER], good, ok)
    if not loads:
        return spark.createDataFrame([], "file string, status string")
    result = reduce(DataFrame.unionByName, [status for _, status in loads])
    if spec.purge and result.filter(F.col("status") != "ok").isEmpty():
        with group.commit() as tables:
            table, ledger = tables[name], tables[LEDGER]
            rows = keep_one(reduce(DataFrame.unionByName, [good for good, _ in loads]), table.keys, list(PLACE), "last").drop(*PLACE)
            rows = cut_lineage(rows)
            previous = table.read().select(*table.keys) if table.manifest() else rows.select(*table.keys).limit(0)
            table.replace(soft_deletes(previous, rows, table.keys))
            if ledger.manifest() is None:
                ledger.replace(result.select("file"))
            else:
                ledger.merge(result.select("file"), ["file"])
    return result
