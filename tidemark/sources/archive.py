"""Compressed bundles of CSV members.

A zip names its members in a directory at its end, so the reader plans one partition for each member from these
directories alone. A task seeks to its member and streams it; neither an archive nor a member is ever held whole, and
the members of one large archive are read by many tasks.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.text import table_name_of

_BATCH = 20_000
#: Directories that are read at a time while a scan is planned.
_DIRECTORIES = 16
_RECORDS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("record_no", pa.int64()), ("fields", pa.map_(pa.string(), pa.string()))])
_LINES = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The Arrow file system of a path or URI, and the path there."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    return arrow_fs.FileSystem.from_uri(path)


@dataclass
class Member(InputPartition):
    """One member: its archive, its place in the directory, and how much is to be read."""

    archive: str
    index: int
    size: int


class _MemberReader(DataSourceReader):
    def __init__(self, path: str, records: bool):
        self.path, self.records = path, records

    def partitions(self) -> list[Member]:
        files, root = file_system(self.path)
        found = [files.get_file_info(root)]
        if found[0].type == arrow_fs.FileType.Directory:
            found = files.get_file_info(arrow_fs.FileSelector(root, recursive=True))
        archives = sorted(f.path for f in found if f.type == arrow_fs.FileType.File and f.path.endswith(".zip"))

        def members(archive: str) -> list[Member]:
            with files.open_input_file(archive) as raw, zipfile.ZipFile(raw) as bundle:
                return [Member(archive, i, m.compress_size) for i, m in enumerate(bundle.infolist()) if not m.is_dir()]

        with ThreadPoolExecutor(_DIRECTORIES) as pool:
            planned = [m for found in pool.map(members, archives) for m in found]
        # the longest first, so that none starts when all others are done
        return sorted(planned, key=lambda m: -m.size)

    def read(self, partition: Member | None) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Member):
            return
        files, _ = file_system(self.path)
        with files.open_input_file(partition.archive) as raw, zipfile.ZipFile(raw) as bundle:
            info = bundle.infolist()[partition.index]
            archive = partition.archive.rsplit("/", 1)[-1]
            with io.TextIOWrapper(bundle.open(info), encoding="utf-8-sig", newline="" if self.records else None) as text:
                rows = _records(archive, info.filename, text) if self.records else _lines(archive, info.filename, text)
                schema = _RECORDS if self.records else _LINES
                batch = []
                for row in rows:
                    batch.append(row)
                    if len(batch) == _BATCH:
                        yield pa.RecordBatch.from_pylist(batch, schema=schema)
                        batch = []
                if batch:
                    yield pa.RecordBatch.from_pylist(batch, schema=schema)


def _records(archive: str, member: str, text: io.TextIOBase) -> Iterator[dict]:
    """Records as maps of header name to value; quoted values may hold line breaks."""
    reader = csv.reader(text)
    names = [n.strip() for n in next(reader, [])]
    for number, values in enumerate((v for v in reader if v), 1):
        yield {"archive": archive, "member": member, "record_no": number, "fields": [(n, v) for n, v in zip(names, values) if n]}


def _lines(archive: str, member: str, text: io.TextIOBase) -> Iterator[dict]:
    for number, line in enumerate(text, 1):
        yield {"archive": archive, "member": member, "line_no": number, "line": line.rstrip("\r\n")}


class ZipMembers(DataSource):
    """`format("tidemark_zip")`: the CSV members of the zips below a path, as records by header name or as lines."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_zip"

    def _of_records(self) -> bool:
        return self.options.get("as", "records") == "records"

    def schema(self) -> str:
        rest = "record_no long, fields map<string,string>" if self._of_records() else "line_no long, line string"
        return f"archive string, member string, {rest}"

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader(self.options["path"], self._of_records())


def _members(spark: SparkSession, path: str, kind: str) -> DataFrame:
    spark.dataSource.register(ZipMembers)
    return spark.read.format("tidemark_zip").option("as", kind).load(path).withColumn("table_name", table_name_of(F.col("member")))


def zip_records(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, record_no, fields, table_name): records of all members of the zips below `path`, by header name."""
    return _members(spark, path, "records")


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, line_no, line, table_name)."""
    return _members(spark, path, "lines")


def named_members(records: DataFrame, table: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows of one table with `columns`, each from a header name and cast to a type; members may order their columns as
    they like. An empty value, a missing column and one that does not parse are NULL."""
    rows = records.filter(F.col("table_name") == table)
    value = lambda header: F.nullif(F.col("fields")[header], F.lit(""))
    return rows.select("archive", "member", *[value(header).try_cast(kind).alias(name) for name, (header, kind) in columns.items()])


def csv_members(lines: DataFrame, table: str, schema: str) -> DataFrame:
    """Rows of the members that feed one table, by position; line 1 of each member is its header, which is skipped.
    named_members() goes by header names and takes quoted line breaks."""
    rows = lines.filter((F.col("table_name") == table) & (F.col("line_no") > 1) & (F.trim("line") != ""))
    return rows.select("archive", "member", F.from_csv("line", schema).alias("r")).select("archive", "member", "r.*")


def gz_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """gzip members are read by Spark directly; the file name gives the target table. A header that does not have the
    schema's names in its order is an error."""
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, multiLine=True, escape='"')
    name = F.col("_metadata.file_name")
    return rows.withColumns({"source_file": name, "table_name": table_name_of(name)})
