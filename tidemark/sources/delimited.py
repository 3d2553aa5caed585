"""Delimited text: sniffed delimiter, declared layouts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.archive import file_system

CANDIDATES = [",", ";", "\t", "|"]
_HEAD = 4096


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line): the first line of each file that is not empty, read from its first bytes alone; tasks open the
    files, packed or not."""
    files = spark.read.format("binaryFile").load(path).select("path")  # contents are not read for this column

    def first_line(name: str) -> str:
        system, at = file_system(name)
        head = b""
        with system.open_input_stream(at) as raw:
            while b"\n" not in head and (piece := raw.read(_HEAD)):
                head += piece
        return head.decode("utf-8", "replace").removeprefix("\ufeff").split("\n", 1)[0].rstrip("\r")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [first_line(name) for name in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], ["path", "line"])

    return files.mapInArrow(read, "path string, line string")


def sniff(spark: SparkSession, path: str, default: str = ",") -> str:
    """The candidate delimiter seen most in the header lines; an error if the files' headers disagree."""
    counts = [F.struct(F.length(F.regexp_replace("line", f"[^{d}]", "")).alias("n"), F.lit(-i).alias("rank"), F.lit(d).alias("delimiter")) for i, d in enumerate(CANDIDATES)]
    best = F.greatest(*counts)
    found = [r[0] for r in header_lines(spark, path).select(F.when(best["n"] > 0, best["delimiter"]).alias("d")).filter("d IS NOT NULL").distinct().collect()]
    if len(found) > 1:
        raise ValueError(f"header lines below {path} use different delimiters: {sorted(found)}")
    return found[0] if found else default


def breaks_lines(spark: SparkSession, path: str, separator: str) -> bool:
    """Whether a quoted value may go on into the next line: some line has a quote that does not open a value at its
    begin or close it at its end. Without such a line every line is whole, and files can be read in splits."""
    parts = F.split("value", '"')
    last = F.size(parts) - 1
    # every other part is outside of quotes; nothing there means a doubled quote, or a value at the line's edge
    stray = lambda part, i: (i % 2 == 0) & (part != "") & ~(((i == 0) | part.startswith(separator)) & ((i == last) | part.endswith(separator)))
    odd = (last % 2 == 1) | F.exists(F.transform(parts, lambda part, i: stray(part, i)), lambda bad: bad)
    return not spark.read.text(path).where(F.contains("value", F.lit('"'))).where(odd).limit(1).isEmpty()


def read_with_header(spark: SparkSession, path: str, delimiter: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Header CSV, every value a string; blank headers are dropped and a byte-order mark removed.

    Quoted values may hold line breaks. Whether some do is found by one pass over the lines, unless `multi_line` says
    it: only then is a file one task, otherwise large files are read in splits.
    """
    separator = delimiter or sniff(spark, path)
    whole = breaks_lines(spark, path, separator) if multi_line is None else multi_line
    df = spark.read.csv(path, sep=separator, header=True, inferSchema=False, multiLine=whole, escape='"')
    names = {c: c.lstrip("\ufeff").strip() for c in df.columns}
    # a blank header is named _c and its position by the reader
    kept = [c for i, c in enumerate(df.columns) if names[c] and names[c] != f"_c{i}"]
    return df.select(*[F.col(f"`{c}`").alias(names[c]) for c in kept])


def read_layout(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headerless TSV by a named layout; short rows leave the trailing columns NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep="\t", schema=schema, mode="PERMISSIVE", header=False)
