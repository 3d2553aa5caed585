"""User transform hooks: plain Python functions on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def apply_batch_hook(df: DataFrame, hook: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str) -> DataFrame:
    """What `hook` makes of each batch of rows; a hook may keep fewer rows, more, or none.

    Columns come out by name and are cast to `schema`, so their order in the hook's result does not matter; a missing
    one is an error. Use column expressions where they can say the same: this path leaves the JVM.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = hook(batch)
            if out is not None and out.num_rows:
                yield from pa.table([out.column(name) for name in fields.names], names=fields.names).cast(fields).to_batches()

    return df.mapInArrow(run, schema)


def apply_hook(df: DataFrame, hook: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Rows of `hook(record)` for every record; a hook may drop a record or emit several. A missing field is NULL.

    NULL is None in a record and whole numbers stay whole. A call for each record is slow; apply_batch_hook() is not.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def each(batch: pa.RecordBatch) -> pa.Table:
        return pa.Table.from_pylist([out for record in batch.to_pylist() for out in hook(record)], schema=fields)

    return apply_batch_hook(df, each, schema)
