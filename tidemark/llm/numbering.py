"""Row numbers within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows that are numbered together in one window, on average.
BLOCK = 4096


def numbered(df: DataFrame, key: str, row: str, name: str, total: int) -> DataFrame:
    """`df` with `name`: 0, 1, ... without gaps within each `key`. `row` tells rows apart and must be stable (from a
    staged table). Rows are numbered within blocks by hash of `row`, and the blocks' sizes are added up before."""
    block = F.pmod(F.xxhash64(F.col(row)), F.lit(total // BLOCK + 1)).alias("_block")
    rows = df.withColumn("_block", block)
    sizes = rows.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    here = F.row_number().over(Window.partitionBy(key, "_block").orderBy(row)) - 1
    return rows.withColumn("_here", here).join(offsets, [key, "_block"]).withColumn(name, F.col("_here") + F.col("_before")).drop("_block", "_here", "_before")


def by_ranges(value: Column, bounds: list[tuple[int, object]]) -> Column:
    """The label of the first bound that lies above the value."""
    out = F.lit(bounds[-1][1])
    for above, label in reversed(bounds[:-1]):
        out = F.when(value < above, F.lit(label)).otherwise(out)
    return out
