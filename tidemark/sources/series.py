"""Time-series shapes to point rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coercion import float_text
from tidemark.functions.dates import from_epoch
from tidemark.functions.keys import series_id


def parallel_arrays(df: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """`time[], v1[], v2[]` by position; a short or missing array gives NULL, never an error."""
    rows = df.select(*keys, *values, F.posexplode(time).alias("position", "point_time"))
    return rows.select(*keys, "position", "point_time", *[F.get(v, F.col("position")).alias(v) for v in values])


def range_vector(df: DataFrame, name: str = "name", labels: str = "labels", values: str = "values") -> DataFrame:
    """Matrix result to one row per point with the series id, UTC time and numeric value."""
    rows = df.select(name, labels, F.explode(values).alias("p"))
    return rows.select(
        series_id(F.col(name), F.col(labels)).alias("series_id"),
        name,
        labels,
        from_epoch(F.col("p")["ts"]).alias("point_time"),
        float_text(F.col("p")["value"]).alias("value"),
    )
