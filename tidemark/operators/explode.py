"""Arrays and maps to child, link and property tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def child_rows(df: DataFrame, keys: list[str], array: str, index: str | None = None, rename: dict | None = None) -> DataFrame:
    """Array of structs to rows carrying the parent keys, with the position if asked for."""
    rename = rename or {}
    parents = [F.col(k).alias(rename.get(k, k)) for k in keys]
    names = [rename.get(k, k) for k in keys]
    if index:
        rows = df.select(*parents, F.posexplode(array).alias(index, "_item"))
        names = [*names, index]
    else:
        rows = df.select(*parents, F.explode(array).alias("_item"))
    kind = df.schema[array].dataType.elementType
    return rows.select(*names, "_item.*") if isinstance(kind, T.StructType) else rows.withColumnRenamed("_item", "value")


def entries(df: DataFrame, keys: list[str], column: str, key: str = "key", value: str = "value") -> DataFrame:
    """Map entries to rows; array values are split further into one row per element."""
    rows = df.select(*keys, F.explode(column).alias(key, value))
    if isinstance(df.schema[column].dataType.valueType, T.ArrayType):
        rows = rows.withColumn(value, F.explode(value))
    return rows


def multi_valued(df: DataFrame, keys: list[str], column: str, key: str = "key") -> DataFrame:
    """Only map entries with more than one value, one row per (key, position)."""
    rows = df.select(*keys, F.explode(column).alias(key, "_values")).filter(F.size("_values") > 1)
    return rows.select(*keys, key, F.posexplode("_values").alias("position", "value"))


def links(df: DataFrame, left: str, array: str, right: str) -> DataFrame:
    """Many-to-many link table, one row per pair."""
    return df.select(left, F.explode(array).alias(right)).distinct()


def expand(parent: DataFrame, nav: str) -> DataFrame:
    """Child rows of a navigation property (struct or array) inheriting the parent's scalars.

    Where names clash the parent value wins; other nested properties are not inherited.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)
    scalars = [f.name for f in parent.schema.fields if not isinstance(f.dataType, nested)]
    kind = parent.schema[nav].dataType
    item = F.explode(nav) if isinstance(kind, T.ArrayType) else F.col(nav)
    rows = parent.select(*scalars, item.alias("_item")).filter(F.col("_item").isNotNull())
    fields = (kind.elementType if isinstance(kind, T.ArrayType) else kind).fieldNames()
    return rows.select(*scalars, *[F.col("_item").getField(f).alias(f) for f in fields if f not in scalars])


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, name, value)


def deep_rows(df: DataFrame, keys: list[str], items: Column, test) -> DataFrame:
    """Rows from a nested array expression, filtered before they are exploded."""
    return df.select(*keys, F.explode(F.filter(items, test)).alias("item"))
