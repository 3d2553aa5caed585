"""Schema and key checks on the data itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coercion import lenient_cast, logical_type
from tidemark.operators.ordering import carry_forward


def key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count, distinct keys and null keys of a candidate key.

    Grouping by the key first combines hot keys on the map side, which a distinct count would not.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    stats = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count_if(~null_key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_keys"),
    )
    unique = (F.col("row_count") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return stats.withColumn("is_key", unique)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def convert_table(df: DataFrame, source_types: dict[str, tuple]) -> DataFrame:
    """Every column cast by a source-type map; `(type, precision, scale)` per column."""
    return df.select(*[_converted(df, c, t).alias(c) for c, t in source_types.items()])


def _converted(df: DataFrame, name: str, source_type: tuple) -> Column:
    return lenient_cast(F.col(name), df.schema[name].dataType, logical_type(*source_type))


def conversion_losses(df: DataFrame, source_types: dict[str, tuple]) -> DataFrame:
    """Per column, how many non-null values the conversion would lose; one pass for all columns."""
    lost = [
        F.struct(F.lit(c).alias("column_name"), F.lit(logical_type(*t)).alias("target_type"), F.col(f"_{c}").alias("lost"))
        for c, t in source_types.items()
    ]
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & _converted(df, c, t).isNull()).alias(f"_{c}")
            for c, t in source_types.items()
        ]
    )
    return counts.select(F.inline(F.array(*lost)))


def schema_text_stats(lines: DataFrame, document: str, order: list[str], block: Column) -> DataFrame:
    """Type name and field count from schema text lines (`type Name {`, `field: Kind`, `}`)."""
    text = F.trim("line")
    opens = text.startswith("type ") & ~text.rlike("^type (Query|Mutation)")
    name = F.trim(F.regexp_replace(F.element_at(F.split(text, r"\s+"), 2), r"\{", ""))
    marker = F.when(opens, name).when(text == "}", F.lit(""))
    carried = carry_forward(lines, [document], order, block, {"type_name": marker})
    inside = carried.filter((F.coalesce("type_name", F.lit("")) != "") & ~opens)
    is_field = text.contains(":") & ~text.startswith("@")
    heads = carried.filter(opens).select(document, "type_name", F.lit(0).alias("_f"))
    fields = inside.select(document, "type_name", F.when(is_field, 1).otherwise(0).alias("_f"))
    return heads.unionByName(fields).groupBy(document, "type_name").agg(F.sum("_f").alias("field_count"))


def share_catalog(listing: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(shares, schemas, tables) from nested share listings."""
    shares = listing.select("share").distinct()
    nested = listing.select("share", F.explode("schemas").alias("s"))
    schemas = nested.select("share", F.col("s.name").alias("schema_name")).distinct()
    tables = nested.select("share", F.col("s.name").alias("schema_name"), F.explode("s.tables").alias("table_name"))
    return shares, schemas, tables
