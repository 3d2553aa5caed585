"""Property graphs as vertex and edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.keys import composite
from tidemark.operators.explode import multi_valued


def vertices(parts: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(id, label, name) from `{label: (table, key, name column)}`; ids are `label:key`."""
    frames = [
        df.select(composite(":", F.lit(label), F.col(key)).alias("id"), F.lit(label).alias("label"), F.col(name).alias("name"))
        for label, (df, key, name) in parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def edges(df: DataFrame, label: str, src: tuple[str, str], dst: tuple[str, str]) -> DataFrame:
    """(edge_id, edge_label, src_id, dst_id) from a table that holds both keys."""
    source = composite(":", F.lit(src[0]), F.col(src[1]))
    target = composite(":", F.lit(dst[0]), F.col(dst[1]))
    return df.select(
        composite(f"_{label}_", source, target).alias("edge_id"),
        F.lit(label).alias("edge_label"),
        source.alias("src_id"),
        target.alias("dst_id"),
    )


def split_properties(df: DataFrame, key: str, properties: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(vertices with the first value of each property, rows of the multi-valued ones)."""
    first = [F.try_element_at(F.try_element_at(properties, F.lit(n)), F.lit(1)).alias(n) for n in names]
    others = [c for c in df.columns if c != properties]
    return df.select(*others, *first), multi_valued(df, [key], properties, "property")
