"""Deterministic keys and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def md5_key(*parts: Column, separator: str = "|") -> Column:
    return F.md5(F.concat_ws(separator, *[p.cast("string") for p in parts]))


def message_id(queue: Column, tag: Column, body: Column) -> Column:
    """`queue_tag_` plus the first 16 hex digits of the content hash."""
    content = F.concat_ws(":", queue, tag.cast("string"), body)
    return F.concat_ws("_", queue, tag.cast("string"), F.substring(F.sha2(content, 256), 1, 16))


def sorted_json(fields: Column) -> Column:
    """JSON object text of a string map with keys in order, ', ' and ': ' between parts."""
    entries = F.sort_array(F.map_entries(fields))
    quoted = lambda s: F.concat(F.lit('"'), F.regexp_replace(s, r'(["\\])', r"\\$1"), F.lit('"'))
    pairs = F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])))
    return F.concat(F.lit("{"), F.concat_ws(", ", pairs), F.lit("}"))


def document_id(fields: Column) -> Column:
    """`id`, else `_id`, else a hash of the whole document (a string map)."""
    return F.coalesce(
        F.try_element_at(fields, F.lit("id")),
        F.try_element_at(fields, F.lit("_id")),
        F.sha2(sorted_json(fields), 256),
    )


def series_id(name: Column, labels: Column) -> Column:
    """md5 of `name{k=v,...}` with the labels sorted by name."""
    pairs = F.transform(F.sort_array(F.map_entries(labels)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.md5(F.concat(name, F.lit("{"), F.concat_ws(",", pairs), F.lit("}")))


def composite(separator: str, *parts: Column) -> Column:
    return F.concat_ws(separator, *[p.cast("string") for p in parts])


def location_id(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws("_", F.round(latitude, 6).cast("string"), F.round(longitude, 6).cast("string"))


def search_id(name: Column, keywords: Column, timeframe: Column) -> Column:
    """Readable id: name slug, timeframe, and a short hash of the sorted keywords."""
    from tidemark.functions.text import slug

    words = F.transform(F.sort_array(keywords), lambda k: F.concat(F.lit("'"), k, F.lit("'")))
    config = F.concat(F.lit("["), F.concat_ws(", ", words), F.lit("]_"), timeframe)
    frame = F.regexp_replace(timeframe, "[ /]", "_")
    return F.concat_ws("_", slug(name), frame, F.substring(F.md5(config), 1, 8))


def content_key(*columns: Column) -> Column:
    """Stable row id from column values; NULL and the text 'null' stay apart in JSON."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    return df.withColumn(name, content_key(*[F.col(c) for c in df.columns]))
