"""Envelopes, XML, row arrays, tagged attributes and key/value snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.arrays import zip_named


def envelope_rows(df: DataFrame, body: str, key: str, item: str) -> DataFrame:
    """Records under `key` of a JSON body, whether it holds a list or one object."""
    raw = F.get_json_object(body, f"$.{key}")
    listed = F.when(raw.startswith("["), raw).when(raw.isNotNull(), F.concat(F.lit("["), raw, F.lit("]")))
    parsed = F.from_json(listed, f"array<struct<{item}>>")
    others = [c for c in df.columns if c != body]
    return df.select(*others, F.explode(parsed).alias("_item")).select(*others, "_item.*")


def read_json_pages(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    pages = spark.read.schema(schema).json(path, multiLine=True)
    return pages.select(F.explode(key).alias("_item")).select("_item.*")


def read_json_documents(spark: SparkSession, path: str, key: str, item: str) -> DataFrame:
    """Records of landed pages, one JSON document per file, printed on one line or many: `page` is the file's name.

    The records lie under `key` as a list or as one object; a page without them has no rows.
    """
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("page"), "value")
    return envelope_rows(pages, "value", key, item)


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Each `row_tag` element is a row, each child tag a text column; a missing text is ''."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return rows.fillna("")


def xml_rows(df: DataFrame, body: str, schema: str, child: str) -> DataFrame:
    """Rows from XML text columns: `schema` declares the root with an array of `child`."""
    parsed = F.from_xml(F.col(body), schema)
    others = [c for c in df.columns if c != body]
    rows = df.select(*others, F.explode(parsed.getField(child)).alias("_item")).select(*others, "_item.*")
    return rows.fillna("")


def row_array_records(df: DataFrame, columns: str, dataset: str, fields: list[str]) -> DataFrame:
    """`columns:[...], dataset:[[...]]` to named fields; cells beyond the names are ignored."""
    others = [c for c in df.columns if c not in (columns, dataset)]
    rows = df.select(*others, columns, F.explode(dataset).alias("_cells"))
    named = rows.withColumn("_map", zip_named(F.col(columns), F.col("_cells")))
    return named.select(*others, *[F.try_element_at("_map", F.lit(f)).alias(f) for f in fields])


def untag(item: Column) -> Column:
    """`{"S": v}` style attribute (a struct of alternatives) to its value as text."""
    return F.coalesce(item["S"], item["N"], item["BOOL"].cast("string"), F.to_json(item["L"]))


def typed_value(kind: Column, payload: Column) -> tuple[Column, Column]:
    """(value text, size) of a key/value entry by its type; an unknown type gives a message and 0."""
    pairs = F.from_json(payload, "map<string,string>")
    items = F.from_json(payload, "array<string>")
    known = kind.isin("list", "set", "zset", "timeseries")
    value = (
        F.when(kind == "string", payload)
        .when(kind == "hash", F.to_json(pairs))
        .when(known, payload)
        .otherwise(F.concat(F.lit("Unsupported type: "), kind))
    )
    size = (
        F.when(kind == "string", F.coalesce(F.length(payload), F.lit(0)))
        .when(kind == "hash", F.size(pairs))
        .when(known, F.size(items))
        .otherwise(0)
    )
    return value, size


def wide_cells(df: DataFrame, row_key: str, cells: str, family: str, columns: dict[str, str]) -> DataFrame:
    """`family:qualifier` byte cells decoded and cast to named columns beside the row key."""
    text = lambda q: F.decode(F.try_element_at(F.col(cells), F.lit(f"{family}:{q}")), "UTF-8")
    return df.select(row_key, *[text(q).try_cast(t).alias(q) for q, t in columns.items()])


def promote_document_id(df: DataFrame, path: str, name: str = "id") -> DataFrame:
    """Document id moved to the front under a plain name."""
    rest = [c for c in df.columns if c != path.split(".")[0]]
    return df.select(F.col(path).alias(name), *rest)
