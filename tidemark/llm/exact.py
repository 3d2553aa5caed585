"""Exact duplicates by progressive refinement: length, then a hash of the first bytes, then the full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import own_columns, small, staged, text_or_empty

#: Characters of the text that the second level hashes.
PREFIX = 64


def _signature(text: Column) -> list[Column]:
    return [F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("head")]


def suspects(df: DataFrame) -> DataFrame:
    """(length, head) pairs that more than one row of `df` (text) has; lengths that one row has are settled before."""
    marks = staged(own_columns(df, "text").select(*_signature(text_or_empty())), "signatures")
    lengths = marks.groupBy("length").count().where("count > 1").select("length")
    again = marks.join(small(staged(lengths, "lengths"), computed=True), "length", "left_semi")
    return staged(again.groupBy("length", "head").count().where("count > 1").select("length", "head"), "suspects")


def groups(df: DataFrame, *keys: str) -> DataFrame:
    """Sets of equal texts: digest (of the whole text, read for suspects only), keep_id, group_size; staged."""
    text = text_or_empty()
    rows = own_columns(df, "doc_id", "text").select("doc_id", text.alias("text"), *_signature(text))
    full = rows.join(small(suspects(df), computed=True), ["length", "head"], "left_semi").select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    return staged(full.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "groups")


def exact_duplicates(df: DataFrame) -> DataFrame:
    """For each row of `df` (doc_id, text; others ignored): doc_id, keep_id, group_size, kept, text_sha256.

    Equal means identical without any change; a null text counts as empty. The row with the largest doc_id stays; rows
    that repeat that doc_id and text stay too. A null doc_id is smaller than all others. An empty table gives no rows.
    """
    digest = F.unhex(F.sha2(text_or_empty(), 256))
    rows = staged(own_columns(df, "doc_id", "text").select("doc_id", digest.alias("digest")), "digests")
    found = rows.join(small(groups(df), computed=True), "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_duplicates(df: DataFrame) -> DataFrame:
    """The rows of `df` (doc_id, text, ...) that exact_duplicates() keeps, with all their columns; texts are not shuffled
    unless the sets of equal texts are too many to broadcast."""
    sets = small(groups(df), computed=True).select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size"))
    marked = df.withColumn("_digest", F.unhex(F.sha2(text_or_empty(), 256))).join(sets, "_digest", "left")
    return marked.where(F.col("_size").isNull() | F.col("doc_id").eqNullSafe(F.col("_keep"))).select(*[F.col(f"`{c}`") for c in df.columns])
