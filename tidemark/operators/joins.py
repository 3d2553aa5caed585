"""Lookups, nesting and graph-shaped joins. Broadcasts are left to Spark's own size checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.ordering import top_n_per

#: Slices of a calendar bucket's rows in a join with windows, and its tasks for each partition of a shuffle.
SLICES = 16
TASKS_PER_PARTITION = 4


def with_parent(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> DataFrame:
    """Children that have a parent, with the parent's columns."""
    return children.join(parents.withColumnRenamed(key, child_key), child_key)


def lookup(df: DataFrame, dimension: DataFrame, key: str, dim_key: str, label: str, name: str, prefix: str) -> DataFrame:
    """Label from a dimension, or `prefix` + id where the dimension has no row."""
    dim = dimension.select(F.col(dim_key).alias(key), F.col(label).alias("_label"))
    fallback = F.concat(F.lit(prefix), F.col(key).cast("string"))
    return df.join(dim, key, "left").withColumn(name, F.coalesce("_label", fallback)).drop("_label")


def catalog(columns: DataFrame, keys: DataFrame, tables: DataFrame) -> DataFrame:
    """Column metadata with key membership, restricted to known tables."""
    flagged = keys.select("table_name", "column_name").withColumn("is_key", F.lit(True))
    joined = columns.join(flagged, ["table_name", "column_name"], "left").join(tables, "table_name")
    return joined.withColumn("is_key", F.coalesce("is_key", F.lit(False)))


def nest_top(parents: DataFrame, children: DataFrame, key: str, order: list, fields: list[str], n: int, name: str) -> DataFrame:
    """Parents with their first n children as an ordered array; n bounds every group."""
    ranked = top_n_per(children, [key], order, n, rank="_rank")
    items = ranked.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias("_items")
    )
    listed = items.select(key, F.transform("_items", lambda i: F.struct(*[i[f].alias(f) for f in fields])).alias(name))
    return parents.join(listed, key, "left")


def mapping_rows(spark, mapping: str, key: str = "code", value: str = "member") -> DataFrame:
    """`code:a,b|code2:c` configuration text to (code, member) rows; parts without ':' are skipped."""
    text = spark.range(1).select(F.explode(F.split(F.lit(mapping), r"\|")).alias("part"))
    parts = text.filter(F.col("part").contains(":"))
    members = F.split(F.regexp_replace("part", "^[^:]*:", ""), ",")
    rows = parts.select(F.trim(F.substring_index("part", ":", 1)).alias(key), F.explode(members).alias(value))
    return rows.withColumn(value, F.trim(value))


def enrich_by_mapping(df: DataFrame, mapping: DataFrame, key: Column, code: str, member: str, default: str) -> DataFrame:
    """Members joined into one text per code; codes without a mapping take the default."""
    listed = mapping.groupBy(code).agg(F.concat_ws(",", F.sort_array(F.collect_list(member))).alias("members"))
    return (
        df.withColumn(code, key)
        .join(listed, code, "left")
        .withColumn("members", F.coalesce("members", F.lit(default)))
    )


def both_opinions(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Rows judged by both sides, with an agreement flag."""
    a = left.select(key, F.col(value).alias("first_opinion"))
    b = right.select(key, F.col(value).alias("second_opinion"))
    return a.join(b, key).withColumn("disagree", F.col("first_opinion") != F.col("second_opinion"))


def task_grid(entities: DataFrame, key: str, steps: Column, step: str) -> DataFrame:
    """Every entity with every step of a generated sequence; the sequence is exploded per row."""
    return entities.select(key, F.explode(steps).alias(step))


def fill_grid(grid: DataFrame, facts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counted facts on a grid, zero where nothing was counted."""
    return grid.join(facts, keys, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def triplets(vertices: DataFrame, edges: DataFrame, label: str | None = None) -> DataFrame:
    """`(a)-[r]->(b)` rows. Vertices are unique by id, so a hot vertex only repeats on the edge side,
    where the skew join splits it."""
    e = edges if label is None else edges.filter(F.col("edge_label") == label)
    src = vertices.select(F.col("id").alias("src_id"), F.col("label").alias("src_label"), F.col("name").alias("src_name"))
    dst = vertices.select(F.col("id").alias("dst_id"), F.col("label").alias("dst_label"), F.col("name").alias("dst_name"))
    return e.join(src, "src_id").join(dst, "dst_id")


def reference_id(ref: Column) -> Column:
    """'Type/123' -> '123'."""
    return F.element_at(F.split(ref, "/"), -1)


def in_windows(df: DataFrame, ts: str, windows: DataFrame, unit: str = "day") -> DataFrame:
    """Rows assigned to the half-open [gte, lt) windows that hold them.

    Each window is spread over the calendar buckets it touches, so the join is an equi join on the
    bucket with a range check, never a cross product. Rows of a bucket are dealt over SLICES, each of which gets the
    bucket's windows, so a few busy buckets keep all cores at work.
    """
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    last = F.col("lt") - F.expr("INTERVAL 1 MICROSECOND")
    buckets = F.sequence(F.date_trunc(unit, "gte"), F.date_trunc(unit, last), step)
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long")))
    spread = windows.withColumn("_bucket", F.explode(buckets)).withColumn("_slice", slices)
    place = F.pmod(F.xxhash64(*[F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]), F.lit(SLICES)).cast("long")
    # a number of its own, since tasks are not to be put together by their bytes: few rows make many pairs
    tasks = TASKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({"_bucket": F.date_trunc(unit, F.col(ts)), "_slice": place}).repartition(tasks, "_bucket", "_slice")
    hit = (F.col(ts) >= F.col("gte")) & (F.col(ts) < F.col("lt"))
    return keyed.join(spread.hint("shuffle_hash"), ["_bucket", "_slice"]).filter(hit).drop("_bucket", "_slice")
