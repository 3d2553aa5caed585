"""Incremental reads. A cursor is a small value held as state; bounds are literals so they push down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.ordering import keep_one, rows_between

# Preferred change-timestamp columns, best first.
PREFERRED_CURSORS = [
    "updated_at",
    "last_updated",
    "last_update",
    "last_modified",
    "modified_at",
    "modified_on",
    "updated_on",
    "update_time",
    "updated",
]


def after(df: DataFrame, cursor: str, last, keep_missing: bool = False) -> DataFrame:
    """Rows strictly after the cursor. `keep_missing` keeps rows without a timestamp."""
    if last is None:
        return df
    kept = F.col(cursor) > F.lit(last)
    return df.filter(kept | F.col(cursor).isNull() if keep_missing else kept)


def at_or_after(df: DataFrame, cursor: str, last) -> DataFrame:
    """Boundary rows come again; the keyed merge absorbs them."""
    return df if last is None else df.filter(F.col(cursor) >= F.lit(last))


def after_pair(df: DataFrame, cursor: str, key: str, last, last_key) -> DataFrame:
    """Rows after (cursor, key); the plain bound is what reaches the scan."""
    c, k = F.col(cursor), F.col(key)
    return df.filter((c >= F.lit(last)) & ((c > F.lit(last)) | ((c == F.lit(last)) & (k > F.lit(last_key)))))


def after_with_seen(df: DataFrame, cursor: str, key: str, last, seen: DataFrame) -> DataFrame:
    """Rows after the cursor, plus boundary rows whose id was not synced yet."""
    newer = df.filter(F.col(cursor) > F.lit(last))
    boundary = df.filter(F.col(cursor) == F.lit(last)).join(seen.select(key).distinct(), key, "left_anti")
    return newer.unionByName(boundary)


def above_mark(df: DataFrame, key: str, mark: int) -> DataFrame:
    return df.filter(F.col(key) > F.lit(mark))


def until_known(df: DataFrame, position: str, known: Column) -> DataFrame:
    """Rows of a newest-first feed before the first known one."""
    cut = df.filter(known).agg(F.min(position)).first()[0]
    return df if cut is None else df.filter(F.col(position) < F.lit(cut))


def with_overlap(df: DataFrame, cursor: str, last: str, overlap: str, key: list[str], order: list) -> DataFrame:
    """Re-read an interval before the cursor and keep the newest row per key."""
    floor = F.lit(last).cast("timestamp") - F.expr(f"INTERVAL {overlap}")
    return keep_one(df.filter(F.col(cursor) > floor), key, order, "last")


def between(df: DataFrame, cursor: str, low, high, closed: str = "right") -> DataFrame:
    """`(low, high]` with closed='right', `[low, high)` with closed='left'."""
    c, lo, hi = F.col(cursor), F.lit(low), F.lit(high)
    return df.filter((c > lo) & (c <= hi)) if closed == "right" else df.filter((c >= lo) & (c < hi))


def two_phase(df: DataFrame, modified: str, created: str, low, high) -> DataFrame:
    """Rows modified in [low, high) as phase 1, and rows only created in it as phase 2.

    Both passes are one scan: a row in both ranges belongs to the first, so nothing is deduplicated.
    """
    inside = lambda c: F.coalesce((F.col(c) >= F.lit(low)) & (F.col(c) < F.lit(high)), F.lit(False))
    rows = df.filter(inside(modified) | inside(created))
    return rows.withColumn("_phase", F.when(inside(modified), 1).otherwise(2))


def stale_tables(versions: DataFrame, state: DataFrame, table: str = "table_name") -> DataFrame:
    """Tables whose source version is past the synced one (never synced counts as -1)."""
    joined = versions.join(state.withColumnRenamed("version", "_last"), table, "left")
    return joined.filter(F.col("version") > F.coalesce("_last", F.lit(-1))).select(*versions.columns)


def per_entity(df: DataFrame, state: DataFrame, entity: str, cursor: str) -> DataFrame:
    """Each entity has its own cursor; an entity without state is read whole."""
    marks = state.select(entity, F.col("cursor").alias("_cursor"))
    joined = df.join(marks, entity, "left")
    return joined.filter(F.col("_cursor").isNull() | (F.col(cursor) > F.col("_cursor"))).drop("_cursor")


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    return F.md5(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}))


def changed_rows(df: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose content hash differs from last run's (`previous` holds keys and row_hash)."""
    current = df.withColumn("row_hash", row_hash(df))
    return current.join(previous.select(*keys, "row_hash"), [*keys, "row_hash"], "left_anti")


def profile_cursors(df: DataFrame) -> DataFrame:
    """One pass over every date or time column: filled values, range and name preference."""
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    if not dated:
        raise ValueError("no date or time column to follow")
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(PREFERRED_CURSORS.index(c.lower()) if c.lower() in PREFERRED_CURSORS else 99).alias("preference"),
                F.col(f"{c}_n").alias("non_null"),
                F.col(f"{c}_lo").cast("string").alias("min_value"),
                F.col(f"{c}_hi").cast("string").alias("max_value"),
            )
            for c in dated
        ]
    )
    stats = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[f(c).alias(f"{c}_{s}") for c in dated for f, s in ((F.count, "n"), (F.min, "lo"), (F.max, "hi"))],
    )
    return stats.select("row_count", F.inline(rows))


def best_cursor(df: DataFrame) -> str | None:
    """The preferred, then the most complete, date or time column; NULL-only columns never qualify."""
    ranked = profile_cursors(df).filter(F.col("non_null") > 0).orderBy("preference", F.desc("non_null"), "column_name")
    row = ranked.first()
    return None if row is None else row["column_name"]


def from_offset(df: DataFrame, order: list[str], offset: int) -> DataFrame:
    """Rows past a row offset in a stable order."""
    return rows_between(df, order, offset + 1, None)


def initial_bound(state_cursor: Column, now: Column, lookback: str) -> Column:
    return F.coalesce(state_cursor, now - F.expr(f"INTERVAL {lookback}"))


def next_cursor(df: DataFrame, cursor: str, previous=None) -> DataFrame:
    """Highest value seen, never behind the previous cursor; an empty batch keeps it."""
    kind = df.schema[cursor].dataType
    return df.agg(F.greatest(F.max(cursor), F.lit(previous).cast(kind)).alias("cursor"))
