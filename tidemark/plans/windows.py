"""Time windows as rows, generated with sequences beside the entity they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def closed_windows(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Closed windows [from, min(from + days, end)]; the next one starts a day after."""
    starts = F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {days + 1} DAYS"))
    rows = df.filter(F.col(start) <= F.col(end)).withColumn("window_from", F.explode(starts))
    return rows.withColumn("window_to", F.least(F.date_add("window_from", days), F.col(end)))


def exclusive_end(windows: DataFrame) -> DataFrame:
    """End pushed by one day for a consumer that treats it as exclusive."""
    return windows.withColumn("window_to", F.date_add("window_to", 1))


def half_open_windows(df: DataFrame, start: str, now: Column, days: int) -> DataFrame:
    """Contiguous [from, to) windows up to now."""
    step = F.expr(f"INTERVAL {days} DAYS")
    rows = df.withColumn("_now", now).filter(F.col(start) < F.col("_now"))
    rows = rows.withColumn("window_from", F.explode(F.sequence(F.col(start), F.col("_now"), step)))
    rows = rows.filter(F.col("window_from") < F.col("_now"))
    return rows.withColumn("window_to", F.least(F.col("window_from") + step, F.col("_now"))).drop("_now")


def backfill_windows(df: DataFrame, ts: str, anchor: Column, days: int, max_empty: int) -> DataFrame:
    """Windows going back from the anchor with row counts, up to the first run of `max_empty` empty
    ones. Rows are counted per window first, so ordering only sees one row per window."""
    micros = F.unix_micros(anchor) - F.unix_micros(F.col(ts))
    width = days * 86_400_000_000
    number = (F.floor((micros - 1) / F.lit(width))).cast("bigint").alias("window_no")
    counted = df.filter(F.col(ts) < anchor).groupBy(number).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )
    order = Window.orderBy("window_no")
    gap = F.col("window_no") - F.coalesce(F.lag("window_no").over(order), F.lit(-1)) - 1
    stops = F.sum(F.when(gap >= max_empty, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("_stops", stops).filter(F.col("_stops") == 0).drop("_stops")


def calendar(df: DataFrame, start: str, end: str, name: str = "business_date") -> DataFrame:
    """One row per day, both ends included."""
    return df.withColumn(name, F.explode(F.sequence(F.to_date(start), F.to_date(end))))


def next_range(state: DataFrame, last_to: str, initial: Column, now: Column, days: int) -> DataFrame:
    """Next sync range: from the last end (or the initial start) to at most `days` later."""
    start = F.coalesce(F.col(last_to), initial)
    return state.withColumns({"range_from": start, "range_to": F.least(start + F.expr(f"INTERVAL {days} DAYS"), now)})


def window_state(windows: DataFrame, df: DataFrame, ts: str) -> DataFrame:
    """Rows read per half-open window and the cursor after it."""
    from tidemark.operators.joins import in_windows

    found = in_windows(df, ts, windows.withColumnsRenamed({"window_from": "gte", "window_to": "lt"}))
    counted = found.groupBy("gte", "lt").agg(F.count(F.lit(1)).alias("n"))
    joined = windows.select(F.col("window_from").alias("gte"), F.col("window_to").alias("lt")).join(counted, ["gte", "lt"], "left")
    return joined.select("gte", F.col("lt").alias("cursor"), F.coalesce("n", F.lit(0)).alias("n"))
