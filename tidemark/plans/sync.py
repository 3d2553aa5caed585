"""Table synchronisation flows built from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.changes import drifted_hours, rows_of_hours
from tidemark.operators.incremental import after_pair, next_cursor
from tidemark.operators.ordering import keep_one
from tidemark.session import cut_lineage, scalar
from tidemark.sinks.merge import upsert
from tidemark.sinks.versioned import VersionedTable
from tidemark.spec import ReadPlan, TableSpec


def sync_batch(target: DataFrame, source: DataFrame, keys: list[str], cursor: str, last, last_key, order: list[str]) -> DataFrame:
    """Target after merging the source rows past a compound cursor."""
    fresh = after_pair(source, cursor, keys[0], last, last_key)
    return upsert(target, fresh, keys, order)


def sync_table(source: DataFrame, table: VersionedTable, spec: TableSpec, plan: ReadPlan) -> dict:
    """Read from the saved cursor on, conform, merge, and commit rows and cursor together.

    The saved cursor itself is read again, as rows may arrive later with the same value; the merge absorbs repeats.
    Of rows with one key and cursor, the one with the largest content hash wins, in every run.
    """
    saved = table.state().get(plan.table, {})
    low = saved.get("cursor", plan.low)
    if "cursor" in saved:
        kind = source.schema[plan.cursor].dataType
        source = source.filter(F.col(plan.cursor) >= F.lit(low).cast(kind))
    bounded = ReadPlan(plan.table, plan.include, plan.exclude, plan.cursor, None if "cursor" in saved else low, plan.high, plan.predicate)
    batch = cut_lineage(spec.conform(bounded.apply(source)).withColumn("_tie", F.xxhash64(F.to_json(F.struct("*")))))
    # Compared as the column's type; kept as text because the state is JSON.
    cursor = scalar(next_cursor(batch, plan.cursor, low).select(F.col("cursor").cast("string")))
    state = {plan.table: {"cursor": cursor}}
    if table.manifest() is None:
        table.replace(keep_one(batch, list(spec.primary_key), [plan.cursor, "_tie"], "last").drop("_tie"), state)
    else:
        table.merge(batch, [plan.cursor, "_tie"], state=state)
    return state


def repair_and_sync(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    ts: str,
    entity: Column,
    cursor: Column,
    now_counts: DataFrame,
    last_counts: DataFrame,
    since: Column,
    until: Column,
) -> DataFrame:
    """One plan: rows after the cursor plus all rows of drifted hours, merged once by key. The last run counted the
    hours in [since, until)."""
    fresh = source.filter(F.col(ts) >= cursor)
    again = rows_of_hours(source.filter(F.col(ts) < cursor), ts, entity, drifted_hours(now_counts, last_counts, since, until))
    return upsert(target, fresh.unionByName(again), keys, [ts])
