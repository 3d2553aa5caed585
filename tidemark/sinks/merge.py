"""Keyed destination operations on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import with_row_key
from tidemark.operators.ordering import keep_one
from tidemark.session import cut_lineage, small_side


def matches(keys: list[str], prefix: str) -> Column:
    """Each key equals the other side's prefixed one; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def without_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not among `gone`; NULL equals NULL, so replays of such keys add no copies."""
    other = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    return target.join(other, matches(keys, "_gone_"), "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Insert or replace by key, the last row of the batch by `order` winning.

    The batch alone is deduplicated, once; the target is anti-joined with its keys, which are
    broadcast when they are measured to be few, so a small batch never shuffles a large target.
    """
    final = cut_lineage(keep_one(batch, keys, order, "last").select(*target.columns))
    return without_keys(target, small_side(final.select(*keys), computed=True), keys).unionByName(final)


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return without_keys(target, small_side(gone.select(*keys).distinct()), keys)


def upsert_rows(target: DataFrame, batch: DataFrame, name: str = "row_key") -> DataFrame:
    """Keyless table: the row id is a hash of all values, so exact duplicates collapse.

    A target that has its row ids was built this way and is not shuffled again, only the batch is.
    """
    old = target if name in target.columns else with_row_key(target, name).dropDuplicates([name])
    return upsert(old, with_row_key(batch, name).dropDuplicates([name]), [name], [name])


def evolve(frames: list[DataFrame]) -> DataFrame:
    """Union of the fields of all batches, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def snapshot(df: DataFrame, run: Column, name: str = "fetch_date") -> DataFrame:
    return df.withColumn(name, run)


def latest_snapshot(snapshots: DataFrame, keys: list[str], name: str = "fetch_date") -> DataFrame:
    rest = [c for c in snapshots.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(name)).alias("r")
    return snapshots.groupBy(*keys).agg(best).select(*keys, "r.*")


def audit_row(counts: DataFrame, run_id: str, started: Column, finished: Column) -> DataFrame:
    """One row per run from (entity, n) counts: tables, records and seconds."""
    totals = counts.agg(F.count(F.lit(1)).alias("table_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"))
    seconds = (F.unix_micros(finished) - F.unix_micros(started)) / F.lit(1_000_000.0)
    return totals.select(F.lit(run_id).alias("run_id"), "table_count", "record_count", seconds.alias("duration_seconds"))
