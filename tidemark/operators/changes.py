"""Change logs, snapshot differences and delete detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import keep_one
from tidemark.session import cut_lineage, small_side
from tidemark.sinks.merge import without_keys

SPAN = 100_000


def last_change(log: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """The last known operation per key by (commit, intent) order; unknown codes are skipped."""
    return keep_one(log.filter(F.col(op).isin("I", "U", "D")), keys, order, "last")


def apply_log(target: DataFrame, log: DataFrame, keys: list[str], order: list[str], op: str = "op") -> DataFrame:
    """Target after an ordered change log: inserts and updates replace, deletes remove.

    Only the log is reduced by a window; the target takes one anti join on the log's keys, which are
    broadcast when they are measured to be few.
    """
    final = cut_lineage(last_change(log, keys, order, op))
    untouched = without_keys(target, small_side(final.select(*keys), computed=True), keys)
    return untouched.unionByName(final.filter(F.col(op) != "D").select(*target.columns))


def after_position(log: DataFrame, commit: str, intent: str, last_commit, last_intent) -> DataFrame:
    """Log rows strictly after a composite position; the simple bound also reaches the scan."""
    c, i = F.col(commit), F.col(intent)
    return log.filter((c >= F.lit(last_commit)) & ((c > F.lit(last_commit)) | (i > F.lit(last_intent))))


def feed_rows(feed: DataFrame, last: int | None, current: int) -> DataFrame:
    """Change-feed rows of versions (last, current], or everything up to current on a first run."""
    upto = feed.filter(F.col("_commit_version") <= current)
    return upto if last is None else upto.filter(F.col("_commit_version") > last)


def apply_feed(target: DataFrame, feed: DataFrame, keys: list[str], deletes: bool = False) -> DataFrame:
    """Merge inserts and post-images; deletes only when asked, pre-images never."""
    kinds = ["insert", "update_postimage"] + (["delete"] if deletes else [])
    final = cut_lineage(keep_one(feed.filter(F.col("_change_type").isin(kinds)), keys, ["_commit_version"], "last"))
    untouched = without_keys(target, small_side(final.select(*keys), computed=True), keys)
    return untouched.unionByName(final.filter(F.col("_change_type") != "delete").select(*target.columns))


def vanished(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the last snapshot that the current one no longer has; a NULL key is a key like others."""
    return without_keys(previous.select(*keys), current.select(*keys), keys)


def shrunk_rows(previous: DataFrame, current: DataFrame, container: list[str], count: str = "row_count") -> DataFrame:
    """Row numbers to delete: new_max+1 .. prev_max per container, all of a vanished one."""
    now = current.select(*container, F.col(count).alias("_now"))
    joined = previous.select(*container, F.col(count).alias("_then")).join(now, container, "left")
    gone = joined.withColumn("_from", F.coalesce("_now", F.lit(0)) + 1).filter(F.col("_from") <= F.col("_then"))
    # A huge container is cut into spans first and the spans are spread, so no task builds it whole.
    spans = gone.withColumn("_span", F.explode(F.sequence(F.floor(F.col("_from") / SPAN), F.floor(F.col("_then") / SPAN))))
    tasks = int(previous.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = spans.repartition(tasks, *container, "_span")
    low = F.greatest("_from", F.col("_span") * SPAN)
    high = F.least("_then", (F.col("_span") + 1) * SPAN - 1)
    return spread.select(*container, F.explode(F.sequence(low, high)).alias("row_no"))


def cascade(parents: DataFrame, current: DataFrame, children: DataFrame, key: str, child_key: str) -> tuple[DataFrame, DataFrame]:
    """(parent keys gone, child rows to delete with them)."""
    gone = vanished(parents, current, [key])
    rows = children.join(gone.withColumnRenamed(key, child_key), child_key, "left_semi")
    return gone, rows


def apply_tombstones(target: DataFrame, batch: DataFrame, keys: list[str], flag: str, order: list[str]) -> DataFrame:
    """Upsert then delete: a key flagged deleted anywhere in the batch does not survive."""
    newest = F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), F.struct(*order)).alias("r")
    final = cut_lineage(batch.groupBy(*keys).agg(F.bool_or(flag).alias("_gone"), newest))
    live = final.filter(~F.coalesce("_gone", F.lit(False))).select(*keys, "r.*")
    return without_keys(target, small_side(final.select(*keys), computed=True), keys).unionByName(live.select(*target.columns))


def soft_deletes(previous_keys: DataFrame, current: DataFrame, keys: list[str], flag: str = "purge_indicator") -> DataFrame:
    """Active rows flagged False, plus key-only rows flagged True for keys that disappeared."""
    active = current.withColumn(flag, F.lit(False))
    gone = vanished(previous_keys, current, keys).withColumn(flag, F.lit(True))
    return active.unionByName(gone, allowMissingColumns=True)


def hourly_counts(df: DataFrame, ts: str, entity: Column, cursor: Column, hours: int = 24) -> DataFrame:
    """Counts per full hour before the cursor's hour, plus the partial hour up to the cursor."""
    aligned = F.date_trunc("hour", cursor)
    hour = F.date_trunc("hour", F.col(ts))
    span = (F.col(ts) >= aligned - F.expr(f"INTERVAL {hours} HOURS")) & (F.col(ts) < cursor)
    counted = df.filter(span).groupBy(entity.alias("entity"), hour.alias("hour_start"))
    return counted.agg(F.count(F.lit(1)).alias("record_count")).withColumn(
        "is_partial", F.col("hour_start") == aligned
    )


def drifted_hours(now: DataFrame, before: DataFrame, since: Column, until: Column) -> DataFrame:
    """Full hours whose count went up since the last run.

    That run counted the hours in [since, until); where it left no count there was no row, so an hour that went
    from none to some is found too.
    """
    prev = before.select("entity", "hour_start", F.col("record_count").alias("_prev"))
    counted = (F.col("hour_start") >= since) & (F.col("hour_start") < until)
    joined = now.filter(~F.col("is_partial") & counted).join(prev, ["entity", "hour_start"], "left")
    return joined.withColumn("prev_count", F.coalesce("_prev", F.lit(0))).drop("_prev").filter(F.col("record_count") > F.col("prev_count"))


def repair_status(drifted: DataFrame, recount: DataFrame) -> DataFrame:
    """The drifted hours with the target's count after the repair: verified if it is the source's, else unverified."""
    after = recount.select("entity", "hour_start", F.col("record_count").alias("_after"))
    out = drifted.join(after, ["entity", "hour_start"], "left").withColumn("target_count", F.coalesce("_after", F.lit(0)))
    status = F.when(F.col("target_count") == F.col("record_count"), "verified").otherwise("unverified")
    return out.select("entity", "hour_start", "record_count", "prev_count", "target_count", status.alias("status"))


def rows_of_hours(df: DataFrame, ts: str, entity: Column, hours: DataFrame) -> DataFrame:
    """Rows to read again: those in drifted hours of their entity."""
    keyed = df.withColumns({"entity": entity, "hour_start": F.date_trunc("hour", F.col(ts))})
    listed = small_side(hours.select("entity", "hour_start"))
    return keyed.join(listed, ["entity", "hour_start"], "left_semi").select(*df.columns)
