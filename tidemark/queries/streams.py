"""Streaming queries over the landed events; each drains its input and returns the written table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries.changes import event_log, user_target
from tidemark.queries.registry import query
from tidemark.session import work_path
from tidemark.sinks.versioned import VersionedTable
from tidemark.sources.tables import SCHEMAS
from tidemark.streaming import streams as ST
from tidemark.streaming.idle import idle_keys, keyed_state

ts = lambda text: F.lit(text).cast("timestamp")


class _Stream:
    """Stand-in for the table set whose `events` is the stream."""

    def __init__(self, events):
        self.events = events


def event_stream(t):
    # The glob names one file or one folder of files alike.
    return ST.topic(t.spark, f"{t.folder}/event[s].parquet", SCHEMAS["events"])


def landed_stream(t, batches: int = 3):
    """Events landed again in no order, as files of about equal size that fill so many micro-batches."""
    path = work_path(t.spark, "topic")
    parts = max(batches, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    t.events.repartition(parts, "event_id").write.parquet(path)
    return ST.topic(t.spark, path, SCHEMAS["events"], files_per_batch=-(-parts // batches))


def drained(t, stream, mode: str = "append"):
    out = work_path(t.spark, "stream")
    ST.drain(stream, f"{out}/data", f"{out}/checkpoint", mode)
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


def empty_table(t, schema, keys):
    table = VersionedTable(t.spark, work_path(t.spark, "state"), keys, buckets=4)
    table.replace(t.spark.createDataFrame([], schema))
    return table


@query(
    "stm01_topic_ingest",
    """SELECT event_id, 'events' AS topic, CASE WHEN event_type <> 'error' THEN props END AS json, CASE WHEN event_type = 'error' THEN 'oops' END AS raw_data FROM events""",
)
def stm01(t):
    payload = F.when(F.col("event_type") == "error", "oops").otherwise(F.col("props")).cast("binary")
    rows = ST.decoded(landed_stream(t).withColumn("topic", F.lit("events")), payload)
    return drained(t, rows.select("event_id", "topic", "json", "raw_data"))


@query("stm02_at_least_once", "SELECT event_id, user_id, value FROM events")
def stm02(t):
    """The whole topic is delivered twice by two writers; keys and batch numbers absorb it."""
    stream = landed_stream(t).select("event_id", "user_id", "value")
    table = empty_table(t, stream.schema, ["event_id"])
    base = work_path(t.spark, "ack")
    for writer in ("first", "again"):
        ST.drain_into(stream, ST.upsert_into(table, ["event_id"], writer), f"{base}/{writer}")
    return table.read()


@query("stm03_event_dedupe", "SELECT event_id, user_id, event_type FROM events")
def stm03(t):
    """Purchases are delivered three times; the first copy is kept."""
    copies = F.when(F.col("event_type") == "purchase", 3).otherwise(1)
    repeated = event_stream(t).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return drained(t, ST.first_events(repeated, ["event_id"], "ts", "2 hours").select("event_id", "user_id", "event_type"))


@query(
    "stm04_closed_windows",
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def stm04(t):
    """Append mode emits a window once no data up to two hours late can change it."""
    return drained(t, ST.tumbling_counts(event_stream(t), "ts", "1 hour", "2 hours"))


@query(
    "stm04_late_rows",
    """WITH e AS (SELECT event_id, ts, CAST(CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY ELSE ts END AS DATE) AS arrival FROM events), a AS (SELECT arrival, max(ts) AS top FROM e GROUP BY arrival),
    m AS (SELECT arrival, max(top) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)
    SELECT event_id FROM e JOIN m ON e.arrival = m.arrival WHERE ts < seen - INTERVAL 2 HOUR""",
)
def stm04_late(t):
    """Errors arrive a day late: the rows a two-hour watermark would drop, for the batch repair."""
    arrival = F.to_date(F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts")))
    return ST.late_rows(t.events.select("event_id", "ts", arrival.alias("arrival")), "ts", "arrival", "2 HOURS").select("event_id")


IDLE_SQL = """e AS (SELECT event_id, user_id, ts, date_trunc('week', CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY ELSE ts END) AS lot FROM events),
    a AS (SELECT lot, max(max(ts)) OVER (ORDER BY lot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM e GROUP BY lot),
    m AS (SELECT event_id, user_id, ts, coalesce(date_trunc('milliseconds', ts) < date_trunc('milliseconds', seen) - INTERVAL 2 HOUR, false) AS late FROM e JOIN a USING (lot))"""


def idle_run(t):
    """Events land by weeks, errors a day late; a run drains each landing and the checkpoint carries the state on."""
    base = work_path(t.spark, "idle")
    arrival = F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts"))
    rows = t.events.withColumn("lot", F.date_trunc("week", arrival))
    # as many lots as the calendar has weeks
    lots = sorted(r[0] for r in rows.select("lot").distinct().collect())
    for lot in lots:
        rows.where(F.col("lot") == F.lit(lot)).drop("lot").write.mode("append").parquet(f"{base}/topic")
        out = idle_keys(ST.topic(t.spark, f"{base}/topic", SCHEMAS["events"]), ["user_id"], "ts", ["event_id"], "12 HOURS", "2 hours")
        with keyed_state(t.spark):
            ST.drain(out, f"{base}/data", f"{base}/checkpoint")
    return t.spark.read.schema(out.schema).parquet(f"{base}/data") if lots else t.spark.createDataFrame([], "kind string, user_id long, event_id long, first timestamp, last timestamp, n long")


@query(
    "stm06_idle_spans",
    f"""WITH {IDLE_SQL}, g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM m WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS span FROM g)
    SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, span
    HAVING date_trunc('milliseconds', max(ts)) + INTERVAL 12 HOUR < (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events)""",
)
def stm06_idle(t):
    """A user's state times out: spans come out after twelve idle hours, those still open stay in the state."""
    return idle_run(t).where("kind = 'idle'").select("user_id", "first", "last", "n")


@query("stm04_stream_late_rows", f"WITH {IDLE_SQL} SELECT event_id, user_id FROM m WHERE late")
def stm04_stream_late(t):
    """The same stream hands out the rows its watermark leaves out."""
    return idle_run(t).where("kind = 'late'").select("event_id", "user_id")


@query("stm05_hourly_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stm05(t):
    """Update mode: every change of a count is merged into a keyed table."""
    counts = ST.tumbling_counts(event_stream(t), "ts", "1 hour", "2 hours", ["event_type"])
    table = empty_table(t, counts.schema, ["window_start", "event_type"])
    ST.drain_into(counts, ST.upsert_into(table, ["n"], "counts", ordered=False), work_path(t.spark, "counts"), "update")
    return table.read()


@query("stm06_key_cursors", "SELECT user_id, max(ts) AS cursor, count(*) AS n FROM events GROUP BY user_id")
def stm06(t):
    cursors = ST.key_cursors(landed_stream(t), "user_id", "ts")
    table = empty_table(t, cursors.schema, ["user_id"])
    ST.drain_into(cursors, ST.upsert_into(table, ["cursor", "n"], "cursors", ordered=False), work_path(t.spark, "cursors"), "update")
    return table.read()


@query(
    "stm07_cdc_stream",
    """WITH last AS (SELECT user_id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value FROM events WHERE event_type <> 'view' GROUP BY user_id)
    SELECT user_id, value FROM last WHERE kind <> 'error' UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT user_id FROM last)""",
)
def stm07(t):
    """The log arrives in several micro-batches that are not in commit order."""
    log = event_log(_Stream(landed_stream(t, 4)))
    table = VersionedTable(t.spark, work_path(t.spark, "users"), ["user_id"])
    table.replace(user_target(t))
    ST.drain_into(log, ST.apply_changes_into(table, ["commit_seq", "intent_seq"], "log"), work_path(t.spark, "cdc"))
    return table.read()


@query("stm08_old_events", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def stm08(t):
    return drained(t, ST.newer_than(event_stream(t), "ts", "2024-01-20").select("event_id", "ts"))
