"""Change application, delete detection and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes as G
from tidemark.queries.registry import query
from tidemark.session import work_path
from tidemark.sinks.snapshots import KeySnapshot

ts = lambda text: F.lit(text).cast("timestamp")

LOG_SQL = """SELECT user_id, event_id AS commit_seq, CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' WHEN 'view' THEN 'X' ELSE 'U' END AS op, value FROM events"""


def event_log(t):
    """Events as a change log keyed by user: signup inserts, error deletes, view is unknown."""
    kind = F.col("event_type")
    op = F.when(kind == "error", "D").when(kind == "signup", "I").when(kind == "view", "X").otherwise("U")
    return t.events.select("user_id", F.col("event_id").alias("commit_seq"), (F.col("event_id") * 2).alias("intent_seq"), op.alias("op"), "value")


def user_target(t):
    """Users known before the log: half of them derived from the customers."""
    return t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))


@query(
    "chg01_apply_change_log",
    f"""WITH log AS ({LOG_SQL}), last AS (SELECT user_id, arg_max(op, commit_seq) AS op, arg_max(value, commit_seq) AS value FROM log WHERE op <> 'X' AND commit_seq > 1000 GROUP BY user_id)
    SELECT user_id, value FROM last WHERE op <> 'D' UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT user_id FROM last)""",
)
def chg01(t):
    log = G.after_position(event_log(t), "commit_seq", "intent_seq", 1000, 2000)
    return G.apply_log(user_target(t), log, ["user_id"], ["commit_seq", "intent_seq"])


FEED_SQL = """SELECT user_id, value, CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage' ELSE 'update_postimage' END AS kind, event_id AS v FROM events"""


def event_feed(t):
    kind = F.col("event_type")
    change = F.when(kind == "error", "delete").when(kind == "signup", "insert").when(kind == "view", "update_preimage").otherwise("update_postimage")
    return t.events.select("user_id", "value", change.alias("_change_type"), F.col("event_id").alias("_commit_version"))


@query(
    "chg02_apply_change_feed",
    f"""WITH f AS ({FEED_SQL}), last AS (SELECT user_id, arg_max(value, v) AS value FROM f WHERE kind IN ('insert', 'update_postimage') GROUP BY user_id)
    SELECT user_id, value FROM last UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT user_id FROM last)""",
)
def chg02(t):
    return G.apply_feed(user_target(t), event_feed(t), ["user_id"])


@query(
    "chg03_snapshot_deletes",
    "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0",
)
def chg03(t):
    current = t.customer.filter(~((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)))
    return G.vanished(t.customer, current, ["c_custkey"])


@query(
    "chg03_digest_diff",
    """SELECT o_orderkey, 'gone' AS change FROM orders WHERE o_orderkey % 2999 = 7 UNION ALL SELECT -o_orderkey - 1, 'new' FROM orders WHERE o_orderkey % 4999 = 11""",
)
def chg03_digests(t):
    """A snapshot that lost and gained a few keys: only the buckets whose digests differ are read again and joined."""
    keys = t.orders.select("o_orderkey")
    snapshot = KeySnapshot(t.spark, work_path(t.spark, "keys"), ["o_orderkey"])
    snapshot.advance(keys)
    gained = keys.filter("o_orderkey % 4999 = 11").select((-F.col("o_orderkey") - 1).alias("o_orderkey"))
    found = snapshot.advance(keys.filter("o_orderkey % 2999 <> 7").unionByName(gained))
    return found.vanished.withColumn("change", F.lit("gone")).unionByName(found.new.withColumn("change", F.lit("new")))


@query(
    "chg04_shrunk_containers",
    """WITH p AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY l_orderkey), n AS (SELECT l_orderkey, count(*) AS c FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey)
    SELECT p.l_orderkey, unnest(generate_series(coalesce(n.c, 0) + 1, p.c)) AS row_no FROM p LEFT JOIN n ON p.l_orderkey = n.l_orderkey WHERE p.c > coalesce(n.c, 0)""",
)
def chg04(t):
    counts = lambda df: df.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("row_count"))
    return G.shrunk_rows(counts(t.lineitem), counts(t.lineitem.filter(F.col("l_returnflag") != "R")), ["l_orderkey"])


@query(
    "chg05_cascade_delete",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def chg05(t):
    current = t.orders.filter(F.col("o_orderstatus") != "P")
    _, rows = G.cascade(t.orders, current, t.lineitem, "o_orderkey", "l_orderkey")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "chg06_tombstones",
    """WITH b AS (SELECT user_id, arg_max(value, event_id) AS value, bool_or(event_type = 'error' AND value > 250) AS gone FROM events GROUP BY user_id)
    SELECT user_id, value FROM b WHERE NOT gone UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT user_id FROM b)""",
)
def chg06(t):
    flag = (F.col("event_type") == "error") & (F.col("value") > 250)
    batch = t.events.select("user_id", "value", "event_id", flag.alias("deleted"))
    return G.apply_tombstones(user_target(t), batch, ["user_id"], "deleted", ["event_id"])


DRIFT_SQL = """SELECT event_type AS entity, date_trunc('hour', ts) AS hour_start, count(*) AS record_count, count(*) FILTER (WHERE value <= 150) AS prev_count FROM events
    WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 240 HOUR AND ts < TIMESTAMP '2024-01-30 12:30:00' GROUP BY 1, 2"""


def drift_inputs(t):
    """Counts around a cursor now, and as last run saw them (large values arrived late)."""
    cursor = ts("2024-01-30 12:30:00")
    now = G.hourly_counts(t.events, "ts", F.col("event_type"), cursor, 240)
    before = G.hourly_counts(t.events.filter(F.col("value") <= 150), "ts", F.col("event_type"), cursor, 240)
    return now, before


def drifted(t):
    now, before = drift_inputs(t)
    return G.drifted_hours(now, before, ts("2024-01-20 12:00:00"), ts("2024-01-30 12:00:00"))


@query(
    "chg08_drifted_hours",
    f"SELECT entity, hour_start, record_count, prev_count FROM ({DRIFT_SQL}) WHERE record_count > prev_count AND hour_start < TIMESTAMP '2024-01-30 12:00:00'",
)
def chg08(t):
    return drifted(t).select("entity", "hour_start", "record_count", "prev_count")


@query(
    "chg08_reread_rows",
    f"""SELECT event_id FROM events JOIN ({DRIFT_SQL}) d ON event_type = entity AND date_trunc('hour', ts) = hour_start
    WHERE record_count > prev_count AND hour_start < TIMESTAMP '2024-01-30 12:00:00'""",
)
def chg08_rows(t):
    return G.rows_of_hours(t.events, "ts", F.col("event_type"), drifted(t)).select("event_id")


@query(
    "chg08_repair_status",
    f"""SELECT entity, hour_start, record_count, prev_count, target_count, CASE WHEN target_count = record_count THEN 'verified' ELSE 'unverified' END AS status FROM (
    SELECT d.entity, d.hour_start, d.record_count, d.prev_count, (SELECT count(*) FROM events e WHERE e.event_type = d.entity AND date_trunc('hour', e.ts) = d.hour_start AND e.value <= 290) AS target_count
    FROM ({DRIFT_SQL}) d WHERE d.record_count > d.prev_count AND d.hour_start < TIMESTAMP '2024-01-30 12:00:00')""",
)
def chg08_status(t):
    """The repair brought all but the largest values, so some hours cannot be verified."""
    recount = G.hourly_counts(t.events.filter(F.col("value") <= 290), "ts", F.col("event_type"), ts("2024-01-30 12:30:00"), 240)
    return G.repair_status(drifted(t), recount)


@query(
    "set01_key_difference",
    "SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def set01(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("key")).distinct()
    return t.customer.select(F.col("c_custkey").alias("key")).subtract(urgent)


@query(
    "set02_intersection",
    "SELECT c_nationkey AS key FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000",
)
def set02(t):
    rich = t.supplier.filter(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("key"))
    return t.customer.select(F.col("c_nationkey").alias("key")).intersect(rich)


@query(
    "set03_distinct_union",
    "SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0",
)
def set03(t):
    seed = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("key"))
    return seed.union(t.customer.filter(F.col("c_acctbal") < 0).select("c_custkey")).distinct()


@query(
    "set04_labelled_union",
    """SELECT o_orderkey, 'seed' AS source FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'discovered' FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def set04(t):
    label = lambda test, name: t.orders.filter(test).select("o_orderkey", F.lit(name).alias("source"))
    return label(F.col("o_orderstatus") == "F", "seed").unionByName(label(F.col("o_orderpriority") == "1-URGENT", "discovered"))


@query(
    "set05_new_vs_known",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01') THEN 'known' ELSE 'new' END AS status FROM customer""",
)
def set05(t):
    known = t.orders.filter(F.col("o_orderdate") < ts("1995-06-01")).select(F.col("o_custkey").alias("c_custkey")).distinct()
    split = lambda how, name: t.customer.select("c_custkey").join(known, "c_custkey", how).withColumn("status", F.lit(name))
    return split("left_anti", "new").unionByName(split("left_semi", "known"))
