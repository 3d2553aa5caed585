"""Incremental-read queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import incremental as I
from tidemark.queries.registry import query

ts = lambda text: F.lit(text).cast("timestamp")


@query(
    "inc01_strict_cursor",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'",
)
def inc01(t):
    return I.after(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ts("1998-01-01"))


@query(
    "inc01_next_cursor",
    "SELECT greatest(max(o_orderdate), TIMESTAMP '1998-01-01') AS cursor FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'",
)
def inc01_next(t):
    fresh = I.after(t.orders, "o_orderdate", ts("1998-01-01"))
    return I.next_cursor(fresh, "o_orderdate", "1998-01-01")


@query(
    "inc02_inclusive_cursor",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
def inc02(t):
    return I.at_or_after(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ts("1998-01-01"))


@query(
    "inc03_compound_cursor",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 700)",
)
def inc03(t):
    return I.after_pair(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", ts("1998-01-01"), 700)


@query(
    "inc04_boundary_ids",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'
    OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderstatus <> 'F')""",
)
def inc04(t):
    """Boundary-day orders with status F were synced before."""
    seen = t.orders.filter((F.col("o_orderdate") == ts("1998-01-01")) & (F.col("o_orderstatus") == "F"))
    return I.after_with_seen(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", ts("1998-01-01"), seen)


@query("inc05_high_water_mark", "SELECT event_id, event_type FROM events WHERE event_id > 400")
def inc05(t):
    return I.above_mark(t.events.select("event_id", "event_type"), "event_id", 400)


@query(
    "inc05_until_known",
    """SELECT event_id, -event_id AS feed_position FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-25' AND event_type = 'error')""",
)
def inc05_known(t):
    feed = t.events.withColumn("feed_position", -F.col("event_id"))
    known = (F.col("ts") < ts("2024-01-25")) & (F.col("event_type") == "error")
    return I.until_known(feed, "feed_position", known).select("event_id", "feed_position")


@query(
    "inc06_overlap_lookback",
    """SELECT user_id, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL 2 HOUR GROUP BY user_id""",
)
def inc06(t):
    rows = I.with_overlap(t.events, "ts", "2024-01-20", "2 HOURS", ["user_id"], ["ts", "event_id"])
    return rows.select("user_id", F.col("ts").alias("last_ts"), "event_id")


@query(
    "inc07_bounded_window",
    """SELECT 'right' AS closed, o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-07-01'
    UNION ALL SELECT 'left', o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""",
)
def inc07(t):
    part = lambda side: I.between(t.orders, "o_orderdate", ts("1997-01-01"), ts("1997-07-01"), side).select(F.lit(side).alias("closed"), "o_orderkey")
    return part("right").unionByName(part("left"))


@query(
    "inc08_two_phase",
    """WITH l AS (SELECT l_orderkey, min(l_shipdate) AS mod_ts, min(o_orderdate) AS create_ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey)
    SELECT l_orderkey, CASE WHEN mod_ts >= TIMESTAMP '1998-01-01' AND mod_ts < TIMESTAMP '1998-04-01' THEN 1 ELSE 2 END AS phase FROM l
    WHERE (mod_ts >= TIMESTAMP '1998-01-01' AND mod_ts < TIMESTAMP '1998-04-01') OR (create_ts >= TIMESTAMP '1998-01-01' AND create_ts < TIMESTAMP '1998-04-01')""",
)
def inc08(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    stamped = joined.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("mod_ts"), F.min("o_orderdate").alias("create_ts"))
    rows = I.two_phase(stamped, "mod_ts", "create_ts", ts("1998-01-01"), ts("1998-04-01"))
    return rows.select("l_orderkey", F.col("_phase").alias("phase"))


@query(
    "inc09_version_gate",
    """WITH v AS (SELECT p_brand AS table_name, max(p_partkey) AS version FROM part GROUP BY p_brand),
    s AS (SELECT p_brand AS table_name, max(p_partkey) AS last FROM part WHERE p_type <> 'SMALL' AND p_brand <> 'Brand#7' GROUP BY p_brand)
    SELECT table_name, version FROM v LEFT JOIN s USING (table_name) WHERE version > coalesce(last, -1)""",
)
def inc09(t):
    """Brands as tables versioned by their newest part; small parts are new and one brand was never synced."""
    name = F.col("p_brand").alias("table_name")
    newest = lambda df: df.groupBy(name).agg(F.max("p_partkey").alias("version"))
    synced = t.part.filter((F.col("p_type") != "SMALL") & (F.col("p_brand") != "Brand#7"))
    return I.stale_tables(newest(t.part), newest(synced))


@query(
    "inc10_per_entity_cursor",
    """WITH s AS (SELECT user_id, max(ts) AS cursor FROM events WHERE ts < TIMESTAMP '2024-01-10' AND event_type = 'purchase' GROUP BY user_id)
    SELECT e.event_id, e.user_id FROM events e LEFT JOIN s ON e.user_id = s.user_id WHERE s.cursor IS NULL OR e.ts > s.cursor""",
)
def inc10(t):
    old = t.events.filter((F.col("ts") < ts("2024-01-10")) & (F.col("event_type") == "purchase"))
    state = old.groupBy("user_id").agg(F.max("ts").alias("cursor"))
    return I.per_entity(t.events.select("event_id", "user_id", "ts"), state, "user_id", "ts").select("event_id", "user_id")


@query(
    "inc11_missing_timestamp",
    """WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events)
    SELECT 'keep' AS policy, event_id FROM e WHERE ts > TIMESTAMP '2024-01-20' OR ts IS NULL UNION ALL SELECT 'drop', event_id FROM e WHERE ts > TIMESTAMP '2024-01-20'""",
)
def inc11(t):
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("ts"))
    part = lambda name, keep: I.after(rows, "ts", ts("2024-01-20"), keep).select(F.lit(name).alias("policy"), "event_id")
    return part("keep", True).unionByName(part("drop", False))


@query(
    "inc12_content_hash",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_nationkey = 24",
)
def inc12(t):
    """Last run saw other balances for debtors and did not know nation 24."""
    cols = ["c_custkey", "c_name", "c_acctbal"]
    before = t.customer.filter(F.col("c_nationkey") != 24).select("c_custkey", "c_name", F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal"))
    previous = before.select("c_custkey", I.row_hash(before).alias("row_hash"))
    return I.changed_rows(t.customer.select(*cols), previous, ["c_custkey"]).select("c_custkey", "c_acctbal")


@query(
    "inc14_cursor_profile",
    """SELECT count(*) AS row_count, 'updated_at' AS column_name, CAST(0 AS INTEGER) AS preference, count(o_orderdate) FILTER (WHERE o_orderstatus <> 'P') AS non_null,
    strftime(min(o_orderdate) FILTER (WHERE o_orderstatus <> 'P'), '%Y-%m-%d %H:%M:%S') AS min_value, strftime(max(o_orderdate) FILTER (WHERE o_orderstatus <> 'P'), '%Y-%m-%d %H:%M:%S') AS max_value FROM orders
    UNION ALL SELECT count(*), 'o_orderdate', 99, count(o_orderdate), strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders""",
)
def inc14(t):
    rows = t.orders.withColumn("updated_at", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return I.profile_cursors(rows)


@query(
    "inc15_offset_cursor",
    """SELECT o_orderkey, row_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no FROM orders) WHERE row_no > 1000""",
)
def inc15(t):
    return I.from_offset(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], 1000).select("o_orderkey", "row_no")


@query(
    "inc16_initial_bound",
    """SELECT user_id, coalesce(max(ts) FILTER (WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-03'), TIMESTAMP '2024-02-01' - INTERVAL 7 DAY) AS bound FROM events GROUP BY user_id""",
)
def inc16(t):
    first = F.when((F.col("event_type") == "signup") & (F.col("ts") < ts("2024-01-03")), F.col("ts"))
    state = t.events.groupBy("user_id").agg(F.max(first).alias("cursor"))
    return state.select("user_id", I.initial_bound(F.col("cursor"), ts("2024-02-01"), "7 DAYS").alias("bound"))
