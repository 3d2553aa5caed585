"""Time-window planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import windows as W
from tidemark.queries.registry import query

ts = lambda text: F.lit(text).cast("timestamp")


def nation_ranges(t):
    """Per customer nation, the first and last order day."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_nationkey").agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))


RANGES_SQL = "SELECT c_nationkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"


def closed_sql(step: int, span: int, extra: int = 0) -> str:
    return f"""WITH r AS ({RANGES_SQL}), w AS (SELECT c_nationkey, last_day, unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL {step} DAY)) AS f FROM r)
    SELECT c_nationkey, strftime(f, '%Y-%m-%d') AS window_from, strftime(least(f + INTERVAL {span} DAY, CAST(last_day AS TIMESTAMP)) + INTERVAL {extra} DAY, '%Y-%m-%d') AS window_to FROM w"""


def dates_as_text(df):
    return df.select("c_nationkey", F.col("window_from").cast("string").alias("window_from"), F.col("window_to").cast("string").alias("window_to"))


@query("tw01_closed_windows", closed_sql(365, 364))
def tw01(t):
    return dates_as_text(W.closed_windows(nation_ranges(t), "first_day", "last_day", 364))


@query("tw01_exclusive_end", closed_sql(31, 30, 1))
def tw01_exclusive(t):
    return dates_as_text(W.exclusive_end(W.closed_windows(nation_ranges(t), "first_day", "last_day", 30)))


@query(
    "tw02_forward_windows",
    """WITH u AS (SELECT user_id, min(ts) AS s FROM events GROUP BY user_id), w AS (SELECT user_id, unnest(generate_series(s, TIMESTAMP '2024-02-01', INTERVAL 7 DAY)) AS f FROM u)
    SELECT user_id, f AS window_from, least(f + INTERVAL 7 DAY, TIMESTAMP '2024-02-01') AS window_to FROM w WHERE f < TIMESTAMP '2024-02-01'""",
)
def tw02(t):
    starts = t.events.groupBy("user_id").agg(F.min("ts").alias("s"))
    return W.half_open_windows(starts, "s", ts("2024-02-01"), 7).drop("s")


@query(
    "tw02_window_state",
    """WITH w AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-09-01', INTERVAL 30 DAY)) AS f),
    b AS (SELECT f AS gte, least(f + INTERVAL 30 DAY, TIMESTAMP '2001-09-01') AS cursor FROM w WHERE f < TIMESTAMP '2001-09-01')
    SELECT gte, cursor, count(o_orderkey) AS n FROM b LEFT JOIN orders ON o_orderdate >= gte AND o_orderdate < cursor GROUP BY gte, cursor""",
)
def tw02_state(t):
    first = t.orders.agg(F.date_trunc("year", F.min("o_orderdate")).alias("s"))
    windows = W.half_open_windows(first, "s", ts("2001-09-01"), 30).drop("s")
    return W.window_state(windows, t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(
    "tw03_backfill_windows",
    """WITH c AS (SELECT CAST(floor((epoch_us(TIMESTAMP '2001-12-01') - epoch_us(o_orderdate) - 1) / (30 * 86400000000.0)) AS BIGINT) AS window_no, o_orderdate FROM orders
      WHERE o_orderdate >= TIMESTAMP '1999-01-01' OR o_orderdate < TIMESTAMP '1997-01-01'),
    g AS (SELECT window_no, count(*) AS n, min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts FROM c GROUP BY window_no),
    s AS (SELECT *, window_no - coalesce(lag(window_no) OVER (ORDER BY window_no), -1) - 1 AS gap FROM g),
    k AS (SELECT *, sum(CASE WHEN gap >= 12 THEN 1 ELSE 0 END) OVER (ORDER BY window_no) AS stops FROM s)
    SELECT window_no, n, min_ts, max_ts FROM k WHERE stops = 0""",
)
def tw03(t):
    """Two empty years in the source end the backfill; older rows are not read."""
    source = t.orders.filter((F.col("o_orderdate") >= ts("1999-01-01")) | (F.col("o_orderdate") < ts("1997-01-01")))
    return W.backfill_windows(source, "o_orderdate", ts("2001-12-01"), 30, 12)


@query(
    "tw04_calendar",
    f"SELECT c_nationkey, strftime(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)), '%Y%m%d') AS business_date FROM ({RANGES_SQL})",
)
def tw04(t):
    days = W.calendar(nation_ranges(t), "first_day", "last_day")
    return days.select("c_nationkey", F.date_format("business_date", "yyyyMMdd").alias("business_date"))


@query(
    "tw05_next_range",
    """WITH s AS (SELECT user_id, max(ts) FILTER (WHERE event_type = 'signup') AS last_to FROM events GROUP BY user_id)
    SELECT user_id, coalesce(last_to, TIMESTAMP '2023-12-01') AS range_from, least(coalesce(last_to, TIMESTAMP '2023-12-01') + INTERVAL 30 DAY, TIMESTAMP '2024-02-10') AS range_to FROM s""",
)
def tw05(t):
    state = t.events.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("last_to"))
    return W.next_range(state, "last_to", ts("2023-12-01"), ts("2024-02-10"), 30).drop("last_to")
