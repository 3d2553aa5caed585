"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A, joins as J
from tidemark.plans import windows as W
from tidemark.queries.registry import query

ts = lambda text: F.lit(text).cast("timestamp")


@query(
    "agg01_count_by_key",
    "SELECT CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS component, count(*) AS n FROM events GROUP BY 1",
)
def agg01(t):
    return A.count_by(t.events, F.when(F.col("event_type") != "error", F.col("event_type")), "component")


@query(
    "agg02_conditional_counts",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS full_price FROM lineitem GROUP BY l_returnflag""",
)
def agg02(t):
    return A.count_where(t.lineitem, ["l_returnflag"], {"large": F.col("l_quantity") > 25, "full_price": F.col("l_discount") == 0})


@query("agg03_top_by_count", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10")
def agg03(t):
    return A.top_k(t.lineitem, "l_partkey", 10)


@query("agg04_hourly_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def agg04(t):
    return A.per_window(t.events, "ts", "1 hour", ["event_type"])


@query(
    "agg04_partial_window",
    """SELECT event_type AS entity, date_trunc('hour', ts) AS hour_start, count(*) AS record_count, date_trunc('hour', ts) = TIMESTAMP '2024-01-20 10:00:00' AS is_partial FROM events
    WHERE ts >= TIMESTAMP '2024-01-19 10:00:00' AND ts < TIMESTAMP '2024-01-20 10:45:00' GROUP BY 1, 2""",
)
def agg04_partial(t):
    from tidemark.operators.changes import hourly_counts

    return hourly_counts(t.events, "ts", F.col("event_type"), ts("2024-01-20 10:45:00"))


@query(
    "agg05_daily_zero_filled",
    """WITH g AS (SELECT u.user_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT user_id FROM events) u, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) s(d)),
    c AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT g.user_id, strftime(g.day, '%Y-%m-%d') AS day, coalesce(c.n, 0) AS n FROM g LEFT JOIN c ON g.user_id = c.user_id AND g.day = c.day""",
)
def agg05(t):
    days = F.sequence(F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-30")))
    grid = J.task_grid(t.events.select("user_id").distinct(), "user_id", days, "day")
    facts = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return J.fill_grid(grid, facts, ["user_id", "day"], "n").withColumn("day", F.col("day").cast("string"))


@query(
    "agg06_latest_per_group",
    "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey",
)
def agg06(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return A.latest_per(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("agg07_cursor_range", "SELECT min(l_shipdate) AS min_cursor, max(l_shipdate) AS max_cursor, count(l_shipdate) AS n FROM lineitem")
def agg07(t):
    return A.cursor_range(t.lineitem, "l_shipdate")


@query(
    "agg08_array_summaries",
    "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS episodes, round(CAST(list_max(embedding) AS DOUBLE), 6) AS top FROM embeddings",
)
def agg08(t):
    return t.embeddings.select("vec_id", F.size("embedding").alias("episodes"), F.round(F.array_max(F.transform("embedding", lambda x: x.cast("double"))), 6).alias("top"))


@query(
    "agg09_first_definitions",
    """SELECT p_brand, p_type, min(p_partkey) AS first_seen, arg_min(p_name, p_partkey) AS p_name, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY p_brand, p_type""",
)
def agg09(t):
    return A.merge_fields(t.part, "p_brand", "p_type", "p_partkey", ["p_name", "p_size"])


@query(
    "agg10_field_names",
    "SELECT 'k' AS field, count(*) AS n FROM events UNION ALL SELECT event_type, count(*) FROM events GROUP BY event_type",
)
def agg10(t):
    fields = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.col("event_type"), F.lit("1")))
    return A.field_names(t.events.select(fields.alias("fields")), "fields")


@query(
    "agg11_sum_or_zero",
    """SELECT coalesce(CAST(sum(l_linenumber) AS BIGINT), 0) AS lines, CAST(0 AS BIGINT) AS none FROM lineitem""",
)
def agg11(t):
    never = F.when(F.col("l_quantity") < 0, F.col("l_linenumber"))
    return t.lineitem.agg(A.sum_or_zero(F.col("l_linenumber")).alias("lines"), A.sum_or_zero(never).alias("none"))


@query(
    "agg12_rejects_by_reason",
    """WITH r AS (SELECT CASE WHEN value < 1 THEN 'value too small' WHEN event_type = 'error' THEN 'error event' WHEN user_id < 3 THEN 'system user' END AS reason FROM events)
    SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""",
)
def agg12(t):
    reason = F.when(F.col("value") < 1, "value too small").when(F.col("event_type") == "error", "error event").when(F.col("user_id") < 3, "system user")
    return A.reject_counts(t.events.select(reason.alias("reason")).filter(F.col("reason").isNotNull()))


@query(
    "agg13_census",
    " UNION ALL ".join(f"SELECT '{n}' AS entity, count(*) AS n FROM {n}" for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")),
)
def agg13(t):
    return A.census({n: getattr(t, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")})


@query(
    "agg14_interval_metrics",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(38,10))) AS DOUBLE) AS sum_value, round(avg(value), 6) AS avg_value,
    min(value) AS min_value, max(value) AS max_value, round(stddev_samp(value), 6) AS stddev_value, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90,
    quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1""",
)
def agg14(t):
    return A.interval_metrics(t.events, F.date_format("ts", "yyyy-MM-dd"), "day", "value")


@query(
    "agg14_status_revenue",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM lineitem GROUP BY 1, 2""",
)
def agg14_revenue(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), A.money_sum("l_quantity").alias("sum_qty"), A.money_sum("l_extendedprice").alias("sum_price")
    )
