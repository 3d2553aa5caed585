"""Window, order and paging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ordering as O
from tidemark.queries.registry import query

ts = lambda text: F.lit(text).cast("timestamp")


@query(
    "win01_global_row_ids",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_no FROM events",
)
def win01(t):
    return O.global_row_number(t.events.select("ts", "event_id"), ["ts", "event_id"]).select("event_id", "row_no")


@query(
    "win01_row_ids_per_group",
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_no FROM events",
)
def win01_group(t):
    rows = O.range_blocks(t.events.select("event_id", "event_type", "ts"), ["event_type", "ts", "event_id"])
    return O.number_in_group(rows, ["event_type"], ["ts", "event_id"], F.col("_part")).select("event_id", "event_type", "row_no")


@query(
    "win02_dedupe",
    """SELECT user_id, event_type, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1, 2""",
)
def win02(t):
    rows = t.events.select("user_id", "event_type", "ts", "event_id")
    keys = ["user_id", "event_type"]
    pick = lambda keep: O.keep_one(rows, keys, ["ts", "event_id"], keep).select(*keys, F.col("event_id").alias(f"{keep}_id"))
    return pick("first").join(pick("last"), keys)


@query(
    "win03_carry_forward",
    """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN user_id END IGNORE NULLS) OVER w AS last_signup,
    last_value(CASE WHEN event_type = 'error' THEN value END IGNORE NULLS) OVER w AS last_error FROM events
    WINDOW w AS (PARTITION BY date_trunc('week', ts) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def win03(t):
    rows = O.range_blocks(t.events.withColumn("week", F.date_trunc("week", "ts")), ["week", "ts", "event_id"])
    values = {
        "last_signup": F.when(F.col("event_type") == "signup", F.col("user_id")),
        "last_error": F.when(F.col("event_type") == "error", F.col("value")),
    }
    out = O.carry_forward(rows, ["week"], ["ts", "event_id"], F.col("_part"), values)
    return out.select("event_id", "last_signup", "last_error")


@query(
    "win04_continuations",
    """WITH l AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'assistant' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS record_no FROM conversations)
    SELECT conv_id, CAST(record_no AS BIGINT) AS record_no, count(*) AS lines, md5(string_agg(text, ' ' ORDER BY turn)) AS text_md5 FROM l WHERE record_no > 0 GROUP BY 1, 2""",
)
def win04(t):
    numbered = O.continuation_groups(t.conversations, ["conv_id"], ["turn"], F.floor(F.col("turn") / 1000), F.col("role") == "assistant")
    # One record is one output text, so its lines are gathered; conversations are never gathered whole.
    parts = numbered.filter(F.col("record_no") > 0).groupBy("conv_id", "record_no").agg(
        F.count(F.lit(1)).alias("lines"), F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("p")
    )
    return parts.select("conv_id", "record_no", "lines", F.md5(F.array_join(F.transform("p", lambda x: x["text"]), " ")).alias("text_md5"))


@query(
    "win05_top_per_parent",
    """SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
)
def win05(t):
    return O.top_n_per(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "rn").select("o_custkey", "o_orderkey", "rn")


@query(
    "win06_tie_complete",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= (SELECT max(o_orderdate) FROM (SELECT o_orderdate FROM orders ORDER BY o_orderdate LIMIT 500))",
)
def win06(t):
    return O.tie_complete_prefix(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", 500)


@query(
    "srt01_total_order",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey",
)
def srt01(t):
    return t.orders.filter(F.col("o_orderdate").isNotNull()).select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey")


@query(
    "srt02_offset_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 300",
)
def srt02(t):
    return O.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 300, 100)


@query(
    "srt02_deep_page",
    "SELECT l_orderkey, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_extendedprice, l_linenumber, l_partkey, l_suppkey LIMIT 1000 OFFSET 40000",
)
def srt02_deep(t):
    keys = ["l_orderkey", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey"]
    return O.page(t.lineitem.select(*keys), keys, 40000, 1000).select("l_orderkey", "l_extendedprice")


@query("srt03_newest", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def srt03(t):
    return O.newest(t.events.select("event_id", "ts", "event_type"), ["ts", "event_id"])
