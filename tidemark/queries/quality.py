"""Data-quality, reconciliation and schema queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as Q, schema as S
from tidemark.queries.registry import query
from tidemark.queries.scalars import STRICT_RULES, strict_rows
from tidemark.spec import TableSpec

ts = lambda text: F.lit(text).cast("timestamp")


@query(
    "dq01_accept_reject",
    """WITH t AS (SELECT event_id, event_type, value, props, ts FROM events), bad AS (SELECT event_id,
      event_type IN ('view', 'error') OR value < 1 OR value > 200 OR hour(ts) = 3 OR hour(ts) = 5 AS rejected FROM t)
    SELECT CASE WHEN rejected THEN 'rejected' ELSE 'accepted' END AS outcome, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM bad GROUP BY 1""",
)
def dq01(t):
    good, bad = Q.split_valid(strict_rows(t), STRICT_RULES)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum")).select(F.lit(name).alias("outcome"), "n", "id_sum")
    return count(good, "accepted").unionByName(count(bad, "rejected"))


@query(
    "dq01_reject_reasons",
    """SELECT event_id, 'Invalid bool value in bool_column: ''FALSE1''' AS reason FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'Invalid string value in string_column: '' ''' FROM events WHERE value < 1""",
)
def dq01_reasons(t):
    _, bad = Q.split_valid(strict_rows(t), {k: STRICT_RULES[k] for k in ("bool_column", "string_column")})
    return bad.select("event_id", F.explode("reasons").alias("reason"))


@query(
    "dq02_whole_files",
    """WITH f AS (SELECT c_nationkey AS file, count(*) FILTER (WHERE c_acctbal < -990) AS bad FROM customer GROUP BY c_nationkey)
    SELECT c_custkey, c_nationkey AS file FROM customer WHERE c_nationkey IN (SELECT file FROM f WHERE bad = 0)""",
)
def dq02(t):
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("file"), "c_acctbal")
    good, _ = Q.whole_files(rows, "file", F.col("c_acctbal") < -990)
    return good.select("c_custkey", "file")


@query(
    "dq03_trailer_check",
    """WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey)
    SELECT 'nation_' || c_nationkey AS file, n + 2 AS line_count, CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN 9 ELSE n + 2 END AS trailer_count,
    CASE WHEN c_nationkey = 3 THEN 'bad_trailer' WHEN c_nationkey = 4 THEN 'count_mismatch' ELSE 'ok' END AS status FROM c""",
)
def dq03(t):
    lines = nation_lines(t)
    return Q.trailer_check(lines, "file", ["block", "seq"], 4, 8, includes_header=True)


def nation_lines(t):
    """Customers as fixed-width lines per nation, between a header and a counting trailer."""
    file = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("file")
    body = t.customer.select(
        file, F.floor(F.col("c_custkey") / 100_000).alias("block"), (F.col("c_custkey") + 1).alias("seq"),
        F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.rpad("c_name", 20, " ")).alias("line"),
    )
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("top"))
    claimed = F.when(F.col("c_nationkey") == 3, "????????").when(F.col("c_nationkey") == 4, "00000009").otherwise(F.lpad((F.col("n") + 2).cast("string"), 8, "0"))
    header = counts.select(file, F.lit(0).alias("block"), F.lit(0).alias("seq"), F.lit("HDR").alias("line"))
    trailer = counts.select(file, F.floor(F.col("top") / 100_000).alias("block"), (F.col("top") + 2).alias("seq"), F.concat(F.lit("TRL"), claimed).alias("line"))
    return body.unionByName(header).unionByName(trailer)


@query(
    "dq04_count_reconciliation",
    """WITH a AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS e FROM orders GROUP BY 1), b AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS l FROM orders
      WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01') GROUP BY 1)
    SELECT strftime(a.month, '%Y-%m') AS month, e AS expected_count, coalesce(l, 0) AS loaded_count, CASE WHEN e = coalesce(l, 0) THEN 'verified' ELSE 'unverified' END AS status FROM a LEFT JOIN b ON a.month = b.month""",
)
def dq04(t):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    counts = lambda df: df.groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    loaded = t.orders.filter(~((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < ts("1996-01-01"))))
    return Q.reconcile(counts(t.orders), counts(loaded), ["month"])


@query(
    "dq05_key_coercion",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS key FROM events""",
)
def dq05(t):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    raw = (
        F.when(kind == "click", F.concat(F.lit(" [\""), user, F.lit("\"] ")))
        .when(kind == "view", F.concat(F.lit("'"), user, F.lit("'")))
        .when(kind == "error", F.concat(F.lit("[u"), user, F.lit("]")))
        .otherwise(user)
    )
    return t.events.select("event_id", Q.coerce_key(raw, "bigint").alias("key"))


@query(
    "dq06_monotone_cursor",
    """SELECT event_type, greatest(TIMESTAMP '2024-01-30 23:00:00', max(ts)) AS cursor FROM events GROUP BY event_type""",
)
def dq06(t):
    saved = ts("2024-01-30 23:00:00")
    return t.events.groupBy("event_type").agg(F.greatest(F.max("ts"), saved).alias("cursor"))


CUSTOMER = TableSpec("customer", ("id",), {"id": "bigint", "balance": "decimal(12,2)", "segment": "string", "phone": "string"})


@query(
    "sch01_conform",
    """SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS phone, c_name AS extra_name FROM customer""",
)
def sch01(t):
    rows = t.customer.select(F.col("c_mktsegment").alias("SEGMENT"), F.col("c_name").alias("extra_name"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").cast("string").alias("id"))
    return CUSTOMER.conform(rows).withColumn("balance", F.col("balance").cast("string"))


@query(
    "sch02_key_check",
    """SELECT 'line' AS candidate, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys, CAST(0 AS BIGINT) AS null_keys, sum(n) = count(*) AS is_key
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    UNION ALL SELECT 'order', CAST(sum(n) AS BIGINT), count(*), 0, sum(n) = count(*) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)""",
)
def sch02(t):
    line = S.key_check(t.lineitem, ["l_orderkey", "l_linenumber"]).withColumn("candidate", F.lit("line"))
    return line.unionByName(S.key_check(t.orders, ["o_orderkey"]).withColumn("candidate", F.lit("order")))


@query(
    "sch02_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def sch02_duplicates(t):
    return S.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "sch03_schema_text",
    """SELECT 'part_' || (p_partkey // 1000) AS document, 'T' || p_partkey AS type_name, CAST(CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS BIGINT) AS field_count FROM part""",
)
def sch03(t):
    """Parts rendered as type definitions, five lines each, then counted."""
    name = F.concat(F.lit("type T"), F.col("p_partkey").cast("string"), F.lit(" {"))
    second = F.when(F.col("p_size") > 25, F.lit("  size: Int")).otherwise("  @deprecated: x")
    text = F.array(F.lit("type Query {"), F.lit("  ignored: T"), F.lit("}"), name, F.lit("  name: String"), second, F.lit("}"))
    rows = t.part.select(
        F.concat(F.lit("part_"), F.floor(F.col("p_partkey") / 1000).cast("string")).alias("document"), "p_partkey", F.posexplode(text).alias("pos", "line")
    )
    return S.schema_text_stats(rows, "document", ["p_partkey", "pos"], F.floor(F.col("p_partkey") / 100))


@query(
    "sch04_share_catalog",
    """SELECT 'shares' AS level, c_mktsegment AS share, CAST(NULL AS VARCHAR) AS schema_name, CAST(NULL AS VARCHAR) AS table_name FROM customer GROUP BY c_mktsegment
    UNION ALL SELECT 'schemas', c_mktsegment, 'nation_' || c_nationkey, NULL FROM customer GROUP BY c_mktsegment, c_nationkey
    UNION ALL SELECT 'tables', c_mktsegment, 'nation_' || c_nationkey, 'orders_' || c_custkey FROM customer
    UNION ALL SELECT 'tables', c_mktsegment, 'nation_' || c_nationkey, 'events_' || c_custkey FROM customer""",
)
def sch04(t):
    """Listings of one customer's tables each, in a schema per nation and a share per segment."""
    table = lambda prefix: F.concat(F.lit(prefix), F.col("c_custkey").cast("string"))
    name = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    schema = F.struct(name.alias("name"), F.array(table("orders_"), table("events_")).alias("tables"))
    parts = S.share_catalog(t.customer.select(F.col("c_mktsegment").alias("share"), F.array(schema).alias("schemas")))
    shares, schemas, tables = (df.withColumn("level", F.lit(n)) for df, n in zip(parts, ("shares", "schemas", "tables")))
    return tables.unionByName(schemas, allowMissingColumns=True).unionByName(shares, allowMissingColumns=True)
