"""Destination queries and whole sync flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import with_row_key
from tidemark.operators import aggregates as A, changes as G
from tidemark.plans import sync
from tidemark.queries.registry import query
from tidemark.session import work_path
from tidemark.sinks import merge as M
from tidemark.sinks.group import Output, TableGroup, fan_out
from tidemark.sinks.versioned import VersionedTable
from tidemark.spec import ReadPlan, TableSpec

ts = lambda text: F.lit(text).cast("timestamp")

BATCH_SQL = """SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey + 100000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'"""


def change_batch(t):
    """Open orders filled in two steps (the second wins) and urgent orders copied as new ones."""
    open_rows = t.orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= ts("1998-01-01")))
    first = open_rows.withColumns({"o_orderstatus": F.lit("X"), "seq": F.lit(1)})
    second = open_rows.withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.round(F.col("o_totalprice") * 2, 2), "seq": F.lit(2)})
    new = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").withColumns(
        {"o_orderkey": F.col("o_orderkey") + 100_000_000, "o_orderstatus": F.lit("N"), "seq": F.lit(1)}
    )
    return second.unionByName(first).unionByName(new)


@query(
    "snk01_keyed_upsert",
    f"""WITH b AS ({BATCH_SQL}) SELECT * FROM b UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""",
)
def snk01(t):
    return M.upsert(t.orders, change_batch(t), ["o_orderkey"], ["seq"])


@query(
    "snk01_versioned_merge",
    f"""WITH b AS ({BATCH_SQL}), r AS (SELECT * FROM b UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b))
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM r GROUP BY o_orderstatus""",
)
def snk01_versioned(t):
    """The same merge committed to a bucketed table: only touched buckets are written again."""
    table = VersionedTable(t.spark, work_path(t.spark, "orders"), ["o_orderkey"])
    table.replace(t.orders)
    table.merge(change_batch(t), ["seq"])
    return table.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), A.money_sum("o_totalprice").alias("total"))


@query("snk02_delete_keys", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def snk02(t):
    gone = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return M.delete_keys(t.orders, gone, ["o_custkey"]).select("o_orderkey", "o_orderstatus")


@query("snk03_truncate_reload", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'")
def snk03(t):
    table = VersionedTable(t.spark, work_path(t.spark, "customers"), ["c_custkey"])
    rows = t.customer.select("c_custkey", "c_name")
    table.replace(rows)
    table.replace(t.customer.filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey", "c_name"))
    return table.read()


@query(
    "snk04_soft_delete",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS c_name, c_acctbal < 0 AS purge_indicator FROM customer""",
)
def snk04(t):
    current = t.customer.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_name")
    return G.soft_deletes(t.customer, current, ["c_custkey"])


@query(
    "snk05_resumable_state",
    "SELECT o_orderkey, o_orderdate, o_totalprice, (SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders) AS cursor FROM orders",
)
def snk05(t):
    """Three bounded runs drain the source; cursor and rows are committed together each time."""
    table = VersionedTable(t.spark, work_path(t.spark, "resume"), ["o_orderkey"])
    spec = TableSpec("orders", ("o_orderkey",), {"o_orderkey": "bigint", "o_orderdate": "timestamp", "o_totalprice": "double"})
    source = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    for high in ("1997-01-01", "1999-06-15", None):
        bound = None if high is None else ts(high)
        sync.sync_table(source, table, spec, ReadPlan("orders", cursor="o_orderdate", high=bound))
    return table.read().withColumn("cursor", F.lit(table.state()["orders"]["cursor"]))


@query(
    "snk06_fan_out",
    """SELECT 'orders' AS table_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders UNION ALL SELECT 'notes', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'order_tags', 2 * count(*), CAST(2 * sum(o_orderkey) AS BIGINT) FROM orders""",
)
def snk06(t):
    """One landed source feeds a parent, a child and a link table, all in one commit for each of two batches; the second
    takes back a note and a tag of each order that the first had."""
    notes = F.when(F.col("o_orderstatus") != "P", F.array(F.struct(F.lit(0).alias("note_no"), F.col("o_orderpriority").alias("text"))))
    notes = notes.otherwise(F.array().cast("array<struct<note_no:int,text:string>>"))
    source = t.orders.select("o_orderkey", "o_custkey", notes.alias("notes"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    early = source.filter("o_orderkey % 4 = 0").withColumns(
        {"notes": F.array(*[F.struct(F.lit(i).alias("note_no"), F.lit("draft").alias("text")) for i in (0, 1)]), "tags": F.array_append("tags", F.lit("draft"))}
    )
    group = TableGroup(t.spark, work_path(t.spark, "fanout"), {"orders": ["o_orderkey"], "notes": ["o_orderkey", "note_no"], "order_tags": ["o_orderkey", "tag"]})
    outputs = {
        "orders": Output(lambda b: b.select("o_orderkey", "o_custkey")),
        "notes": Output(lambda b: b.select("o_orderkey", F.explode("notes").alias("note")).select("o_orderkey", "note.*"), parent=("o_orderkey",)),
        "order_tags": Output(lambda b: b.select("o_orderkey", F.explode("tags").alias("tag")), parent=("o_orderkey",)),
    }
    for number, batch in enumerate((early, source)):
        fan_out(group, batch, outputs, batch=("orders", number))
    stat = lambda name, df: df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")).select(F.lit(name).alias("table_name"), "n", "key_sum")
    names = ["orders", "notes", "order_tags"]
    stats = [stat(n, df) for n, df in zip(names, group.read(*names))]
    return stats[0].unionByName(stats[1]).unionByName(stats[2])


@query(
    "snk07_schema_evolution",
    """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance, CAST(NULL AS VARCHAR) AS phone FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR) FROM supplier
    UNION ALL SELECT p_partkey, NULL, NULL, p_brand FROM part""",
)
def snk07(t):
    return M.evolve(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
            t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("phone")),
        ]
    )


@query(
    "snk08_keyless_rows",
    """SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS qty, sha256('{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '","qty":' || CAST(l_quantity AS INTEGER) || '}') AS row_key FROM lineitem""",
)
def snk08(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("qty"))
    old, new = rows.filter(F.col("l_returnflag") != "R"), rows.filter(F.col("l_linestatus") == "F")
    return M.upsert_rows(old.unionByName(rows.filter(F.col("l_returnflag") == "R")), new)


@query(
    "snk09_versioned_snapshots",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 :: DOUBLE ELSE c_acctbal END AS balance, CASE WHEN c_acctbal < 0 THEN '2024-01-02' ELSE '2024-01-01' END AS fetch_date FROM customer""",
)
def snk09(t):
    first = M.snapshot(t.customer.select("c_custkey", F.col("c_acctbal").alias("balance")), F.lit("2024-01-01"))
    debtors = t.customer.filter(F.col("c_acctbal") < 0).select("c_custkey", F.lit(0.0).alias("balance"))
    return M.latest_snapshot(first.unionByName(M.snapshot(debtors, F.lit("2024-01-02"))), ["c_custkey"])


@query(
    "snk10_run_audit",
    """SELECT 'run-1' AS run_id, CAST(3 AS BIGINT) AS table_count, (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM events) AS record_count, 90.5 :: DOUBLE AS duration_seconds""",
)
def snk10(t):
    counts = A.census({n: getattr(t, n) for n in ("orders", "customer", "events")})
    return M.audit_row(counts, "run-1", ts("2024-02-01 00:00:00"), ts("2024-02-01 00:01:30.5"))


@query(
    "sync_orders_by_status",
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice,
      o_orderdate FROM orders), m AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM s WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1997-06-01', 500)
      UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT ((o_orderdate, o_orderkey) > (TIMESTAMP '1997-06-01', 500)))
    SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM m WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F') GROUP BY o_orderstatus""",
)
def sync_orders(t):
    """Flagship: merge a source past a compound cursor, delete removed keys, sum by status."""
    is_open = F.col("o_orderstatus") == "P"
    source = t.orders.withColumns(
        {
            "o_totalprice": F.when(is_open, F.round(F.col("o_totalprice") * 2, 2)).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(is_open, "F").otherwise(F.col("o_orderstatus")),
        }
    )
    merged = sync.sync_batch(t.orders, source, ["o_orderkey"], "o_orderdate", ts("1997-06-01"), 500, ["o_orderdate"])
    gone = t.orders.filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")).select("o_orderkey")
    final = M.delete_keys(merged, gone, ["o_orderkey"])
    return final.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), A.money_sum("o_totalprice").alias("total"))


@query(
    "sync_fixed_width_files",
    """SELECT c_custkey AS uid, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name, CASE WHEN c_mktsegment <> 'BUILDING' THEN round(abs(c_acctbal) * 100) / 100.0 END AS balance,
    c_mktsegment = 'BUILDING' AS purge_indicator FROM customer""",
)
def sync_files_query(t):
    """Two full feeds in turn: the second misses a segment, which becomes soft-deleted rows."""
    from tidemark.plans.files import FileSpec, file_tables, sync_files
    from tidemark.sources.fixed_width import FixedField

    spec = FileSpec(
        (FixedField("uid", 1, 10, "STRING"), FixedField("name", 11, 22), FixedField("balance", 33, 11, "FLOAT", 2)), r"^part-.*\.txt$", 4, 12, purge=True
    )
    group = file_tables(t.spark, work_path(t.spark, "cards"), "cards", ["uid"])
    for number, rows in enumerate((t.customer, t.customer.filter(F.col("c_mktsegment") != "BUILDING"))):
        folder = work_path(t.spark, f"cards-{number}")
        write_card_files(rows, folder)
        sync_files(t.spark, folder, group, "cards", spec)
    return group.read("cards").withColumn("uid", F.col("uid").cast("long"))


def write_card_files(customers, folder: str) -> None:
    """A feed file per 10,000 customer keys, each between a header and a counting trailer."""
    number = F.floor(F.col("c_custkey") / 10_000).alias("feed")
    cents = F.lpad(F.round(F.abs("c_acctbal") * 100).cast("long").cast("string"), 11, "0")
    record = F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, "0"), F.rpad("c_name", 22, " "), cents)
    body = customers.select(number, F.lit(1).alias("place"), "c_custkey", record.alias("value"))
    counted = customers.groupBy(number).agg(F.count(F.lit(1)).alias("n"))
    end = lambda place, text: counted.select("feed", F.lit(place).alias("place"), F.lit(0).cast("long").alias("c_custkey"), text.alias("value"))
    claimed = F.concat(F.lit("TRL"), F.lpad((F.col("n") + 2).cast("string"), 12, "0"))
    lines = body.unionByName(end(0, F.lit("HDR"))).unionByName(end(2, claimed))
    ordered = lines.repartition("feed").sortWithinPartitions("feed", "place", "c_custkey")
    ordered.select("feed", "value").write.partitionBy("feed").text(folder)


@query(
    "sync_with_drift_repair",
    """WITH c AS (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n, count(*) FILTER (WHERE value <= 150) AS p FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 240 HOUR AND ts < TIMESTAMP '2024-01-30 12:00:00' GROUP BY 1, 2)
    SELECT event_id, value FROM events WHERE value <= 150 AND ts < TIMESTAMP '2024-01-30 12:30:00' UNION SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:30:00'
    UNION SELECT e.event_id, e.value FROM events e JOIN c ON e.event_type = c.event_type AND date_trunc('hour', e.ts) = c.h WHERE c.n > c.p""",
)
def sync_repair(t):
    """Large values arrived late: drifted hours are read again and merged with the fresh rows."""
    cursor, entity = ts("2024-01-30 12:30:00"), F.col("event_type")
    known = t.events.filter((F.col("value") <= 150) & (F.col("ts") < cursor))
    now = G.hourly_counts(t.events, "ts", entity, cursor, 240)
    before = G.hourly_counts(known, "ts", entity, cursor, 240)
    until = F.date_trunc("hour", cursor)
    since = until - F.expr("INTERVAL 240 HOURS")
    return sync.repair_and_sync(known, t.events, ["event_id"], "ts", entity, cursor, now, before, since, until).select("event_id", "value")
