"""Flatten and explode queries over nested frames built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import explode as E, flatten as L
from tidemark.queries.registry import query


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def charged_lines(t):
    """Order lines, each with its three charges as an ordered array of structs."""
    # The child's own l_returnflag is there to clash with the parent's.
    charge = lambda kind, amount: F.struct(
        F.lit("child").alias("l_returnflag"), F.lit(kind).alias("kind"), F.round(amount * 100).cast("long").alias("cents")
    )
    price = F.col("l_extendedprice")
    charges = F.array(charge("net", price), charge("tax", price * F.col("l_tax")), charge("discount", price * F.col("l_discount")))
    return t.lineitem.select(*LINE_KEY, "l_returnflag", charges.alias("charges"))


CHARGES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, kind, cents FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, 1 AS place, 'net' AS kind, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, 2, 'tax', CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, 3, 'discount', CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) FROM lineitem)"""


def nested_customers(t):
    """Customers as three-level structs with list fields."""
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_mktsegment").alias("code")).alias("segment")).alias("place"),
        ).alias("info"),
        F.when(F.col("c_acctbal") < 0, F.array().cast("array<string>")).when(F.col("c_nationkey") == 3, F.lit(None))
        .otherwise(F.array("c_mktsegment", "c_name")).alias("tags"),
    )


@query(
    "flt01_recursive_flatten",
    """SELECT c_custkey AS id, c_name AS info_name, c_nationkey AS info_place_nation, c_mktsegment AS info_place_segment_code,
    CASE WHEN c_acctbal < 0 THEN '[]' WHEN c_nationkey = 3 THEN NULL ELSE '["' || c_mktsegment || '","' || c_name || '"]' END AS tags FROM customer""",
)
def flt01(t):
    return L.flatten(nested_customers(t))


@query(
    "flt02_empty_list_policies",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 OR c_nationkey = 3 THEN NULL ELSE '["' || c_mktsegment || '","' || c_name || '"]' END AS as_null,
    CASE WHEN c_acctbal < 0 OR c_nationkey = 3 THEN '[]' ELSE '["' || c_mktsegment || '","' || c_name || '"]' END AS as_brackets FROM customer""",
)
def flt02(t):
    rows = nested_customers(t)
    tags = lambda policy: dict(L.flat_columns(rows.schema, lists=policy))["tags"]
    return rows.select("id", tags("null").alias("as_null"), tags("brackets").alias("as_brackets"))


@query(
    "flt03_comma_lists",
    """SELECT c_custkey AS id, c_name AS info_name, c_nationkey AS info_place_nation, c_mktsegment AS info_place_segment_code,
    CASE WHEN c_acctbal < 0 THEN '[]' WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment || ',' || c_name END AS tags FROM customer""",
)
def flt03(t):
    return L.flatten(nested_customers(t), lists="comma")


@query(
    "flt04_depth_bound",
    """SELECT c_custkey AS id, c_name AS info_name, c_nationkey AS info_place_nation, '{"code":"' || c_mktsegment || '"}' AS info_place_segment,
    CASE WHEN c_acctbal < 0 THEN '[]' WHEN c_nationkey = 3 THEN NULL ELSE '["' || c_mktsegment || '","' || c_name || '"]' END AS tags FROM customer""",
)
def flt04(t):
    return L.flatten(nested_customers(t), max_depth=2)


@query(
    "flt05_named_fields",
    "SELECT o_orderkey, o_custkey AS refund_id, o_totalprice AS refund_amount, o_orderpriority AS reason, o_orderstatus AS refund_tip_amount FROM orders",
)
def flt05(t):
    nested = t.orders.select(
        "o_orderkey",
        F.struct(
            F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("refund_amount"), F.col("o_orderstatus").alias("tipRefundAmount")
        ).alias("refund"),
        F.struct(F.col("o_orderpriority").alias("reason")).alias("details"),
    )
    return L.flatten_named(nested, ["refund", "details"], bare=["details"], renames={"refund.tipRefundAmount": "refund_tip_amount"})


@query("flt06_hoist", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS code FROM customer")
def flt06(t):
    nested = t.customer.select(
        F.col("c_custkey").alias("id"), F.lit("old").alias("name"),
        F.struct(F.col("c_name").alias("name")).alias("a"), F.struct(F.col("c_mktsegment").alias("code")).alias("b"),
    )
    return L.hoist(nested)


@query(
    "flt07_first_element",
    """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 OR c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS tags FROM customer""",
)
def flt07(t):
    return L.flatten(nested_customers(t).select("id", "tags"), lists="first")


@query(
    "flt08_metadata_columns",
    "SELECT event_id, json_extract_string(props, '$.k') AS metadata_k, event_type AS metadata_event_kind, CAST(NULL AS VARCHAR) AS metadata_absent FROM events",
)
def flt08(t):
    meta = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("event-kind"), F.col("event_type")))
    return L.map_to_columns(t.events.select("event_id", meta.alias("metadata")), "metadata", ["k", "event-kind", "absent"])


@query(
    "flt09_struct_blocks",
    """SELECT o_orderkey, c_name AS ship_to_name, c_nationkey AS ship_to_nation, n_name AS bill_to_name, n_regionkey AS bill_to_nation
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def flt09(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = joined.select(
        "o_orderkey", F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("to"),
        F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("nation")).alias("bill"),
    )
    return rows.select("o_orderkey", *L.struct_block(rows, "to", "ship_to"), *L.struct_block(rows, "bill", "bill_to"))


@query(
    "flt10_serialize_fields",
    """SELECT c_custkey AS id, '{"name":"' || c_name || '","place":{"nation":' || c_nationkey || ',"segment":{"code":"' || c_mktsegment || '"}}}' AS info FROM customer""",
)
def flt10(t):
    return L.serialize(nested_customers(t), ["info"]).select("id", "info")


@query("exp01_child_table", f"SELECT l_orderkey, l_linenumber, kind, cents FROM ({CHARGES_SQL})")
def exp01(t):
    return E.child_rows(charged_lines(t), ["l_orderkey", "l_linenumber"], "charges").drop("l_returnflag")


@query(
    "exp02_ordered_children",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(0 AS INTEGER) AS place, 'net' AS kind, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 1, 'tax', CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, 2, 'discount', CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) FROM lineitem""",
)
def exp02(t):
    return E.child_rows(charged_lines(t), LINE_KEY, "charges", index="place").drop("l_returnflag")


@query(
    "exp03_child_tree",
    """SELECT o_orderkey AS order_id, 'check' AS level, o_orderstatus AS guid, o_custkey AS key FROM orders
    UNION ALL SELECT o_orderkey, 'check', 'payment', o_custkey + 1 FROM orders
    UNION ALL SELECT o_orderkey, 'selection', o_orderstatus, o_custkey * 10 FROM orders
    UNION ALL SELECT o_orderkey, 'selection', o_orderstatus, o_custkey * 10 + 1 FROM orders WHERE o_totalprice > 250000
    UNION ALL SELECT o_orderkey, 'selection', 'payment', o_custkey * 10 FROM orders
    UNION ALL SELECT o_orderkey, 'selection', 'payment', o_custkey * 10 + 1 FROM orders WHERE o_totalprice > 250000
    UNION ALL SELECT o_orderkey, 'tax', o_orderstatus, o_custkey * 10 FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'tax', 'payment', o_custkey * 10 FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def exp03(t):
    """order -> checks -> selections -> taxes, every level carrying the keys above it."""
    tax = F.filter(F.array(F.struct(F.col("o_orderpriority").alias("name"))), lambda x: x["name"] == "1-URGENT")
    none = F.filter(F.array(F.struct(F.col("o_orderpriority").alias("name"))), lambda x: F.lit(False))
    item = lambda n, taxes, keep: F.struct((F.col("o_custkey") * 10 + n).alias("sel_id"), taxes.alias("taxes"), keep.alias("keep"))
    both = F.array(item(0, tax, F.lit(True)), item(1, none, F.col("o_totalprice") > 250000))
    selections = F.filter(both, lambda s: s["keep"])
    check = lambda guid, n: F.struct(guid.alias("guid"), (F.col("o_custkey") + n).alias("key"), selections.alias("selections"))
    tree = t.orders.select(F.col("o_orderkey").alias("order_id"), F.array(check(F.col("o_orderstatus"), 0), check(F.lit("payment"), 1)).alias("checks"))
    checks = E.child_rows(tree, ["order_id"], "checks")
    chosen = E.child_rows(checks, ["order_id", "guid"], "selections")
    taxes = E.child_rows(chosen, ["order_id", "guid", "sel_id"], "taxes")
    level = lambda df, name, key: df.select("order_id", F.lit(name).alias("level"), "guid", F.col(key).alias("key"))
    return level(checks, "check", "key").unionByName(level(chosen, "selection", "sel_id")).unionByName(level(taxes, "tax", "sel_id"))


@query(
    "exp04_nested_product",
    """SELECT p_partkey, v.title, o.option FROM part, (VALUES ('size', 'S'), ('size', 'L'), ('color', p_brand)) AS o(title, option),
    (VALUES ('size'), ('color')) AS v(title) WHERE v.title = o.title""",
)
def exp04(t):
    variants = F.array(
        F.struct(F.lit("size").alias("title"), F.array(F.lit("S"), F.lit("L")).alias("options")),
        F.struct(F.lit("color").alias("title"), F.array("p_brand").alias("options")),
    )
    rows = E.child_rows(t.part.select("p_partkey", variants.alias("variants")), ["p_partkey"], "variants")
    return rows.select("p_partkey", "title", F.explode("options").alias("option"))


@query(
    "exp05_map_entries",
    """SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events""",
)
def exp05(t):
    properties = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("type"), F.col("event_type")))
    return E.entries(t.events.select("event_id", properties.alias("p")), ["event_id"], "p", "name", "value")


def user_attributes(t):
    """Per user, event types mapped to the sorted hours they happened in."""
    hours = t.events.groupBy("user_id", "event_type").agg(F.sort_array(F.collect_set(F.hour("ts"))).alias("hours"))
    pairs = hours.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "hours"))).alias("attributes"))
    return pairs


@query(
    "exp06_map_of_arrays",
    "SELECT DISTINCT user_id, event_type AS key, CAST(hour(ts) AS INTEGER) AS value FROM events",
)
def exp06(t):
    return E.entries(user_attributes(t), ["user_id"], "attributes")


@query(
    "exp07_multi_valued_only",
    """WITH d AS (SELECT DISTINCT user_id, event_type AS key, CAST(hour(ts) AS INTEGER) AS value FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, key ORDER BY value) - 1 AS position, count(*) OVER (PARTITION BY user_id, key) AS c FROM d)
    SELECT user_id, key, CAST(position AS INTEGER) AS position, value FROM r WHERE c > 1""",
)
def exp07(t):
    return E.multi_valued(user_attributes(t), ["user_id"], "attributes")


@query(
    "exp08_link_table",
    "SELECT l_orderkey, 'part/' || l_partkey AS related FROM lineitem UNION SELECT l_orderkey, 'supplier/' || l_suppkey FROM lineitem",
)
def exp08(t):
    ref = lambda kind, key: F.concat_ws("/", F.lit(kind), F.col(key).cast("string"))
    rows = t.lineitem.select("l_orderkey", F.array(ref("part", "l_partkey"), ref("supplier", "l_suppkey")).alias("refs"))
    return E.links(rows, "l_orderkey", "refs", "related")


@query("exp09_expand_entity", CHARGES_SQL)
def exp09(t):
    """Charges inherit the line's scalars; their own l_returnflag loses to the parent's."""
    return E.expand(charged_lines(t), "charges")


@query(
    "exp09_expand_order_lines",
    """SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, kind, cents FROM orders JOIN (""" + CHARGES_SQL + """) ON o_orderkey = l_orderkey""",
)
def exp09_orders(t):
    """Orders -> lines -> charges: two nested navigation properties, expanded level by level."""
    lines = charged_lines(t).withColumnRenamed("l_orderkey", "o_orderkey")
    fields = [c for c in lines.columns if c != "o_orderkey"]
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    nested = orders.join(lines.select("o_orderkey", F.struct(*fields).alias("line")), "o_orderkey")
    return E.expand(E.expand(nested, "line"), "charges")


@query(
    "exp10_unpivot",
    """SELECT c_custkey, 'balance' AS keyword, c_acctbal AS interest FROM customer UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer""",
)
def exp10(t):
    wide = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"))
    return E.unpivot(wide, ["c_custkey"], ["balance", "nation"], "keyword", "interest")


@query(
    "exp11_deep_path",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS product, p_type AS vendor FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' AND p_type = 'SMALL'
    UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F' AND contains(p_name, 'small')""",
)
def exp11(t):
    """nodes[].matches[] with a flag, split on ':' and classified."""
    parts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    criteria = lambda vendor: F.concat_ws(":", F.lit("cpe"), F.lit("2.3"), F.lit("a"), F.col(vendor), F.col("p_partkey").cast("string"))
    match = lambda test, vendor: F.struct(test.alias("vulnerable"), criteria(vendor).alias("criteria"))
    nodes = F.array(
        F.struct(F.array(match(F.col("l_returnflag") == "R", "p_type")).alias("matches")),
        F.struct(F.array(match(F.col("l_linestatus") == "F", "p_name")).alias("matches")),
    )
    keys = ["l_orderkey", "l_linenumber", "l_suppkey"]
    all_matches = F.flatten(F.transform("nodes", lambda n: n["matches"]))
    rows = E.deep_rows(parts.withColumn("nodes", nodes), keys, all_matches, lambda m: m["vulnerable"])
    bits = rows.select(*keys, F.split("item.criteria", ":").alias("b")).filter(F.size("b") >= 5)
    app = bits.filter((F.col("b")[2] == "a") & F.lower(F.col("b")[3]).contains("small"))
    return app.select(*keys, F.col("b")[4].cast("long").alias("product"), F.col("b")[3].alias("vendor"))
