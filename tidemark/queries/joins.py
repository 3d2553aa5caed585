"""Join and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.queries.registry import query
from tidemark.sources import graph as GR

ts = lambda text: F.lit(text).cast("timestamp")


@query(
    "jn01_parent_keys",
    "SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def jn01(t):
    parents = t.customer.select("c_custkey", "c_name")
    return J.with_parent(parents, t.orders.select("o_orderkey", "o_custkey"), "c_custkey", "o_custkey").select("o_orderkey", "o_custkey", "c_name")


@query(
    "jn02_lookup_default",
    "SELECT c_custkey, coalesce(n_name, 'col_' || c_nationkey) AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey",
)
def jn02(t):
    known = t.nation.filter(F.col("n_regionkey") < 3)
    return J.lookup(t.customer.select("c_custkey", "c_nationkey"), known, "c_nationkey", "n_nationkey", "n_name", "nation", "col_").select("c_custkey", "nation")


@query(
    "jn03_catalog_join",
    """WITH columns AS (SELECT DISTINCT p_type AS table_name, p_brand AS column_name FROM part), keys AS (SELECT p_type AS table_name, max(p_brand) AS column_name FROM part GROUP BY p_type)
    SELECT c.table_name, c.column_name, k.column_name IS NOT NULL AS is_key FROM columns c LEFT JOIN keys k ON c.table_name = k.table_name AND c.column_name = k.column_name
    WHERE c.table_name IN (SELECT p_type FROM part GROUP BY p_type HAVING count(*) > 10)""",
)
def jn03(t):
    name, column = F.col("p_type").alias("table_name"), F.col("p_brand").alias("column_name")
    columns = t.part.select(name, column).distinct()
    keys = t.part.groupBy(name).agg(F.max("p_brand").alias("column_name"))
    tables = t.part.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 10).select("table_name")
    return J.catalog(columns, keys, tables)


@query("jn04_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def jn04(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey").join(done, "c_custkey", "left_anti")


@query(
    "jn05_semi_join",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)",
)
def jn05(t):
    poor = t.supplier.filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("l_suppkey"))
    return t.lineitem.join(poor, "l_suppkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "jn06_nest_top_children",
    """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    SELECT c_custkey, string_agg(o_orderkey, ',' ORDER BY rn) AS top_orders FROM customer LEFT JOIN r ON c_custkey = o_custkey AND rn <= 3 GROUP BY c_custkey""",
)
def jn06(t):
    children = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    nested = J.nest_top(t.customer.select("c_custkey"), children, "c_custkey", order, ["o_orderkey"], 3, "items")
    keys = F.transform("items", lambda i: i["o_orderkey"].cast("string"))
    return nested.select("c_custkey", F.array_join(keys, ",").alias("top_orders"))


MAPPING = "0:alpha,beta|1:gamma| 7 : delta , alpha|broken|12:zeta"


@query(
    "jn07_mapping_string",
    """SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'alpha,beta' WHEN 1 THEN 'gamma' WHEN 7 THEN 'alpha,delta' WHEN 12 THEN 'zeta' ELSE 'none' END AS members FROM customer""",
)
def jn07(t):
    mapping = J.mapping_rows(t.spark, MAPPING)
    rows = J.enrich_by_mapping(t.customer.select("c_custkey", "c_nationkey"), mapping, F.col("c_nationkey").cast("string"), "code", "member", "none")
    return rows.select("c_custkey", "members")


@query(
    "jn08_dual_assessment",
    """WITH a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'HIGH' ELSE 'LOW' END AS v FROM orders WHERE o_orderstatus <> 'P'),
    b AS (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH' ELSE 'LOW' END AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT a.o_orderkey, a.v AS first_opinion, b.v AS second_opinion, a.v <> b.v AS disagree FROM a JOIN b ON a.o_orderkey = b.o_orderkey""",
)
def jn08(t):
    level = lambda test: F.when(test, "HIGH").otherwise("LOW").alias("verdict")
    a = t.orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey", level(F.col("o_totalprice") > 300000))
    b = t.orders.filter(F.col("o_orderdate") >= ts("1996-01-01")).select("o_orderkey", level(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")))
    return J.both_opinions(a, b, "o_orderkey", "verdict")


@query(
    "jn09_task_grid",
    """WITH g AS (SELECT user_id, unnest(generate_series(0, 23)) AS hour FROM (SELECT DISTINCT user_id FROM events)),
    c AS (SELECT user_id, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT g.user_id, CAST(g.hour AS INTEGER) AS hour, coalesce(c.n, 0) AS n FROM g LEFT JOIN c ON g.user_id = c.user_id AND g.hour = c.hour""",
)
def jn09(t):
    grid = J.task_grid(t.events.select("user_id").distinct(), "user_id", F.sequence(F.lit(0), F.lit(23)), "hour")
    facts = t.events.groupBy("user_id", F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return J.fill_grid(grid, facts, ["user_id", "hour"], "n")


@query(
    "jn10_graph_triplets",
    """SELECT 'customer:' || c_custkey AS src_id, 'customer' AS src_label, c_name AS src_name, 'customer:' || c_custkey || '_lives_in_nation:' || n_nationkey AS edge_id,
    'nation:' || n_nationkey AS dst_id, 'nation' AS dst_label, n_name AS dst_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def jn10(t):
    vertices = GR.vertices({"customer": (t.customer, "c_custkey", "c_name"), "nation": (t.nation, "n_nationkey", "n_name"), "region": (t.region, "r_regionkey", "r_name")})
    lives = GR.edges(t.customer, "lives_in", ("customer", "c_custkey"), ("nation", "c_nationkey"))
    part_of = GR.edges(t.nation, "part_of", ("nation", "n_nationkey"), ("region", "n_regionkey"))
    rows = J.triplets(vertices, lives.unionByName(part_of), "lives_in")
    return rows.drop("edge_label")


@query(
    "jn11_reference_ids",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def jn11(t):
    refs = t.orders.select("o_orderkey", F.concat(F.lit("https://x/Customer/"), F.col("o_custkey").cast("string")).alias("subject"))
    resolved = refs.withColumn("c_custkey", J.reference_id(F.col("subject")).cast("long"))
    return resolved.join(t.customer, "c_custkey").select("o_orderkey", "c_name")


@query(
    "jn12_time_windows",
    """WITH w AS (SELECT user_id AS run_id, min(ts) AS gte, min(ts) + INTERVAL 90 MINUTE AS lt FROM events GROUP BY user_id)
    SELECT e.event_id, w.run_id FROM events e JOIN w ON e.ts >= w.gte AND e.ts < w.lt""",
)
def jn12(t):
    windows = t.events.groupBy(F.col("user_id").alias("run_id")).agg(F.min("ts").alias("gte")).withColumn("lt", F.col("gte") + F.expr("INTERVAL 90 MINUTES"))
    return J.in_windows(t.events.select("event_id", "ts"), "ts", windows, "hour").select("event_id", "run_id")
