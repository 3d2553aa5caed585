"""Projection and predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.operators import predicates as P, projection as R
from tidemark.queries.registry import query
from tidemark.spec import ReadPlan


@query(
    "prj01_include_exclude",
    "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem",
)
def prj01(t):
    return R.project(t.lineitem, ["L_ORDERKEY", "l_quantity", "l_tax"], ["L_TAX"], ["l_shipdate"])


@query(
    "prj02_rename_map",
    "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
)
def prj02(t):
    return R.rename(t.customer, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "absent": "x"})


@query(
    "prj03_reserved_words",
    "SELECT p_partkey, p_brand AS taxon_class, p_name AS taxon_order, p_type AS document_type FROM part",
)
def prj03(t):
    rows = t.part.select("p_partkey", F.col("p_brand").alias("class"), F.col("p_name").alias("order"), F.col("p_type").alias("type"))
    return R.rename_reserved(rows)


@query(
    "prj04_whitelist",
    """SELECT event_id, CAST(floor(user_id) AS INTEGER) AS user_id, ts, CAST(NULL AS BIGINT) AS event_type FROM events""",
)
def prj04(t):
    text = t.events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return R.whitelist(text, {"event_id": "bigint", "user_id": "int", "ts": "timestamp", "event_type": "bigint", "absent": "string"})


@query(
    "prj05_header_names",
    "SELECT c_custkey AS customer_key__c1, c_name AS field_2nd_name__c2, c_acctbal AS balance__c3 FROM customer",
)
def prj05(t):
    raw = t.customer.select(F.col("c_custkey").alias(" Customer-Key "), F.col("c_name").alias("2nd  name!"), F.col("c_acctbal").alias("Balance (%)"))
    return raw.toDF(*[R.normal_name(c, f"C{i}") for i, c in enumerate(raw.columns, 1)])


@query(
    "prj05_normalized_headers",
    "SELECT c_custkey AS customer_key, c_name AS field_2nd_name, c_acctbal AS balance FROM customer",
)
def prj05_plain(t):
    raw = t.customer.select(F.col("c_custkey").alias(" Customer-Key "), F.col("c_name").alias("2nd  name!"), F.col("c_acctbal").alias("Balance (%)"))
    return R.normalize_headers(raw)


@query(
    "prj06_lineage_columns",
    "SELECT event_id, '2024-02-01' AS report_date, 'events' AS topic, 'events.parquet' AS source_file FROM events",
)
def prj06(t):
    rows = R.with_lineage(t.events.select("event_id"), file_name=True, report_date="2024-02-01", topic="events")
    # A large table is a folder of part files, so the table's own name is the part of the path to report.
    return rows.withColumn("source_file", F.regexp_extract("source_file", r"(events\.parquet)", 1))


@query(
    "prj07_sub_fields",
    """SELECT o_orderkey, o_custkey AS customer_id, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS label FROM orders""",
)
def prj07(t):
    nested = t.orders.select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("guid"), F.lit("x").alias("kind")).alias("customer"),
        F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("").alias("text"), F.col("o_orderpriority").alias("display")).alias("code"),
    )
    picked = nested.withColumn("label", R.first_present(F.col("code.text"), F.col("code.display")))
    return R.promote(picked, {"customer_id": "customer.guid"}).drop("code")


@query(
    "prj08_decode_labels",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status, o_orderpriority = '1-URGENT' AS urgent FROM orders""",
)
def prj08(t):
    status = R.decode_label(F.col("o_orderstatus"), {"F": "Filled", "O": "Open"}, "Unknown")
    return t.orders.select("o_orderkey", status.alias("status"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))


@query(
    "prj09_variant_value",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) WHEN 'click' THEN 'button'
      WHEN 'view' THEN 'true' WHEN 'signup' THEN CAST(user_id AS VARCHAR) END AS value_text, CASE WHEN event_type = 'purchase' THEN 'USD' END AS unit FROM events""",
)
def prj09(t):
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id",
        F.when(kind == "purchase", F.struct(F.col("value").cast("decimal(18,2)").alias("value"), F.lit("USD").alias("unit"))).alias("quantity"),
        F.when(kind == "click", F.struct(F.lit("button").alias("text"))).alias("concept"),
        F.when(kind == "view", F.lit(True)).alias("flag"),
        F.when(kind == "signup", F.col("user_id")).alias("whole"),
    )
    value = R.variant_value(
        [(F.col("quantity.value"), T.DecimalType(18, 2)), (F.col("concept.text"), T.StringType()), (F.col("flag"), T.BooleanType()), (F.col("whole"), T.LongType())]
    )
    return rows.select("event_id", value.alias("value_text"), F.col("quantity.unit").alias("unit"))


@query(
    "fil01_static_predicate",
    """SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity >= 45 AND l_shipdate > TIMESTAMP '1997-01-01' AND l_shipdate <= TIMESTAMP '1999-01-01'""",
)
def fil01(t):
    low, high = (F.lit(d).cast("timestamp") for d in ("1997-01-01", "1999-01-01"))
    plan = ReadPlan("lineitem", ("l_orderkey", "l_quantity"), (), "l_shipdate", low, high, ("l_quantity", ">=", 45.0))
    return plan.apply(t.lineitem)


@query(
    "fil02_required_keys",
    """SELECT event_type, CAST(count(*) FILTER (WHERE value >= 1) AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE value < 1) AS BIGINT) AS rejected FROM events GROUP BY event_type""",
)
def fil02(t):
    rows = t.events.withColumn("key", F.when(F.col("value") < 0.5, None).when(F.col("value") < 1, "  ").otherwise(F.col("event_id").cast("string")))
    missing = P.key_missing(["key"])
    return rows.groupBy("event_type").agg(F.count_if(~missing).alias("kept"), F.count_if(missing).alias("rejected"))


@query(
    "fil03_include_exclude_lists",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
)
def fil03(t):
    key = F.col("c_custkey").alias("o_custkey")
    include = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(key)
    exclude = t.customer.filter(F.col("c_acctbal") < 0).select(key)
    return P.include_exclude(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", include, exclude)


@query(
    "fil04_relevance",
    r"""SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, 'b[a-z]+')) = 0
    OR list_has_any(regexp_extract_all(text, 'b[a-z]+'), ['ble', 'by', 'bled']) OR contains(lower(text), 'api')""",
)
def fil04(t):
    codes = F.regexp_extract_all("text", F.lit("b[a-z]+"), F.lit(0))
    return t.documents.filter(P.relevant(codes, ["ble", "by", "bled"], F.col("text"), "API")).select("doc_id")


@query(
    "fil05_listed_values",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
)
def fil05(t):
    return t.events.filter(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query("fil06_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%'")
def fil06(t):
    return t.part.filter(F.col("p_name").startswith("s")).select("p_partkey", "p_name")


@query(
    "fil07_composed_search",
    """SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' AND contains(lower(o_orderpriority), '1-urgent')
    UNION ALL SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
)
def fil07(t):
    with_term = t.orders.filter(P.search("o_orderdate", "1996-01-01", "1996-12-31", "o_orderpriority", "1-Urgent"))
    dates_only = t.orders.filter(P.search("o_orderdate", "1998-06-01", "1998-06-30"))
    return with_term.select("o_orderkey").unionByName(dates_only.select("o_orderkey"))


@query(
    "fil08_record_ceiling",
    """SELECT o_orderdate, o_orderkey, o_totalprice FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1997-03-01', 100)
    ORDER BY o_orderdate, o_orderkey LIMIT 500""",
)
def fil08(t):
    from tidemark.sources.tables import keyset_page

    start = (F.lit("1997-03-01").cast("timestamp"), 100)
    return keyset_page(t.orders, "o_orderdate", "o_orderkey", start, 500).select("o_orderdate", "o_orderkey", "o_totalprice")
