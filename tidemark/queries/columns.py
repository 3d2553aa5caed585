"""String, math, array, map, JSON and key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import arrays as A, keys as K, text as X
from tidemark.queries.registry import query


@query(
    "str01_narrative_fields",
    """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS ach_cust_id, c_mktsegment || ' payment' AS ach_description, c_name AS ach_comp_name,
    'N' || c_nationkey AS ach_comp_id, 'PPD' AS ach_sec_code, upper(c_name) AS ach_cust_name, '01-02-24' AS ach_tran_date,
    '10:30 AM' AS ach_tran_time, 'ref ' || c_custkey AS ach_addenda, CAST(NULL AS VARCHAR) AS ach_batch_discr FROM customer""",
)
def str01(t):
    s = F.lit
    narrative = F.concat(
        s("cust ID: "), F.col("c_custkey").cast("string"), s(" Desc: "), F.col("c_mktsegment"), s(" payment Comp  Name: "), F.col("c_name"),
        s(" Comp ID: N"), F.col("c_nationkey").cast("string"), s(" SEC: PPD Cust Name: "), F.upper("c_name"),
        s(" Date: 01-02-24 Time: 10:30 AM Addenda: ref "), F.col("c_custkey").cast("string"),
    )
    return X.narrative_fields(t.customer.select("c_custkey", narrative.alias("narrative")), "narrative").drop("narrative")


@query(
    "str02_free_text_matches",
    r"""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[0-9]{3,}'))), ',') AS numbers,
    CAST(len(list_distinct(regexp_extract_all(text, '[0-9]{3,}'))) AS INTEGER) AS n FROM documents""",
)
def str02(t):
    found = X.distinct_matches(F.col("text"), "[0-9]{3,}")
    return t.documents.select("doc_id", F.array_join(found, ",").alias("numbers"), F.size(found).alias("n"))


@query(
    "str02_fixed_version",
    "SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_size || '.1 or ' || p_size || '.2' END AS fixed_in FROM part",
)
def str02_fix(t):
    size = F.col("p_size").cast("string")
    notice = F.when(
        F.col("p_size") <= 25, F.concat(F.lit("Overflow, Fixed in version "), size, F.lit(".1 or "), size, F.lit(".2, please update"))
    ).otherwise("No fix yet")
    return t.part.select("p_partkey", X.fixed_version(notice).alias("fixed_in"))


@query(
    "str03_text_sections",
    """SELECT p_partkey, 'The ' || p_name || ' shows a risk' AS assessment,
    CASE WHEN p_size > 9 THEN 'Inspect all ' || p_size || ' units' ELSE 'Look again later' END AS actions FROM part""",
)
def str03(t):
    size = F.col("p_size").cast("string")
    advice = F.when(F.col("p_size") > 9, F.concat(F.lit("Inspect all "), size, F.lit(" units"))).otherwise("None")
    answer = F.concat(
        F.lit("Intro.\nOutlook: The "), F.col("p_name"), F.lit(" shows a risk\nSTORES CONCERNED: none\nNext Steps:  "), advice
    )
    rows = t.part.withColumn("answer", answer)
    c = F.col("answer")
    return rows.select(
        "p_partkey",
        X.section(c, "OUTLOOK:", "STORES CONCERNED:", "Nothing to report").alias("assessment"),
        X.section(c, "NEXT STEPS:", "EARLIER CASES:", "Look again later").alias("actions"),
    )


@query(
    "str04_truncate",
    """SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '... [truncated]' ELSE text END AS short_text FROM documents""",
)
def str04(t):
    return t.documents.select("doc_id", X.truncate_marked(F.col("text"), 500).alias("short_text"))


@query(
    "str05_join_lists",
    """SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN c_mktsegment ELSE c_name END || '; ' || c_mktsegment AS names,
    CASE WHEN c_nationkey < 20 THEN c_nationkey || ',' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS ids,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS maybe FROM customer""",
)
def str05(t):
    named = F.array(
        F.struct(F.when(F.col("c_nationkey") >= 5, F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("raw_name")),
        F.struct(F.lit("").alias("name"), F.col("c_mktsegment").alias("raw_name")),
    )
    ids = F.array(F.when(F.col("c_nationkey") < 20, F.col("c_nationkey").cast("long")), F.col("c_custkey"))
    return t.customer.select(
        "c_custkey", X.join_names(named).alias("names"), X.join_values(ids).alias("ids"),
        X.join_values(F.array(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))).alias("maybe"),
    )


@query(
    "str06_zero_pad",
    "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded, CASE WHEN c_custkey < 10 THEN '0' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS two FROM customer",
)
def str06(t):
    return t.customer.select("c_custkey", X.zero_pad(F.col("c_custkey"), 10).alias("padded"), X.zero_pad(F.col("c_custkey"), 2).alias("two"))


@query(
    "str07_cleanup",
    """SELECT p_partkey, replace(lower(p_type || ' ' || p_name), ' ', '_') AS slug, replace(p_brand, 'Brand#', '') AS code,
    replace(p_name, ' ', '_') || '_x' AS table_name FROM part""",
)
def str07(t):
    return t.part.select(
        "p_partkey", X.slug(F.concat_ws(" ", "p_type", F.concat("p_name", F.lit("!")))).alias("slug"),
        X.without_prefix(F.col("p_brand"), "Brand#").alias("code"),
        X.table_name_of(F.concat(F.lit("0a-1b_"), F.regexp_replace(F.initcap("p_name"), " ", "_"), F.lit("_X.csv.gz"))).alias("table_name"),
    )


@query(
    "str08_placeholder",
    "SELECT p_partkey, p_size <= 30 AS unset FROM part",
)
def str08(t):
    size = F.col("p_size")
    value = F.when(size <= 10, F.lit(None)).when(size <= 20, "").when(size <= 30, F.concat(F.lit("<"), "p_name", F.lit(">"))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", X.is_placeholder(value).alias("unset"))


@query(
    "str09_json_in_prose",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events",
)
def str09(t):
    prose = F.when(F.col("event_type") == "error", "no { answer }").otherwise(F.concat(F.lit("Sure, here: "), "props", F.lit(" and so on")))
    return t.events.select("event_id", X.json_fields(prose, "k int")["k"].alias("k"))


@query(
    "str10_payload_ladder",
    """SELECT event_id, CASE WHEN event_type IN ('click','view','purchase') THEN props END AS json,
    CASE WHEN event_type NOT IN ('click','view','purchase','error') THEN 'plain ' || event_id END AS raw_data,
    CASE WHEN event_type = 'error' THEN base64('\\xFF\\xFE'::BLOB || encode(CAST(event_id AS VARCHAR))) END AS raw_data_base64 FROM events""",
)
def str10(t):
    kind = F.col("event_type")
    payload = (
        F.when(kind.isin("click", "view", "purchase"), F.col("props").cast("binary"))
        .when(kind == "error", F.concat(F.unhex(F.lit("FFFE")), F.col("event_id").cast("string").cast("binary")))
        .otherwise(F.concat(F.lit("plain "), F.col("event_id").cast("string")).cast("binary"))
    )
    rows = t.events.select("event_id", payload.alias("payload"))
    return rows.select("event_id", *[c.alias(n) for n, c in X.decode_payload(F.col("payload")).items()])


@query(
    "mth01_range_class",
    """SELECT p_partkey, CASE WHEN p_size * 15 BETWEEN 100 AND 399 THEN 'C' WHEN p_size * 15 BETWEEN 400 AND 699 THEN 'D' END AS mark FROM part""",
)
def mth01(t):
    return t.part.select("p_partkey", A.debit_credit((F.col("p_size") * 15).cast("string")).alias("mark"))


@query("mth02_rounding", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / 7, 6) AS unit_price FROM lineitem")
def mth02(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") / 7, 6).alias("unit_price")
    )


@query(
    "arr01_first_match",
    r"""SELECT doc_id, ([x FOR x IN regexp_extract_all(text, '\w+') IF starts_with(x, 'th')])[1] AS first_th FROM documents""",
)
def arr01(t):
    words = F.regexp_extract_all("text", F.lit(r"\w+"), F.lit(0))
    return t.documents.select("doc_id", A.first_where(words, lambda w: w.startswith("th")).alias("first_th"))


@query(
    "arr02_filter_project",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 'part/' || l_partkey || CASE WHEN l_linestatus = 'F' THEN ',supp/' || l_suppkey ELSE '' END
      ELSE 'supp/' || l_suppkey END AS urls FROM lineitem WHERE l_returnflag = 'R' OR l_linestatus = 'F'""",
)
def arr02(t):
    ref = lambda kind, key, tag: F.struct(F.concat_ws("/", F.lit(kind), F.col(key).cast("string")).alias("url"), F.col(tag).alias("tag"))
    rows = t.lineitem.withColumn("refs", F.array(ref("part", "l_partkey", "l_returnflag"), ref("supp", "l_suppkey", "l_linestatus")))
    picked = A.pick_where(F.col("refs"), lambda r: r["tag"].isin("R", "F"), "url")
    out = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", picked.alias("urls")).filter(F.size("urls") > 0)
    return out.withColumn("urls", F.array_join("urls", ","))


@query(
    "arr03_stride_groups",
    """SELECT o_orderkey, o_totalprice AS b010, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS DOUBLE) / 100 ELSE 0.0 END AS b015,
    CAST(2 AS INTEGER) AS n FROM orders""",
)
def arr03(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    last = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise("000")
    flat = F.concat(F.lit("010,+"), cents, F.lit(",1,Z,015,777,,,xx,5,,,015,"), last, F.lit(",,"))
    rows = t.orders.select("o_orderkey", A.balance_map(F.array(flat)).alias("m"))
    return rows.select("o_orderkey", F.col("m")["010"].alias("b010"), F.col("m")["015"].alias("b015"), F.size("m").alias("n"))


@query(
    "map01_map_to_columns",
    """SELECT o_custkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS balance_f,
    CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS balance_o,
    CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS balance_p FROM orders GROUP BY o_custkey""",
)
def map01(t):
    from tidemark.operators.aggregates import money_sum

    sums = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(money_sum("o_totalprice"))
    return sums.toDF("o_custkey", "balance_f", "balance_o", "balance_p")


@query(
    "jsn01_parse_serialize",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{"event":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS out FROM events""",
)
def jsn01(t):
    rows = t.events.select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("event_type").alias("event"), F.col("p.k").alias("k"))).alias("out"))


@query("key01_md5", "SELECT event_id, md5(user_id || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS id FROM events")
def key01(t):
    return t.events.select("event_id", K.md5_key(F.col("user_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("id"))


@query(
    "key02_message_id",
    "SELECT event_id, event_type || '_' || event_id || '_' || substring(sha256(event_type || ':' || event_id || ':' || props), 1, 16) AS id FROM events",
)
def key02(t):
    return t.events.select("event_id", K.message_id(F.col("event_type"), F.col("event_id"), F.col("props")).alias("id"))


@query(
    "key03_document_id",
    """SELECT p_partkey, CASE WHEN p_size <= 20 THEN CAST(p_partkey AS VARCHAR) WHEN p_size <= 35 THEN 'u' || p_partkey
    ELSE sha256('{"brand": "' || p_brand || '", "name": "' || p_name || '", "type": "' || p_type || '"}') END AS id FROM part""",
)
def key03(t):
    s = F.lit
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    fields = [s("name"), F.col("p_name"), s("brand"), F.col("p_brand"), s("type"), F.col("p_type")]
    doc = (
        F.when(size <= 20, F.create_map(*fields, s("id"), key))
        .when(size <= 35, F.create_map(*fields, s("_id"), F.concat(s("u"), key)))
        .otherwise(F.create_map(*fields))
    )
    return t.part.select("p_partkey", doc.alias("doc")).select("p_partkey", K.document_id(F.col("doc")).alias("id"))


@query(
    "key04_series_id",
    "SELECT DISTINCT user_id, event_type, md5('events_total{type=' || event_type || ',user=' || user_id || '}') AS id FROM events",
)
def key04(t):
    series = t.events.select("user_id", "event_type").distinct()
    labels = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("type"), F.col("event_type"))
    return series.select("user_id", "event_type", K.series_id(F.lit("events_total"), labels).alias("id"))


@query(
    "key05_composite",
    "SELECT o_orderkey, o_custkey || '_placed_' || o_orderkey AS edge, o_orderstatus || '::' || o_custkey || '::' || o_orderkey AS path FROM orders",
)
def key05(t):
    return t.orders.select(
        "o_orderkey", K.composite("_placed_", F.col("o_custkey"), F.col("o_orderkey")).alias("edge"),
        K.composite("::", F.col("o_orderstatus"), F.col("o_custkey"), F.col("o_orderkey")).alias("path"),
    )


@query(
    "key06_search_id",
    """SELECT p_partkey, replace(lower(p_name), ' ', '_') || '_' || 'today_12-m' || '_' ||
    substring(md5('[''' || least(p_type, p_brand) || ''', ''' || greatest(p_type, p_brand) || ''']_today 12-m'), 1, 8) AS id FROM part""",
)
def key06(t):
    return t.part.select("p_partkey", K.search_id(F.col("p_name"), F.array("p_type", "p_brand"), F.lit("today 12-m")).alias("id"))


@query(
    "key07_content_id",
    """SELECT c_custkey, sha256('{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"guid":null}') AS id FROM customer""",
)
def key07(t):
    rows = t.customer.withColumn("guid", F.lit(None).cast("string"))
    return rows.select("c_custkey", K.content_key(F.col("c_name"), F.col("c_nationkey"), F.col("guid")).alias("id"))
