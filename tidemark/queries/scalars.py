"""Type coercion and date queries."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemark.functions import coercion as C, dates as D
from tidemark.operators import quality as Q, schema as S
from tidemark.queries.registry import query


def messy_number():
    """Event fields as the kinds of text a lenient number column meets."""
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .when(kind == "view", F.col("value").cast("decimal(18,2)").cast("string"))
        .when(kind == "error", F.lit("n/a"))
        .otherwise(F.concat(F.lit("-"), F.col("event_id").cast("string")))
    )


MESSY_SQL = """CASE event_type WHEN 'click' THEN ' ' || user_id || ' ' WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
 WHEN 'error' THEN 'n/a' ELSE '-' || event_id END"""


@query(
    "typ01_lenient_numbers",
    f"""WITH t AS (SELECT event_id, value, {MESSY_SQL} AS txt FROM events)
    SELECT event_id, CASE WHEN regexp_full_match(txt, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim(txt) AS BIGINT) END AS int_value,
      CASE WHEN regexp_full_match(txt, '\\s*[+-]?[0-9]+(\\.[0-9]*)?\\s*') THEN TRY_CAST(trim(txt) AS DOUBLE) END AS float_value,
      CAST(trunc(value) AS BIGINT) AS truncated_value FROM t""",
)
def typ01(t):
    rows = t.events.withColumn("txt", messy_number())
    return rows.select(
        "event_id", C.int_text(F.col("txt")).alias("int_value"), C.float_text(F.col("txt")).alias("float_value"),
        C.truncated_int(F.col("value")).alias("truncated_value"),
    )


@query(
    "typ02_strict_rows",
    f"""WITH t AS (SELECT event_id, {MESSY_SQL} AS int_column,
      CASE event_type WHEN 'purchase' THEN 'TRUE' WHEN 'error' THEN 'FALSE1' ELSE 'false' END AS bool_column,
      CASE WHEN value < 1 THEN ' ' ELSE event_type END AS string_column,
      CASE WHEN value > 200 THEN replace(props, '}}', '') ELSE props END AS json_column,
      CASE WHEN hour(ts) = 3 THEN strftime(ts, '%Y-%m-') || 'DD' ELSE strftime(ts, '%Y-%m-%d') END AS date_column,
      CASE WHEN hour(ts) = 5 THEN strftime(ts, '%Y-%m-%d %H:%M:') || 'TT' ELSE strftime(ts, '%Y-%m-%d %-H:%M:%S') END AS ts_column
      FROM events)
    SELECT event_id, CAST(CASE WHEN regexp_full_match(int_column, '\\s*[+-]?[0-9]+\\s*') THEN 0 ELSE 1 END
      + CASE WHEN lower(bool_column) IN ('true','false') THEN 0 ELSE 1 END + CASE WHEN trim(string_column) <> '' THEN 0 ELSE 1 END
      + CASE WHEN json_valid(json_column) THEN 0 ELSE 1 END
      + CASE WHEN regexp_full_match(date_column, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 0 ELSE 1 END
      + CASE WHEN regexp_full_match(ts_column, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}') THEN 0 ELSE 1 END AS INTEGER) AS broken_rules
    FROM t""",
)
def typ02(t):
    return Q.validate(strict_rows(t), STRICT_RULES).select("event_id", F.size("reasons").alias("broken_rules"))


STRICT_RULES = {
    "int_column": "int", "bool_column": "bool", "string_column": "string",
    "json_column": "json", "date_column": "date", "ts_column": "timestamp",
}


def strict_rows(t):
    """Events as all-text rows with the defects a strict loader must catch."""
    kind, hour = F.col("event_type"), F.hour("ts")
    return t.events.select(
        "event_id",
        messy_number().alias("int_column"),
        F.when(kind == "purchase", "TRUE").when(kind == "error", "FALSE1").otherwise("false").alias("bool_column"),
        F.when(F.col("value") < 1, " ").otherwise(kind).alias("string_column"),
        F.when(F.col("value") > 200, F.regexp_replace("props", r"\}", "")).otherwise(F.col("props")).alias("json_column"),
        F.when(hour == 3, F.concat(F.date_format("ts", "yyyy-MM-"), F.lit("DD")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date_column"),
        F.when(hour == 5, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:"), F.lit("TT")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd H:mm:ss")).alias("ts_column"),
    )


@query(
    "typ03_yes_no",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS flag FROM orders""",
)
def typ03(t):
    word = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", " FALSE ").otherwise("maybe")
    return t.orders.select("o_orderkey", C.yes_no(word).alias("flag"))


@query(
    "typ04_typed_or_raw",
    f"""WITH t AS (SELECT event_id, ts, event_type, {MESSY_SQL} AS txt FROM events)
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE trim(txt) END AS number_cell,
      CASE WHEN event_type = 'error' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS date_cell,
      CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS check_cell FROM t""",
)
def typ04(t):
    kind = F.col("event_type")
    day = F.when(kind == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    box = F.when(kind == "click", "x").otherwise("")
    return t.events.select(
        "event_id", C.typed_or_raw(messy_number(), "NUMBER").alias("number_cell"),
        C.typed_or_raw(day, "DATE").alias("date_cell"), C.typed_or_raw(box, "CHECKBOX").alias("check_cell"),
    )


@query(
    "typ05_fixed_width_cells",
    """SELECT o_orderkey, CASE WHEN o_custkey = 0 OR o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS long_cell,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice * 100) / 100.0 END AS implied_cell,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_cell,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS text_cell FROM orders""",
)
def typ05(t):
    blank = F.col("o_orderstatus") == "P"
    cell = lambda c: F.when(blank, F.lit("          ")).otherwise(c)
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    return t.orders.select(
        "o_orderkey",
        C.fixed_field(cell(F.lpad(F.col("o_custkey").cast("string"), 9, "0")), "LONG").alias("long_cell"),
        C.fixed_field(cell(F.lpad(cents, 11, "0")), "FLOAT", 2).alias("implied_cell"),
        C.fixed_field(cell(F.date_format("o_orderdate", "MMddyyyy")), "NAIVE_DATE", None, "MMddyyyy").cast("string").alias("date_cell"),
        C.fixed_field(cell(F.rpad("o_orderpriority", 20, " ")), "STRING").alias("text_cell"),
    )


@query("typ06_sign_column", "SELECT c_custkey, c_acctbal AS balance FROM customer")
def typ06(t):
    sign = F.when(F.col("c_acctbal") < 0, "-").otherwise("+")
    return t.customer.select("c_custkey", C.signed(F.abs("c_acctbal"), sign).alias("balance"))


@query(
    "typ07_implied_cents",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN round(o_totalprice * 100) / 100.0 WHEN 'O' THEN -round(o_totalprice * 100) / 100.0 END AS amount
    FROM orders""",
)
def typ07(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", F.concat(F.lit("+"), cents)).when(status == "O", F.concat(F.lit("-"), cents)).otherwise("")
    return t.orders.select("o_orderkey", C.implied_cents(raw).alias("amount"))


@query(
    "typ08_binary_text",
    "SELECT doc_id, md5(base64(encode(text))) AS base64_md5, text AS round_trip FROM documents",
)
def typ08(t):
    raw = F.col("text").cast("binary")
    return t.documents.select("doc_id", F.md5(C.binary_as_base64(raw)).alias("base64_md5"), C.binary_as_text(raw).alias("round_trip"))


ORDER_TYPES = {
    "o_orderkey": ("bigint",),
    "o_totalprice": ("decimal", 12, 1),
    "o_orderdate": ("date",),
    "o_orderstatus": ("varchar",),
    "o_orderpriority": ("int",),
}


@query(
    "typ09_convert_table",
    """SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(12,1)) AS VARCHAR) AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders""",
)
def typ09(t):
    priced = t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    out = S.convert_table(priced, ORDER_TYPES)
    return out.withColumns({c: F.col(c).cast("string") for c in ("o_totalprice", "o_orderdate")})


@query(
    "typ09_conversion_losses",
    """SELECT 'o_orderkey' AS column_name, 'bigint' AS target_type, CAST(0 AS BIGINT) AS lost
    UNION ALL SELECT 'o_totalprice', 'decimal(12,1)', 0 UNION ALL SELECT 'o_orderdate', 'date', 0
    UNION ALL SELECT 'o_orderstatus', 'string', 0
    UNION ALL SELECT 'o_orderpriority', 'int', count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL) FROM orders""",
)
def typ09_losses(t):
    return S.conversion_losses(t.orders, ORDER_TYPES)


@query(
    "typ10_vector_text",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, round(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]), 4) AS total FROM embeddings""",
)
def typ10(t):
    text = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("decimal(20,12)").cast("string")), ", "), F.lit("]"))
    parsed = t.embeddings.select("vec_id", C.vector_text(text).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return parsed.select("vec_id", F.size("v").alias("n"), F.round(total, 4).alias("total"))


@query(
    "typ11_plain_text",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date_text FROM orders""",
)
def typ11(t):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.select(
        "o_orderkey", C.plain_text(price, T.DecimalType(18, 2)).alias("price_text"),
        C.plain_text(F.col("o_orderdate"), T.TimestampType()).alias("date_text"),
    )


@query("typ12_nan_to_null", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def typ12(t):
    holey = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", C.nan_to_null(holey).alias("value"))


@query(
    "dt01_iso_to_utc",
    """SELECT event_id, strftime(CASE event_type WHEN 'view' THEN ts - INTERVAL 330 MINUTE WHEN 'error' THEN NULL ELSE ts END, '%Y-%m-%dT%H:%M:%SZ') AS utc_text
    FROM events""",
)
def dt01(t):
    kind, base = F.col("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == "click", F.concat(base, F.lit("Z")))
        .when(kind == "view", F.concat(base, F.lit("+05:30")))
        .when(kind == "error", F.lit("not a time"))
        .otherwise(base)
    )
    return t.events.select("event_id", D.iso_text(D.iso_to_utc(text)).alias("utc_text"))


@query(
    "dt02_local_to_utc",
    """SELECT o_orderkey, strftime(CASE o_orderstatus WHEN 'F' THEN CAST(timezone('America/New_York', o_orderdate) AT TIME ZONE 'UTC' AS TIMESTAMP)
      WHEN 'O' THEN CAST(timezone('Europe/Paris', o_orderdate) AT TIME ZONE 'UTC' AS TIMESTAMP) ELSE o_orderdate END, '%Y-%m-%dT%H:%M:%SZ') AS utc_text FROM orders""",
)
def dt02(t):
    zone = F.when(F.col("o_orderstatus") == "F", "America/New_York").when(F.col("o_orderstatus") == "O", "Europe/Paris").otherwise("Nowhere/Here")
    rows = t.orders.withColumn("zone", zone)
    return rows.select("o_orderkey", D.iso_text(D.local_to_utc(F.col("o_orderdate"), F.col("zone"))).alias("utc_text"))


@query(
    "dt03_epoch",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, epoch_us(ts) // 1000 AS epoch_ms, epoch_us(ts) AS epoch_us,
    strftime(CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-01-01' ELSE date_trunc('millisecond', ts) END, '%Y-%m-%d %H:%M:%S.%f') AS back_text FROM events""",
)
def dt03(t):
    ms = F.when(F.col("event_type") != "error", D.to_epoch(F.col("ts"), "ms"))
    back = D.from_epoch(ms, "ms", F.lit("2024-01-01").cast("timestamp"))
    return t.events.select(
        "event_id", *[D.to_epoch(F.col("ts"), u).alias(f"epoch_{u}") for u in ("s", "ms", "us")],
        F.date_format(back, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("back_text"),
    )


@query(
    "dt04_vendor_formats",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'never' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS vendor_text,
    strftime(ts, '%Y-%m-%d') AS short_date, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS either_text FROM events""",
)
def dt04(t):
    kind = F.col("event_type")
    vendor = F.when(kind == "error", "never").otherwise(F.date_format("ts", "dd MMM yyyy hh:mm:ss a"))
    either = F.when(kind == "click", F.unix_seconds("ts").cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.events.select(
        "event_id", D.vendor_iso(vendor).alias("vendor_text"),
        D.yymmdd(F.date_format("ts", "yyMMdd")).cast("string").alias("short_date"),
        D.iso_text(D.iso_or_epoch(either)).alias("either_text"),
    )


@query(
    "dt05_truncate",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS to_second, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS to_hour,
    strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS to_day FROM events""",
)
def dt05(t):
    text = lambda unit, fmt="yyyy-MM-dd HH:mm:ss": F.date_format(D.floor_to(F.col("ts"), unit), fmt)
    return t.events.select(
        "event_id", text("second", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("to_second"), text("hour").alias("to_hour"), text("day").alias("to_day")
    )


@query(
    "dt06_duration",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 END AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def dt06(t):
    start = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", D.seconds_between(start, F.col("l_shipdate")).alias("seconds"))


@query(
    "dt07_older_than",
    "SELECT event_id, ts < TIMESTAMP '2024-02-15' - INTERVAL 30 DAY AS is_old FROM events",
)
def dt07(t):
    return t.events.select("event_id", D.older_than(F.col("ts"), F.lit("2024-02-15").cast("timestamp"), 30).alias("is_old"))
