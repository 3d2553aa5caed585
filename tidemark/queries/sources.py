"""Source queries. File formats are first written from the given tables, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import iso_text
from tidemark.operators.ordering import keep_one, tasks_for
from tidemark.queries.registry import query
from tidemark.session import work_path
from tidemark.sources import archive, bai2, delimited, discovery, fixed_width, graph, lines, nested, series, tables
from tidemark.operators import changes

ts = lambda text: F.lit(text).cast("timestamp")


@query("src01_full_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def src01(t):
    return t.orders


@query(
    "src02_chunk_bounds",
    """WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders), b AS (SELECT chunk, max(o_orderkey) AS high, count(*) AS row_count FROM r GROUP BY chunk)
    SELECT CAST(chunk AS BIGINT) AS chunk, lag(high) OVER (ORDER BY chunk) AS low, CASE WHEN chunk < max(chunk) OVER () THEN high END AS high, row_count FROM b""",
)
def src02(t):
    return tables.chunk_bounds(t.orders, "o_orderkey", 1000).withColumn("chunk", F.col("chunk").cast("long"))


@query(
    "src02_tied_chunks",
    """WITH c AS (SELECT o_orderdate AS k, count(*) AS n FROM orders GROUP BY o_orderdate), r AS (SELECT k, n, sum(n) OVER (ORDER BY k) - n AS before FROM c),
    b AS (SELECT CAST(before // 5000 AS BIGINT) AS chunk, max(k) AS high, CAST(sum(n) AS BIGINT) AS row_count FROM r GROUP BY 1)
    SELECT b.chunk, p.high AS low, CASE WHEN b.high < (SELECT max(o_orderdate) FROM orders) THEN b.high END AS high, b.row_count FROM b LEFT JOIN b p ON p.chunk + 1 = b.chunk""",
)
def src02_ties(t):
    return tables.chunk_bounds(t.orders, "o_orderdate", 5000).withColumn("chunk", F.col("chunk").cast("long"))


@query(
    "src03_keyset_page",
    """SELECT o_orderdate, o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1996-05-05', 120) ORDER BY o_orderdate, o_orderkey LIMIT 1000""",
)
def src03(t):
    return tables.keyset_page(t.orders, "o_orderdate", "o_orderkey", (ts("1996-05-05"), 120), 1000).select("o_orderdate", "o_orderkey")


@query(
    "src03_null_pass",
    "SELECT event_id FROM events WHERE event_type = 'error'",
)
def src03_nulls(t):
    rows = t.events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    return tables.null_page(rows, "ts").select("event_id")


@query(
    "src02_quantile_bounds",
    """WITH c AS (SELECT quantile_disc(o_orderkey, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS q FROM orders)
    SELECT CAST(i AS INTEGER) AS chunk, CASE WHEN i > 0 THEN q[i] END AS low, CASE WHEN i < 7 THEN q[i + 1] END AS high FROM c, generate_series(0, 7) AS s(i)""",
)
def src02_quantiles(t):
    return tables.quantile_bounds(t.orders, "o_orderkey", 8)


def exported(t):
    """Lines exported to one folder per return flag, and the export log."""
    path = work_path(t.spark, "export")
    t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("part")).write.partitionBy("part").parquet(path)
    log = t.lineitem.groupBy(F.col("l_returnflag").alias("file")).agg(F.count(F.lit(1)).alias("line_count"))
    return tables.exported_parquet(t.spark, path, "l_orderkey long, l_linenumber int, part string"), log


@query(
    "src04_export_reconciled",
    """SELECT l_returnflag AS file, count(*) AS line_count, count(*) AS loaded, TRUE AS matches FROM lineitem GROUP BY l_returnflag""",
)
def src04(t):
    loaded, log = exported(t)
    return tables.reconcile_export(loaded, log, F.col("part"))


@query(
    "src04_missing_part",
    """SELECT l_returnflag AS file, count(*) AS line_count, CAST(sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS loaded, l_returnflag <> 'N' AS matches FROM lineitem GROUP BY l_returnflag""",
)
def src04_missing(t):
    """One exported folder was not loaded: the log shows it."""
    loaded, log = exported(t)
    return tables.reconcile_export(loaded.filter(F.col("part") != "N"), log, F.col("part"))


@query(
    "src05_header_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || CASE WHEN c_nationkey = 5 THEN '; "x", y' ELSE '' END AS name, c_mktsegment AS segment FROM customer""",
)
def src05(t):
    path = work_path(t.spark, "csv")
    quoted = F.when(F.col("c_nationkey") == 5, F.concat("c_name", F.lit('; "x", y'))).otherwise(F.col("c_name"))
    out = t.customer.select(F.col("c_custkey").alias("id"), quoted.alias("name"), F.col("c_mktsegment").alias("segment"))
    out.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    separator = delimited.sniff(t.spark, path)
    rows = t.spark.read.csv(path, sep=separator, header=True, inferSchema=False, escape='"')
    return rows


@query(
    "src05_sniffed_delimiter",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand FROM part",
)
def src05_sniff(t):
    path = work_path(t.spark, "psv")
    out = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    out.write.option("header", True).option("sep", "|").csv(path)
    return delimited.read_with_header(t.spark, path)


@query(
    "src06_layout_tsv",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier""",
)
def src06(t):
    """Suppliers in debt have short rows without the last column."""
    path = work_path(t.spark, "tsv")
    tail = F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("\t"), F.col("s_nationkey").cast("string"))).otherwise("")
    t.supplier.select(F.concat(F.col("s_suppkey").cast("string"), F.lit("\t"), F.col("s_name"), tail)).write.text(path)
    return delimited.read_layout(t.spark, path, ["id", "name", "nation"])


@query(
    "src07_gz_members",
    "SELECT p_partkey, p_name, 'parts_eu' AS table_name FROM part WHERE p_type = 'SMALL' UNION ALL SELECT p_partkey, p_name, 'parts_us' FROM part WHERE p_type <> 'SMALL'",
)
def src07(t):
    base = work_path(t.spark, "gz")
    small = F.col("p_type") == "SMALL"
    for name, test in (("0a-1b_Parts_EU", small), ("0a-2c_Parts_US", ~small)):
        t.part.filter(test).select("p_partkey", "p_name").write.option("header", True).option("compression", "gzip").csv(f"{base}/{name}.csv.gz")
    rows = t.spark.read.option("recursiveFileLookup", "true").schema("p_partkey long, p_name string").csv(base, header=True)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    from tidemark.functions.text import table_name_of

    return rows.select("p_partkey", "p_name", table_name_of(folder).alias("table_name"))


def write_zips(rows, folder: str, name) -> None:
    """A zip in `folder` for each `archive` of `rows` (archive, line, others); `name` gives the member and its header from a
    row. Tasks write the zips themselves."""
    import io
    import zipfile

    import pandas as pd

    def bundle(frame: pd.DataFrame) -> pd.DataFrame:
        member, header = name(frame.iloc[0])
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
            out.writestr(member, header + "\n" + "".join(frame["line"] + "\n"))
            out.writestr("extra/", "")
            out.writestr("extra/Notes.csv", "id\nignored\n")
        files, root = archive.file_system(folder)
        files.create_dir(root)
        # a task that is run again writes the same file
        with files.open_output_stream(f"{root}/{frame['archive'].iloc[0]}.zip") as stream:
            stream.write(buffer.getvalue())
        return frame[["archive"]].head(1)

    rows.groupBy("archive").applyInPandas(bundle, "archive string").write.format("noop").mode("overwrite").save()


@query(
    "src07_zip_members",
    "SELECT s_suppkey, s_name, CAST(n_nationkey AS INTEGER) AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def src07_zip(t):
    """Zips of one nation and at most 10,000 supplier keys; every second nation's members have their columns in another
    order, and names have a line break."""
    turned, key = F.col("s_nationkey") % 2 == 1, F.col("s_suppkey").cast("string")
    name = F.concat(F.lit('"'), "s_name", F.lit('\n!"'))
    rows = t.supplier.select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("_"), F.floor(F.col("s_suppkey") / 10_000).cast("string")).alias("archive"),
        F.concat_ws(",", F.when(turned, name).otherwise(key), F.when(turned, key).otherwise(name), F.col("s_nationkey").cast("string")).alias("line"),
        turned.alias("turned"),
    )
    path = work_path(t.spark, "zips")
    write_zips(rows, path, lambda row: ("0f-9_Suppliers.csv", "name,id,nation" if row["turned"] else "id,name,nation"))
    out = archive.named_members(archive.zip_records(t.spark, path), "suppliers", {"s_suppkey": ("id", "long"), "s_name": ("name", "string"), "nation": ("nation", "int")})
    return out.select("s_suppkey", F.regexp_replace("s_name", "\n!$", "").alias("s_name"), "nation")


@query(
    "src07_zip_archives",
    """SELECT 'lines_' || (l_orderkey // 8000) || '.zip' AS archive, l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, min(l_quantity) AS low, max(l_extendedprice) AS high
    FROM lineitem GROUP BY 1, 2""",
)
def src07_archives(t):
    """A zip for each 8,000 orders, whose lines are one member that is longer than a batch."""
    rows = t.lineitem.select(
        F.concat(F.lit("lines_"), F.floor(F.col("l_orderkey") / 8000).cast("string")).alias("archive"),
        F.concat_ws(",", "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag").alias("line"),
    )
    path = work_path(t.spark, "zips")
    write_zips(rows, path, lambda row: ("Line Items.csv", "order,quantity,price,flag"))
    columns = {"o": ("order", "long"), "q": ("quantity", "double"), "p": ("price", "double"), "l_returnflag": ("flag", "string")}
    found = archive.named_members(archive.zip_records(t.spark, path), "line_items", columns)
    return found.groupBy("archive", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o").alias("key_sum"), F.min("q").alias("low"), F.max("p").alias("high")
    )


CARD_FIELDS = [
    fixed_width.FixedField("uid", 1, 12, "LONG"),
    fixed_width.FixedField("name", 13, 22),
    fixed_width.FixedField("balance", 35, 11, "FLOAT", 2),
    fixed_width.FixedField("sign", 46, 1),
    fixed_width.FixedField("opened", 47, 8, "NAIVE_DATE"),
]


@query(
    "src08_fixed_width",
    """SELECT 'é' || c_custkey AS tag, CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey END AS uid, c_name AS name, c_acctbal AS balance,
    CASE WHEN c_nationkey = 2 THEN NULL ELSE '1999-12-31' END AS opened FROM customer""",
)
def src08(t):
    """Customers rendered as signed fixed-width records per nation file and parsed back."""
    from tidemark.functions.coercion import signed

    path = work_path(t.spark, "fixed")
    cents = F.round(F.abs("c_acctbal") * 100).cast("long").cast("string")
    record = F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0"), F.rpad("c_name", 22, " "), F.lpad(cents, 11, "0"),
        F.when(F.col("c_acctbal") < 0, "-").otherwise("+"), F.when(F.col("c_nationkey") == 2, "00000000").otherwise("19991231"),
    )
    # Latin bytes are written as they are, so the reader's decoding is part of the check.
    rows = t.customer.select("c_nationkey", F.concat(record, F.lit("é"), F.col("c_custkey").cast("string")).alias("value"))
    rows.write.partitionBy("c_nationkey").text(path)
    read = lines.read_lines(t.spark, path)
    fields = [*CARD_FIELDS, fixed_width.FixedField("tag", 55, 20)]
    out = fixed_width.parse(read, fields, header_trailer=False).filter(~F.col("malformed"))
    return out.select("tag", "uid", "name", signed(F.col("balance"), F.col("sign")).alias("balance"), F.col("opened").cast("string").alias("opened"))


@query(
    "src08_header_trailer",
    "SELECT c_custkey AS uid, c_name AS name FROM customer",
)
def src08_ends(t):
    """Header and trailer lines dropped per file, by position and not by content."""
    from tidemark.queries.quality import nation_lines

    fields = [fixed_width.FixedField("uid", 1, 10, "STRING"), fixed_width.FixedField("name", 11, 20)]
    out = fixed_width.parse(nation_lines(t), fields)
    return out.select(F.col("uid").cast("long").alias("uid"), "name")


def bank_lines(t):
    """Orders as a cash report: a file per nation, a group per segment, an account per customer."""
    s = F.lit
    text = lambda c: F.col(c).cast("string")
    cents = lambda c: F.round(F.abs(c) * 100).cast("long").cast("string")
    customers = t.customer.select(
        F.concat(s("bank_"), text("c_nationkey"), s(".bai")).alias("file"), F.col("c_mktsegment").alias("segment"), "c_custkey", "c_acctbal", "c_name"
    )
    line = lambda level, item, sub, content: F.struct(
        s(level).alias("level"), item.cast("long").alias("item"), s(sub).alias("sub"), content.alias("line")
    )
    spread = lambda df, acct, *lines: df.select("file", "segment", acct.cast("long").alias("acct"), F.inline(F.array(*lines)))
    zero, none, acct = s(0), s(-1), F.col("c_custkey")
    files = customers.select("file", s("").alias("segment")).distinct()
    groups = customers.select("file", "segment").distinct()
    funds = F.when(F.col("o_orderstatus") == "F", F.concat(s("S,"), text("o_custkey"), s(",,000"))).when(F.col("o_orderstatus") == "O", s("V,240101,1200")).otherwise(s("0"))
    detail = F.concat(
        s("16,"), F.when(F.col("o_orderpriority") == "1-URGENT", "475").otherwise("142"), s(","), cents(F.col("o_totalprice")), s(","), funds,
        s(",B"), text("o_orderkey"), s(",,PAY"), s("/"),
    )
    key = F.col("o_orderkey")
    return (
        spread(files, none, line(0, zero, 0, F.concat(s("01,SENDER,RECEIVER,240115,0930/"), s("   "))))
        .unionByName(spread(groups, none, line(1, zero, 0, F.concat(s("02,ULT,"), "segment", s(",1,240114,2359,USD,2/")))))
        .unionByName(
            spread(
                customers, acct,
                line(2, zero, 0, F.concat(s("03,"), text("c_custkey"), s(",,010,"), cents(F.col("c_acctbal")), s(",,,/"))),
                line(2, zero, 1, F.concat(s("88,015,+"), text("c_custkey"), s(",,,045,000,,/"))),
                line(4, zero, 0, s("49,0,0/")),
            )
        )
        .unionByName(
            spread(
                t.orders.join(customers, F.col("o_custkey") == acct), acct,
                line(3, key, 0, detail),
                line(3, key, 1, F.concat(s("88,Cust ID: "), text("o_custkey"), s(" Desc: "), F.col("o_orderpriority"))),
                line(3, key, 2, F.concat(s("88,SEC: CCD Cust Name: "), F.col("c_name"))),
            )
        )
    )


BANK_SQL = """SELECT 'bank_' || c_nationkey || '.bai' AS file, 'SENDER' AS sender_id, '2024-01-15' AS file_date, c_mktsegment AS originator_id, '2024-01-14' AS as_of_date,
    CAST(c_custkey AS VARCHAR) AS bank_account_number, 'USD' AS currency, CASE WHEN o_orderpriority = '1-URGENT' THEN '475' ELSE '142' END AS type_code,
    round(o_totalprice * 100) / 100.0 AS amount, CASE WHEN o_orderpriority = '1-URGENT' THEN 'D' ELSE 'C' END AS debit_credit_mark,
    CASE o_orderstatus WHEN 'F' THEN 'S' WHEN 'O' THEN 'V' ELSE '0' END AS funds_type, CASE WHEN o_orderstatus = 'F' THEN o_custkey / 100.0 END AS same_day_amount,
    CASE WHEN o_orderstatus = 'F' THEN 0.0 :: DOUBLE END AS two_plus_day_amount, 'B' || o_orderkey AS bank_reference, CAST(o_custkey AS VARCHAR) AS ach_cust_id, o_orderpriority AS ach_description,
    'CCD' AS ach_sec_code, c_name AS ach_cust_name, 'PAY Cust ID: ' || o_custkey || ' Desc: ' || o_orderpriority || ' SEC: CCD Cust Name: ' || c_name AS description,
    round(abs(c_acctbal) * 100) / 100.0 AS balance_010, c_custkey / 100.0 AS balance_015, 0.0 :: DOUBLE AS balance_045 FROM orders JOIN customer ON o_custkey = c_custkey"""
BANK_COLUMNS = [
    "file", "sender_id", "file_date", "originator_id", "as_of_date", "bank_account_number", "currency", "type_code", "amount", "debit_credit_mark", "funds_type",
    "same_day_amount", "two_plus_day_amount", "bank_reference", "ach_cust_id", "ach_description", "ach_sec_code", "ach_cust_name", "description",
    "balance_010", "balance_015", "balance_045",
]


@query("src09_bai2_transactions", BANK_SQL)
def src09(t):
    """The line order is (segment, account, level, item, sub); the account range is the block."""
    block = F.struct("segment", F.floor(F.col("acct") / 1000).alias("range"))
    place = F.struct("acct", "level", "item", "sub")
    rows = bank_lines(t).select("file", block.alias("block"), place.alias("seq"), "line")
    path = work_path(t.spark, "bank")
    rows.write.parquet(path)
    landed = t.spark.read.schema(rows.schema).parquet(path)
    out = bai2.wide_balances(bai2.transactions(landed), ["010", "015", "045"])
    return out.withColumns({c: F.col(c).cast("string") for c in ("file_date", "as_of_date")}).select(*BANK_COLUMNS)


@query("src09_bai2_files", BANK_SQL)
def src09_files(t):
    """The same report through real text files, split and read back by file block."""
    path = work_path(t.spark, "bai")
    order = ["file", "segment", "acct", "level", "item", "sub"]
    # Range partitions cut a large report into consecutive part files, whose names keep the order.
    rows = bank_lines(t)
    rows = rows.repartitionByRange(tasks_for(rows), *order).sortWithinPartitions(*order)
    rows.select("file", "line").write.partitionBy("file").text(path)
    split = F.struct(F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("start"))
    read = t.spark.read.text(path).select(
        "file", split.alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line")
    )
    out = bai2.wide_balances(bai2.transactions(read), ["010", "015", "045"])
    return out.withColumns({c: F.col(c).cast("string") for c in ("file_date", "as_of_date")}).select(*BANK_COLUMNS)


@query(
    "src10_json_documents",
    "SELECT event_id AS id, event_type AS kind, value FROM events UNION ALL SELECT event_id, event_type, value FROM events WHERE event_id % 500 = 0",
)
def src10_documents(t):
    """Landed pages of up to 500 records, printed over many lines; a page of one record holds it without a list."""
    path = work_path(t.spark, "pages")
    item = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), "value")
    rows = t.events.select(F.floor(F.col("event_id") / 500).alias("page"), (F.col("event_id") % 500 == 0).alias("first"), item.alias("item"))
    lists = rows.groupBy("page").agg(F.collect_list("item").alias("data"))
    printed = lambda data: F.to_json(F.struct(F.lit("ok").alias("status"), F.col(data).alias("data")), {"pretty": "true"}).alias("value")
    pages = lists.select(printed("data")).unionAll(rows.where("first").select(printed("item")))
    pages.write.option("maxRecordsPerFile", 1).text(path)
    return nested.read_json_documents(t.spark, path, "data", "id:bigint, kind:string, value:double").drop("page")


@query(
    "src10_json_envelopes",
    """SELECT event_id AS page, CAST(json_extract_string(props, '$.k') AS INTEGER) AS id, event_type AS kind FROM events UNION ALL SELECT event_id, -1, 'pad' FROM events WHERE event_type = 'view'""",
)
def src10(t):
    """Envelopes with a list of records, or with one object where the event is no view."""
    k = F.get_json_object("props", "$.k")
    one = F.concat(F.lit('{"id":'), k, F.lit(',"kind":"'), "event_type", F.lit('"}'))
    listed = F.concat(F.lit("["), one, F.lit(',{"id":-1,"kind":"pad"}]'))
    body = F.concat(F.lit('{"total":1,"results":'), F.when(F.col("event_type") == "view", listed).otherwise(one), F.lit("}"))
    pages = t.events.select(F.col("event_id").alias("page"), body.alias("body"))
    return nested.envelope_rows(pages, "body", "results", "id: int, kind: string")


@query(
    "src10_json_page_files",
    "SELECT s_suppkey AS id, s_name AS name FROM supplier",
)
def src10_files(t):
    path = work_path(t.spark, "json")
    t.supplier.select(F.array(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).alias("data")).write.json(path)
    pages = t.spark.read.schema("data array<struct<id: long, name: string>>").json(path)
    return pages.select(F.explode("data").alias("_item")).select("_item.*")


@query(
    "src11_xml_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS comment FROM customer""",
)
def src11(t):
    """Two levels: a root element per customer with one child row; debtors have an empty leaf."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    comment = F.when(F.col("c_acctbal") < 0, F.lit("<comment/>")).otherwise(tag("comment", F.col("c_mktsegment")))
    body = F.concat(F.lit("<blasts><blast>"), tag("id", F.col("c_custkey").cast("string")), tag("name", F.col("c_name")), comment, F.lit("</blast></blasts>"))
    return nested.xml_rows(t.customer.select(body.alias("body")), "body", "blast array<struct<id: string, name: string, comment: string>>", "blast")


@query(
    "src11_xml_files",
    "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CASE WHEN s_nationkey < 5 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier",
)
def src11_files(t):
    path = work_path(t.spark, "xml")
    nation = F.when(F.col("s_nationkey") >= 5, F.col("s_nationkey").cast("string")).otherwise("")
    rows = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), nation.alias("nation"))
    rows.write.format("xml").option("rootTag", "suppliers").option("rowTag", "supplier").save(path)
    return nested.read_xml_rows(t.spark, path, "supplier", "key string, name string, nation string")


@query(
    "src12_row_arrays",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS \"user\", event_type AS kind, CAST(NULL AS VARCHAR) AS absent FROM events",
)
def src12(t):
    cells = F.array(F.col("user_id").cast("string"), F.col("event_type"), F.lit("beyond the names"))
    pages = t.events.select("event_id", F.array(F.lit("user"), F.lit("kind")).alias("columns"), F.array(cells).alias("dataset"))
    return nested.row_array_records(pages, "columns", "dataset", ["user", "kind", "absent"])


@query(
    "src13_parallel_arrays",
    """SELECT event_id, CAST(i AS INTEGER) AS position, ts + i * INTERVAL 1 HOUR AS point_time, CASE WHEN i < 2 THEN value + i END AS v1, CASE WHEN event_type <> 'error' THEN user_id + i END AS v2
    FROM events, (VALUES (0), (1), (2)) AS s(i)""",
)
def src13(t):
    """Three times per event; v1 is one value short and v2 is missing for errors."""
    hour = lambda i: F.col("ts") + F.expr(f"INTERVAL {i} HOURS")
    page = t.events.select(
        "event_id", F.array(hour(0), hour(1), hour(2)).alias("time"), F.array(F.col("value"), F.col("value") + 1).alias("v1"),
        F.when(F.col("event_type") != "error", F.array(*[F.col("user_id") + i for i in range(3)])).alias("v2"),
    )
    return series.parallel_arrays(page, ["event_id"], "time", ["v1", "v2"])


@query(
    "src14_range_vector",
    """SELECT md5('value{event=' || event_id || ',type=' || event_type || '}') AS series_id, event_id, ts AS point_time, CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value FROM events""",
)
def src14(t):
    labels = F.create_map(F.lit("type"), F.col("event_type"), F.lit("event"), F.col("event_id").cast("string"))
    text = F.when(F.col("event_type") == "error", "NaN").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    point = F.struct((F.unix_micros("ts") / F.lit(1_000_000)).cast("decimal(20,6)").alias("ts"), text.alias("value"))
    matrix = t.events.select(F.lit("value").alias("name"), labels.alias("labels"), F.array(point).alias("values"))
    rows = series.range_vector(matrix)
    return rows.select("series_id", F.col("labels")["event"].cast("long").alias("event_id"), "point_time", "value")


@query(
    "src15_typed_values",
    """SELECT event_id, CASE event_type WHEN 'click' THEN props WHEN 'view' THEN '{"k":"' || json_extract_string(props, '$.k') || '"}' WHEN 'purchase' THEN '["a","' || user_id || '"]'
      WHEN 'signup' THEN '[["m",1.5]]' ELSE 'Unsupported type: stream' END AS value,
    CAST(CASE event_type WHEN 'click' THEN length(props) WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END AS INTEGER) AS size FROM events""",
)
def src15(t):
    kind = F.col("event_type")
    stored = F.when(kind == "click", "string").when(kind == "view", "hash").when(kind == "purchase", "list").when(kind == "signup", "zset").otherwise("stream")
    payload = (
        F.when(kind.isin("click", "view"), F.col("props"))
        .when(kind == "purchase", F.concat(F.lit('["a","'), F.col("user_id").cast("string"), F.lit('"]')))
        .otherwise('[["m",1.5]]')
    )
    rows = t.events.select("event_id", stored.alias("stored"), payload.alias("payload"))
    value, size = nested.typed_value(F.col("stored"), F.col("payload"))
    return rows.select("event_id", value.alias("value"), size.alias("size"))


@query(
    "src16_wide_cells",
    "SELECT c_custkey, c_name AS name, c_nationkey AS nation, CAST(NULL AS DOUBLE) AS balance FROM customer",
)
def src16(t):
    cell = lambda c: F.encode(F.col(c).cast("string"), "UTF-8")
    cells = F.create_map(F.lit("cf:name"), cell("c_name"), F.lit("cf:nation"), cell("c_nationkey"), F.lit("cf:balance"), F.encode(F.lit("n/a"), "UTF-8"))
    return nested.wide_cells(t.customer.select("c_custkey", cells.alias("cells")), "c_custkey", "cells", "cf", {"name": "string", "nation": "int", "balance": "double"})


@query(
    "src17_tagged_attributes",
    """SELECT event_id, CASE event_type WHEN 'click' THEN event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'purchase' THEN 'true' ELSE '["' || event_type || '"]' END AS item FROM events""",
)
def src17(t):
    kind = F.col("event_type")
    tagged = (
        F.when(kind == "click", F.concat(F.lit('{"S":"'), kind, F.lit('"}')))
        .when(kind == "view", F.concat(F.lit('{"N":"'), F.col("user_id").cast("string"), F.lit('"}')))
        .when(kind == "purchase", F.lit('{"BOOL":true}'))
        .otherwise(F.concat(F.lit('{"L":["'), kind, F.lit('"]}')))
    )
    parsed = F.from_json(tagged, "S string, N string, BOOL boolean, L array<string>")
    return t.events.select("event_id", nested.untag(parsed).alias("item"))


@query(
    "src18_documents",
    "SELECT 'orders/' || o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total, 'Orders' AS collection FROM orders",
)
def src18(t):
    path = work_path(t.spark, "documents")
    meta = F.struct(F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("@id"), F.lit("Orders").alias("@collection"))
    t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"), meta.alias("@metadata")).write.json(path)
    landed = t.spark.read.schema("status string, total double, `@metadata` struct<`@id`: string, `@collection`: string>").json(path)
    named = landed.select("status", "total", F.col("`@metadata`.`@collection`").alias("collection"), F.struct(F.col("`@metadata`.`@id`").alias("id")).alias("meta"))
    return nested.promote_document_id(named, "meta.id")


@query(
    "src19_graph_export",
    """SELECT 'customer:' || c_custkey AS id, c_name AS name, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS extra_rows FROM customer""",
)
def src19(t):
    """Vertices with multi-valued properties: debtors carry a second tag."""
    tags = F.when(F.col("c_acctbal") < 0, F.array("c_mktsegment", F.lit("debtor"))).otherwise(F.array("c_mktsegment"))
    props = F.create_map(F.lit("name"), F.array("c_name"), F.lit("tag"), tags)
    raw = t.customer.select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("id"), props.alias("props"))
    vertices, extra = graph.split_properties(raw, "id", "props", ["name", "tag"])
    second = extra.filter(F.col("position") == 1).select("id", F.lit(1).alias("extra_rows"))
    return vertices.join(second, "id", "left").select("id", "name", F.coalesce("extra_rows", F.lit(0)).alias("extra_rows"))


@query(
    "src19_edges",
    """SELECT 'customer:' || o_custkey || '_placed_order:' || o_orderkey AS edge_id, 'placed' AS edge_label, 'customer:' || o_custkey AS src_id, 'order:' || o_orderkey AS dst_id FROM orders""",
)
def src19_edges(t):
    return graph.edges(t.orders, "placed", ("customer", "o_custkey"), ("order", "o_orderkey"))


@query(
    "src20_change_log_scan",
    "SELECT event_id AS commit_seq, user_id AS intent_seq, event_type AS op FROM events WHERE (event_id, user_id) > (4000, 10)",
)
def src20(t):
    log = t.events.select(F.col("event_id").alias("commit_seq"), F.col("user_id").alias("intent_seq"), F.col("event_type").alias("op"))
    return changes.after_position(log, "commit_seq", "intent_seq", 4000, 10)


@query(
    "src21_change_feed_range",
    """SELECT 'next' AS run, event_id FROM events WHERE event_id // 100 > 10 AND event_id // 100 <= 50 UNION ALL SELECT 'first', event_id FROM events WHERE event_id // 100 <= 50""",
)
def src21(t):
    feed = t.events.select("event_id", F.floor(F.col("event_id") / 100).alias("_commit_version"))
    part = lambda name, last: changes.feed_rows(feed, last, 50).select(F.lit(name).alias("run"), "event_id")
    return part("next", 10).unionByName(part("first", None))


@query(
    "src22_unseen_files",
    "SELECT n_nationkey AS nation, count(*) AS rows FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 1 GROUP BY n_nationkey",
)
def src22(t):
    """A folder per nation; the nations of one region were processed before, and their files are not opened."""
    path = work_path(t.spark, "landing")
    t.supplier.select(F.col("s_nationkey").alias("nation"), F.to_json(F.struct("s_suppkey", "s_name")).alias("value")).write.partitionBy("nation").text(path)
    nation = lambda c: F.regexp_extract(c, r"nation=(\d+)", 1)
    files = discovery.listing(t.spark, path, r"\.txt$").withColumn("name", nation(F.col("path")))
    processed = t.nation.filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").cast("string").alias("name"))
    reads = [t.spark.read.text(paths).select(nation(F.col("_metadata.file_path")).cast("int").alias("nation")) for paths in discovery.path_batches(discovery.unseen_files(files, processed))]
    rows = reduce(DataFrame.unionByName, reads) if reads else t.spark.createDataFrame([], "nation int")
    return rows.groupBy("nation").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "src23_query_options",
    """SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 10""",
)
def src23(t):
    options = {"select": ["c_custkey", "c_name"], "filter": ["c_acctbal > 0", "c_mktsegment = 'BUILDING'"], "orderby": ["c_acctbal desc", "c_custkey"], "top": 50, "skip": 10}
    return tables.query_options(t.customer, options)


@query(
    "src23_entity_counts",
    "SELECT 'customer' AS entity, count(*) AS count FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'orders', count(*) FROM orders",
)
def src23_counts(t):
    a = tables.query_options(t.customer, {"filter": "c_acctbal < 0", "count": True})
    b = tables.query_options(t.orders, {"count": True})
    return a.select(F.lit("customer").alias("entity"), "count").unionByName(b.select(F.lit("orders").alias("entity"), "count"))
