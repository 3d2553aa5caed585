"""Table scans behind one seam: Parquet folders here, JDBC when a URL is given."""

from __future__ import annotations

import datetime
import decimal
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.ordering import block_offsets, range_blocks, running_in_blocks

# Declared layouts, so no scan infers its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}


class Tables:
    """The tables of one folder as attributes: `Tables(spark, folder).orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, predicates: list[str] | None = None) -> DataFrame:
    """A database table; with predicates, one partition and one connection per predicate."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def _ranked_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(key, _n, _upto): how many rows each key has, and all keys up to it; and the slices' offsets.

    Slices are counted on the rows themselves and keys only within their slice, so a repeated key is one row before it
    is put in order.
    """
    placed = range_blocks(df.filter(F.col(key).isNotNull()).select(key), [key])
    offsets = block_offsets(placed, F.lit(1).cast("bigint"))
    counted = placed.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"))
    return running_in_blocks(counted, offsets, [key], F.col("_n"), "_upto"), offsets


def chunk_bounds(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Half-open key ranges `(low, high]` of about `rows` rows; ties stay together, the last is open."""
    ranked, _ = _ranked_keys(df, key)
    chunk = F.floor((F.col("_upto") - F.col("_n")) / F.lit(rows)).alias("chunk")
    ranges = ranked.groupBy(chunk).agg(F.max(key).alias("high"), F.sum("_n").alias("row_count"))
    before = ranges.select((F.col("chunk") + 1).alias("chunk"), F.col("high").alias("low"))
    joined = ranges.join(before, "chunk", "left")
    top = df.agg(F.max(key)).first()[0]
    return joined.select("chunk", "low", F.when(F.col("high") < F.lit(top), F.col("high")).alias("high"), "row_count")


def quantile_bounds(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """About equal key ranges, exact at any size: the bounds are the smallest keys up to which at least the share
    i / chunks of the rows lies. Repeated bounds of a hot key collapse into one."""
    ranked, offsets = _ranked_keys(df, key)
    total = F.lit(offsets.agg(F.coalesce(F.sum("_total"), F.lit(0))).first()[0])
    wanted = F.array(*[F.ceil(total * i / chunks) for i in range(1, chunks)]) if chunks > 1 else F.array().cast("array<bigint>")
    met = F.exists(wanted, lambda rank: (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n")))
    edges = ranked.filter(met).agg(F.sort_array(F.collect_list(key)).alias("cuts"))  # fewer than `chunks` keys
    rows = edges.select(F.posexplode(F.array_append("cuts", F.lit(None))).alias("chunk", "high"), "cuts")
    return rows.select("chunk", F.when(F.col("chunk") > 0, F.get("cuts", F.col("chunk") - 1)).alias("low"), "high")


def sql_literal(value: object) -> str:
    """A bound as ANSI SQL text."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def chunk_predicates(bounds: DataFrame, key: str, quote: str = "") -> list[str]:
    """One WHERE clause per chunk for a partitioned JDBC read, bounded by the chunk count; rows without a key come with
    the first chunk. `quote` is the database's sign around names."""
    name = f"{quote}{key}{quote}"
    clauses = []
    for r in bounds.orderBy("chunk").collect():
        low = "" if r["low"] is None else f"{name} > {sql_literal(r['low'])}"
        high = "" if r["high"] is None else f"{name} <= {sql_literal(r['high'])}"
        clause = " AND ".join(x for x in (low, high) if x) or f"{name} IS NOT NULL"
        clauses.append(clause if clauses else f"({clause}) OR {name} IS NULL")
    return clauses


def keyset_page(df: DataFrame, order: str, key: str, after: tuple | None, size: int) -> DataFrame:
    """The next page in (order, key) order. NULL order values never page; read them separately."""
    rows = df.filter(F.col(order).isNotNull())
    if after is not None:
        o, k = F.col(order), F.col(key)
        rows = rows.filter((o >= F.lit(after[0])) & ((o > F.lit(after[0])) | (k > F.lit(after[1]))))
    return rows.orderBy(order, key).limit(size)


def null_page(df: DataFrame, order: str) -> DataFrame:
    """Rows without an order value, which no keyset page returns."""
    return df.filter(F.col(order).isNull())


def exported_parquet(spark: SparkSession, prefix: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(prefix)


def reconcile_export(loaded: DataFrame, manifest: DataFrame, file: Column | None = None) -> DataFrame:
    """Rows per exported file or part against the export log's line counts (file, line_count).

    Rows are counted per physical file first, so one large part never meets in one task.
    """
    name = F.col("_metadata.file_name") if file is None else file
    per_file = loaded.groupBy(name.alias("file"), F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("_n"))
    found = per_file.groupBy("file").agg(F.sum("_n").alias("loaded"))
    joined = manifest.join(found, "file", "full_outer").fillna(0, ["line_count", "loaded"])
    return joined.withColumn("matches", F.col("line_count") == F.col("loaded"))


def query_options(df: DataFrame, options: dict) -> DataFrame:
    """select / filter / orderby / top / skip / count options as one declarative chain."""
    from tidemark.operators.ordering import page

    filters = options.get("filter") or []
    for clause in [filters] if isinstance(filters, str) else filters:
        df = df.filter(F.expr(clause))
    if options.get("count"):
        return df.agg(F.count(F.lit(1)).alias("count"))
    order = [F.expr(o.removesuffix(" desc")).desc() if o.endswith(" desc") else F.expr(o) for o in options.get("orderby") or []]
    if options.get("top") is not None:
        df = page(df, order, options.get("skip") or 0, options["top"])
    elif order:
        df = df.orderBy(*order)
    return df.select(*options["select"]) if options.get("select") else df
