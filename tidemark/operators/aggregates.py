"""Aggregations. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut_lineage, small_side

MONEY = "decimal(18,2)"
PERCENTILES = (50, 90, 95, 99)
#: Rows of one interval that one task may put in order.
SORTED_VALUES = 100_000
#: Bins of one round of counting.
BINS = 1024


def money_sum(c: Column | str) -> Column:
    """Exact, order-independent sum of two-decimal amounts, as a double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(MONEY)).cast("double")


def count_by(df: DataFrame, key: Column, name: str, unknown: str = "Unknown") -> DataFrame:
    label = F.coalesce(F.nullif(key, F.lit("")), F.lit(unknown)).alias(name)
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def count_where(df: DataFrame, keys: list[str], tests: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


def top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value: a top-N over the counts, not a full sort."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(key)).limit(k)


def per_window(df: DataFrame, ts: str, width: str, keys: list[str] = ()) -> DataFrame:
    """Tumbling counts on aligned windows."""
    grouped = df.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("window.start").alias("window_start"), *keys, "n")


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole latest row per key by partial aggregation."""
    best = F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, "r.*")


def cursor_range(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.min(cursor).alias("min_cursor"), F.max(cursor).alias("max_cursor"), F.count(cursor).alias("n"))


def merge_fields(df: DataFrame, entity: str, field: str, order: str, attributes: list[str]) -> DataFrame:
    """Union of fields per entity, each keeping its first definition, as rows."""
    first = F.min_by(F.struct(*attributes), F.col(order)).alias("r")
    return df.groupBy(entity, field).agg(first, F.min(order).alias("first_seen")).select(entity, field, "first_seen", "r.*")


def field_names(df: DataFrame, column: str) -> DataFrame:
    """Distinct keys seen in a map column, one row each with their use count."""
    keys = df.select(F.explode(F.map_keys(column)).alias("field"))
    return keys.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def reject_counts(rejects: DataFrame, reason: str = "reason") -> DataFrame:
    return rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def census(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, largest first. Counting needs no columns, so scans read footers only."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(F.desc("n"), "entity")


def _scaled(x: Column, whole: Column) -> Column:
    """A magnitude that is cut into equal parts: the logarithm for a whole interval, so that far values cost no rounds,
    and half the value for a part of it, so that differences cannot overflow."""
    power = F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.ln(F.abs(x)) + 745))
    return F.when(whole, power).otherwise(x / 2)


def _bin(v: Column, low: Column, high: Column, whole: Column) -> Column:
    """The value's place among BINS parts of the finite range; never decreases with the value. Infinities and NaN
    have bins of their own at the ends."""
    x = v.cast("double")
    at, lo, hi = [_scaled(c.cast("double"), whole) for c in (v, low, high)]
    # a range too narrow for doubles is cut at its first value
    share = F.coalesce(F.try_divide(at - lo, hi - lo), F.when(v == low, 0.0).otherwise(1.0))
    inner = F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))
    edges = F.when(F.isnan(x), BINS + 1).when(x == float("inf"), BINS).when(x == float("-inf"), -1)
    return edges.otherwise(inner)


def _selected(values: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """The percentiles of the intervals in `hot` (interval, _n), by rounds of histograms: each counts the bins of a
    range, and the bin with the wanted rank is the next range, until it holds one value or few rows."""
    x = F.col("_v").cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.col("_v"))
    same = F.col(name).eqNullSafe(F.col("_name"))
    bounds = values.join(small_side(hot.select(F.col(name).alias("_name"))), same).groupBy("_name").agg(F.min(finite).alias("_low"), F.max(finite).alias("_high"))
    wanted = F.explode(F.array(*[F.lit(p) for p in PERCENTILES])).alias("_p")
    ranged = hot.select(F.col(name), wanted, "_n").join(bounds, same)
    # from here on _rank counts within the range; edges are the bins beyond a finite range
    open_ = cut_lineage(ranged.select("_name", "_p", "_low", "_high", F.ceil(F.col("_n") * F.col("_p") / F.lit(100)).alias("_rank"), F.lit(True).alias("_whole")))
    found = None
    while True:
        inside = F.col("_whole") | F.col("_v").between(F.col("_low"), F.col("_high"))
        ranges = small_side(open_, computed=True)
        binned = values.join(ranges, same).filter(inside).select("_name", "_p", "_rank", "_v", _bin(*[F.col(c) for c in ("_v", "_low", "_high", "_whole")]).alias("_bin"))
        counts = binned.groupBy("_name", "_p", "_rank", "_bin").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        # a bounded number of bins for each interval and percentile
        upto = F.sum("_c").over(Window.partitionBy("_name", "_p").orderBy("_bin"))
        hit = counts.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank")))
        hit = cut_lineage(hit.select("_name", "_p", "_low", "_high", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank"), F.lit(False).alias("_whole"), "_c"))
        done = (F.col("_low").eqNullSafe(F.col("_high"))) | (F.col("_c") <= SORTED_VALUES)
        found = hit.filter(done) if found is None else found.unionByName(hit.filter(done))
        open_ = hit.filter(~done).drop("_c")
        if open_.isEmpty():
            break
    one = F.col("_low").eqNullSafe(F.col("_high"))
    settled = found.filter(one).select("_name", "_p", F.col("_low").alias("_value"))
    few = small_side(found.filter(~one))
    rest = values.join(few, same & F.col("_v").between(F.col("_low"), F.col("_high"))).groupBy("_name", "_p", "_rank").agg(F.sort_array(F.collect_list("_v")).alias("_s"))
    picked = settled.unionByName(rest.select("_name", "_p", F.get("_s", (F.col("_rank") - 1).cast("int")).alias("_value")))
    return picked.groupBy("_name").agg(*[F.max(F.when(F.col("_p") == p, F.col("_value"))).alias(f"p{p}") for p in PERCENTILES])


def interval_metrics(df: DataFrame, bucket: Column, name: str, value: str) -> DataFrame:
    """Average, extremes, spread and percentiles per interval, exact at any size.

    A percentile is the smallest value up to which at least that share of the interval's rows lies. Intervals with few
    rows are put in order whole, in the same pass as the other metrics; in others the values are found by counting.
    """
    rows = df.select(bucket.alias(name), F.col(value).alias("_v"))
    metrics = {
        "n": F.count(F.lit(1)),
        "sum_value": F.sum(F.col("_v").cast("decimal(38,10)")).cast("double"),
        "avg_value": F.round(F.avg("_v"), 6),
        "min_value": F.min("_v"),
        "max_value": F.max("_v"),
        "stddev_value": F.round(F.stddev_samp("_v"), 6),
    }
    aggregates = [c.alias(n) for n, c in metrics.items()]
    ordered = F.sort_array(F.collect_list("_v")).alias("_s")
    place = lambda p: F.ceil(F.size("_s") * p / F.lit(100)).cast("int") - 1
    points = [F.get("_s", place(p)).alias(f"p{p}") for p in PERCENTILES]
    hot = cut_lineage(rows.groupBy(name).agg(F.count("_v").alias("_n")).filter(F.col("_n") > SORTED_VALUES))
    if hot.isEmpty():
        return rows.groupBy(name).agg(*aggregates, ordered).select(name, *metrics, *points)
    key = hot.select(F.col(name).alias("_name"))
    same = F.col(name).eqNullSafe(F.col("_name"))
    few = rows.join(small_side(key), same, "left_anti").groupBy(name).agg(*aggregates, ordered).select(name, *metrics, *points)
    many = rows.join(small_side(key), same, "left_semi")
    found = _selected(many.filter(F.col("_v").isNotNull()), hot, name)
    joined = many.groupBy(name).agg(*aggregates).join(found, same)
    return few.unionByName(joined.select(*few.columns))
