"""Ordered scans, row numbers, dedupe and paging.

No function here sorts a table, or one hot group of it, inside a single task. Carry-forward and
running totals work block by block: a block is a slice of the order (a file split, a day, a key
range), each block is scanned on its own, and the much smaller per-block summaries are scanned
again to hand values over to later blocks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.session import cut_lineage, small_side

PAGE_LIMIT = 10_000
#: Slices of an order for each task of a shuffle, and sampled keys for each slice.
BLOCKS_PER_TASK = 4
SAMPLE_PER_BLOCK = 16
#: Rows that one task puts in order, on average: tables that grow get more tasks, not larger ones.
ROWS_PER_TASK = 100_000


def tasks_for(df: DataFrame) -> int:
    """How many tasks keep to ROWS_PER_TASK rows each; counts the rows."""
    return max(2, -(-df.count() // ROWS_PER_TASK))


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _null_free(df: DataFrame, columns: dict[str, Column]) -> dict[str, Column]:
    """Key columns that are never NULL, so that a plain equi join can reuse a window's partitioning."""
    typed = df.select(*[c.alias(n) for n, c in columns.items()]).schema
    out: dict[str, Column] = {}
    for field in typed.fields:
        c, kind = columns[field.name], field.dataType
        if isinstance(kind, T.StringType):
            out |= {field.name: F.coalesce(c, F.lit("")), f"{field.name}_null": c.isNull()}
        elif isinstance(kind, T.NumericType):
            out |= {field.name: F.coalesce(c, F.lit(0).cast(kind)), f"{field.name}_null": c.isNull()}
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out |= {field.name: F.coalesce(c, F.lit("1970-01-01").cast(kind)), f"{field.name}_null": c.isNull()}
        else:
            out[field.name] = F.struct(c)
    return out


def _blocked(df: DataFrame, group: list[str], block: Column, extra: dict[str, Column]) -> tuple[DataFrame, list[str], list[str]]:
    """The rows with null-free group and block keys, shuffled by them into tasks of bounded size; returns (rows, group keys,
    group and block keys)."""
    group_keys = _null_free(df, {f"_g{i}": F.col(g) for i, g in enumerate(group)})
    block_keys = _null_free(df, {"_b": block})
    keys = [*group_keys, *block_keys]
    rows = df.withColumns({**group_keys, **block_keys, "_block": block, **extra}).repartition(tasks_for(df), *keys)
    return rows, list(group_keys), keys


def carry_forward(
    df: DataFrame, group: list[str], order: list[str], block: Column, values: dict[str, Column]
) -> DataFrame:
    """Add one column per value: the last non-null value at or before each row of the group.

    `block` must never decrease along the order within a group. Rows are shuffled by group and
    block; the join of the block summaries reuses that partitioning and its sort. The summaries are made from their own
    columns in tasks of the same size.
    """
    staged, groups, keys = _blocked(df, group, block, {f"_set_{n}": c for n, c in values.items()})
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = staged.withColumns({f"_in_{n}": F.last(f"_set_{n}", True).over(inside) for n in values})
    position = _order_struct(order)
    tails = staged.groupBy(*keys, "_block").agg(
        *[F.max_by(f"_set_{n}", F.when(F.col(f"_set_{n}").isNotNull(), position)).alias(f"_t_{n}") for n in values]
    )
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = tails.select(*keys, *[F.last(f"_t_{n}", True).over(earlier).alias(f"_h_{n}") for n in values])
    joined = filled.join(handed, keys, "left")
    return joined.select(*df.columns, *[F.coalesce(f"_in_{n}", f"_h_{n}").alias(n) for n in values])


def inherited(blocks: DataFrame, group: list[str], block: str, values: dict[str, Column]) -> DataFrame:
    """What each block takes over from the earlier blocks of its group: the last non-null of each value.

    `blocks` has one row per block, the summary that its own scan left. "Last non-null" merges summaries in
    any grouping, so only these rows, not the scanned ones, are put in order here.
    """
    earlier = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumns({n: F.last(c, True).over(earlier) for n, c in values.items()})


def running_total(
    df: DataFrame, group: list[str], order: list[str], block: Column, value: Column, name: str
) -> DataFrame:
    """Add the running sum of `value` along the order within each group."""
    staged, groups, keys = _blocked(df, group, block, {"_v": value})
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = staged.withColumn("_local", F.sum("_v").over(inside))
    totals = staged.groupBy(*keys, "_block").agg(F.sum("_v").alias("_total"))
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    joined = filled.join(before, keys, "left")
    return joined.select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))


def _directions(order: list) -> list[tuple[Column, bool, bool]]:
    """(value, descending, nulls first) of each item of an order: a column name or a column with a direction."""
    out = []
    for item in order:
        found = re.fullmatch(r"Column<'(.+) (ASC|DESC) NULLS (FIRST|LAST)'>", str(item), re.DOTALL)
        if found:
            out.append((F.expr(found[1]), found[2] == "DESC", found[3] == "FIRST"))
        else:
            out.append((F.col(item) if isinstance(item, str) else item, False, True))
    return out


def _precedes(bound: Column, order: list) -> Column:
    """Whether the fields of `bound` come before the row in the order."""
    before, same = F.lit(False), F.lit(True)
    for i, (value, descending, nulls_first) in enumerate(_directions(order)):
        edge = bound[f"k{i}"]
        less = F.coalesce(edge > value if descending else edge < value, edge.isNull() if nulls_first else value.isNull()) & ~(edge.isNull() & value.isNull())
        before, same = before | (same & less), same & edge.eqNullSafe(value)
    return before


def _block_of(bounds: list, order: list, types: list) -> Column:
    """How many of the sorted bounds come before the row, by bisection in an array of literals."""
    if not bounds:
        return F.lit(0).cast("long")
    edges = F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row, types))]) for row in bounds])
    steps = F.array(*[F.lit(i) for i in range(len(bounds).bit_length())])

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        above = F.struct((middle + 1).alias("low"), a["high"].alias("high"))
        below = F.struct(a["low"].alias("low"), middle.alias("high"))
        return F.when(a["low"] >= a["high"], a).when(_precedes(F.get(edges, middle), order), above).otherwise(below)

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(steps, start, halve, lambda a: a["low"].cast("long"))


def range_blocks(df: DataFrame, order: list, blocks: int | None = None) -> DataFrame:
    """Adds `_part`, the row's slice of the order, counted from 0.

    For groups without a natural bounded block. The slices' bounds are literals from one random sample of the whole keys, so a
    group, or one moment of it, that holds most rows is spread over many slices, and every job that computes
    `_part` again finds the same slices without a table in between. Keys must be of atomic types. There are
    BLOCKS_PER_TASK times `spark.sql.shuffle.partitions` slices unless told otherwise.
    """
    blocks = blocks or BLOCKS_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*[value.alias(f"k{i}") for i, (value, _, _) in enumerate(_directions(order))])
    sides = [(F.desc_nulls_first if nulls else F.desc_nulls_last) if down else (F.asc_nulls_first if nulls else F.asc_nulls_last) for _, down, nulls in _directions(order)]
    sample = keys.orderBy(F.rand(11)).limit(SAMPLE_PER_BLOCK * blocks).orderBy(*[side(f"k{i}") for i, side in enumerate(sides)]).collect()
    bounds = [tuple(sample[len(sample) * i // blocks]) for i in range(1, blocks)] if sample else []
    return df.withColumn("_part", _block_of(list(dict.fromkeys(bounds)), order, [f.dataType for f in keys.schema.fields]))


def block_offsets(placed: DataFrame, value: Column) -> DataFrame:
    """(_part, _before): the sum of `value` in all earlier slices; as many rows as slices."""
    totals = placed.groupBy("_part").agg(F.sum(value).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"), "_total")


def running_in_blocks(placed: DataFrame, offsets: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    """The running sum over the whole order: within each slice, and on top of what the earlier slices hold."""
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_local", F.sum(value).over(inside))
    joined = local.join(F.broadcast(offsets.drop("_total")), "_part")
    return joined.withColumn(name, F.col("_before") + F.col("_local")).drop("_part", "_local", "_before")


def number_in_group(
    df: DataFrame, group: list[str], order: list[str], block: Column, name: str = "row_no"
) -> DataFrame:
    """1-based row number within each group, hot groups split over their blocks."""
    return running_total(df, group, order, block, F.lit(1).cast("bigint"), name)


def global_running_total(df: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    """Running sum over the whole table in a total order. Rows are shuffled once, by slice of the order."""
    placed = range_blocks(df, order)
    return running_in_blocks(placed, block_offsets(placed, value), order, value, name)


def global_row_number(df: DataFrame, order: list, name: str = "row_no") -> DataFrame:
    """1-based row number over the whole table in a total order, without a one-task window."""
    return global_running_total(df, order, F.lit(1).cast("bigint"), name)


def rows_between(df: DataFrame, order: list, low: int, high: int | None, name: str = "row_no") -> DataFrame:
    """The rows numbered low..high (to the end without `high`) in a total order, with their numbers. Slices are counted first;
    only those that hold such rows are shuffled and put in order."""
    placed = range_blocks(df, order)
    one = F.lit(1).cast("bigint")
    # as many rows as slices
    counted = block_offsets(placed, one).collect()
    wanted = [r for r in counted if r["_before"] + r["_total"] >= low and (high is None or r["_before"] < high)]
    if not wanted:
        return df.limit(0).withColumn(name, one)
    first, last = min(r["_part"] for r in wanted), max(r["_part"] for r in wanted)
    offsets = df.sparkSession.createDataFrame([(r["_part"], r["_before"], r["_total"]) for r in wanted], "_part long, _before long, _total long")
    numbered = running_in_blocks(placed.filter(F.col("_part").between(first, last)), offsets, order, one, name)
    return numbered.filter((F.col(name) >= low) if high is None else F.col(name).between(low, high))


def keep_one(df: DataFrame, keys: list[str], order: list, keep: str = "first") -> DataFrame:
    """One row per key by an explicit total order.

    `row_number() = 1` lets Spark cut each key to one row before the shuffle, so a hot key is safe.
    """
    if keep == "last":
        order = [c.desc() for c in (F.col(o) if isinstance(o, str) else o for o in order)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def top_n_per(df: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """First n rows per key, by an order that should be total.

    Spark cuts each key to n rows before the shuffle as long as n is under its own threshold; beyond it, rows are cut
    within slices of a key first, so no task holds a whole hot key.
    """
    name = rank or "_rn"
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(slices)))
        placed = sliced.withColumn("_place", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order)))
        df = placed.filter(F.col("_place") <= n).drop("_slice", "_place")
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def continuation_groups(
    lines: DataFrame, group: list[str], order: list[str], block: Column, is_continuation: Column
) -> DataFrame:
    """Number the records of a line table: continuation lines share the number of their head line."""
    head = F.when(is_continuation, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    return running_total(lines, group, order, block, head, "record_no")


def gather_records(
    lines: DataFrame, group: list[str], order: list[str], block: Column, is_continuation: Column, fields: list[str]
) -> DataFrame:
    """One row per record: the group and `lines`, its head and continuation lines in order.

    Records are numbered and gathered inside their block, on the partitioning of that one shuffle. Only
    continuations at the start of a block, whose head is in an earlier one, are attached by a join; there is
    at most one such piece per block. Lines before the first head of a group belong to no record.
    """
    staged, groups, keys = _blocked(lines, group, block, {"_head": F.when(is_continuation, 0).otherwise(1)})
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = staged.withColumn("_no", F.sum("_head").over(inside))
    # One record is one output value, so gathering its lines is bounded by the record.
    pieces = cut_lineage(
        numbered.groupBy(*group, *keys, "_block", "_no").agg(
            F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("lines")
        )
    )
    heads = pieces.filter(F.col("_no") > 0)
    owners = heads.groupBy(*keys, "_block").agg(F.max("_no").alias("_no"))
    owners = owners.select(*keys, "_block", F.struct(*keys, "_no").alias("_owner"), F.lit(None).cast(pieces.schema["lines"].dataType).alias("_rest"))
    orphans = pieces.filter(F.col("_no") == 0)
    orphans = orphans.select(*keys, "_block", F.lit(None).cast(owners.schema["_owner"].dataType).alias("_owner"), F.col("lines").alias("_rest"))
    # An orphan comes before the records of its own block, and there is one row of each kind per block.
    earlier = (
        Window.partitionBy(*groups).orderBy("_block", F.col("_owner").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    )
    found = owners.unionByName(orphans).withColumn("_owner", F.when(F.col("_rest").isNotNull(), F.last("_owner", True).over(earlier)))
    tails = found.filter(F.col("_owner").isNotNull()).groupBy("_owner").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_rest"))), lambda p: p["_rest"])).alias("_tail")
    )
    joined = heads.join(small_side(tails.select("_owner.*", "_tail")), [*keys, "_no"], "left")
    whole = F.when(F.col("_tail").isNull(), F.col("lines")).otherwise(F.concat("lines", "_tail"))
    return joined.select(*group, whole.alias("lines"))


def page(df: DataFrame, order: list, offset: int, size: int) -> DataFrame:
    """LIMIT/OFFSET page. Shallow pages are a top-N; deep ones order only the slices that the page lies in."""
    if offset + size <= PAGE_LIMIT:
        return df.orderBy(*order).offset(offset).limit(size)
    return rows_between(df, order, offset + 1, offset + size, "_row_no").drop("_row_no")


def tie_complete_prefix(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by key plus every row tied with the n-th."""
    cut = df.filter(F.col(key).isNotNull()).select(key).orderBy(key).limit(n).agg(F.max(key)).first()[0]
    return df.filter(F.col(key) <= F.lit(cut))


def newest(df: DataFrame, order: list[str]) -> DataFrame:
    """The single newest row, by partial aggregation rather than a sort."""
    best = df.agg(F.max_by(F.struct(*df.columns), _order_struct(order)).alias("r"))
    return best.filter(F.col("r").isNotNull()).select("r.*")
