"""Validation, all-or-nothing files, trailer counts and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coercion import int_text
from tidemark.session import small_side

# Accepted date and timestamp layouts of strict rows.
DATE_LAYOUT = "yyyy-M-d"
TIMESTAMP_LAYOUT = "yyyy-M-d H:m:s"


def check(column: str, kind: str) -> Column:
    """Reason text when the cell breaks its rule, else NULL."""
    c = F.col(column)
    valid = {
        "int": int_text(c).isNotNull(),
        "bool": F.lower(c).isin("true", "false"),
        "string": F.trim(c) != "",
        "json": F.try_parse_json(c).isNotNull(),
        "date": F.try_to_timestamp(F.trim(c), F.lit(DATE_LAYOUT)).isNotNull(),
        "timestamp": F.try_to_timestamp(F.trim(c), F.lit(TIMESTAMP_LAYOUT)).isNotNull(),
    }[kind]
    reason = F.concat(F.lit(f"Invalid {kind} value in {column}: '"), F.coalesce(c, F.lit("")), F.lit("'"))
    return F.when(~F.coalesce(valid, F.lit(False)), reason)


def typed(column: str, kind: str) -> Column:
    c = F.col(column)
    return {
        "int": int_text(c),
        "bool": F.lower(c) == "true",
        "string": c,
        "json": c,
        "date": F.to_date(F.try_to_timestamp(F.trim(c), F.lit(DATE_LAYOUT))),
        "timestamp": F.try_to_timestamp(F.trim(c), F.lit(TIMESTAMP_LAYOUT)),
    }[kind]


def validate(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Adds `reasons`, the broken rules of each row in rule order; no second pass over the input."""
    checks = F.array(*[check(c, k) for c, k in rules.items()])
    return df.withColumn("reasons", F.filter(checks, lambda r: r.isNotNull()))


def split_valid(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed accepted rows, rejected rows with reasons)."""
    checked = validate(df, rules)
    others = [c for c in df.columns if c not in rules]
    good = checked.filter(F.size("reasons") == 0).select(*others, *[typed(c, k).alias(c) for c, k in rules.items()])
    return good, checked.filter(F.size("reasons") > 0)


def whole_files(rows: DataFrame, file: str, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of files without a bad line, failed files with their bad-line count)."""
    failed = rows.filter(bad).groupBy(file).agg(F.count(F.lit(1)).alias("bad_lines"))
    return rows.join(small_side(failed.select(file)), file, "left_anti"), failed


def trailer_check(
    lines: DataFrame, file: str, order: list[str], start: int, length: int, includes_header: bool
) -> DataFrame:
    """Per file: line count, trailer count and a verdict, in one partial aggregation."""
    position = F.struct(*order)
    stats = lines.filter(F.trim("line") != "").groupBy(file).agg(
        F.count(F.lit(1)).alias("line_count"), F.max_by("line", position).alias("trailer")
    )
    expected = F.col("line_count") if includes_header else F.col("line_count") - 2
    claimed = int_text(F.substring("trailer", start, length))
    status = (
        F.when(F.col("line_count") < 3, "too_short")
        .when(claimed.isNull(), "bad_trailer")
        .when(claimed != expected, "count_mismatch")
        .otherwise("ok")
    )
    return stats.select(file, "line_count", claimed.alias("trailer_count"), status.alias("status"))


def reconcile(expected: DataFrame, loaded: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Counts on both sides by key, verified when they agree; a missing side counts as zero."""
    a = expected.select(*keys, F.col(count).alias("expected_count"))
    b = loaded.select(*keys, F.col(count).alias("loaded_count"))
    both = a.join(b, keys, "full_outer").fillna(0, ["expected_count", "loaded_count"])
    same = F.col("expected_count") == F.col("loaded_count")
    return both.withColumn("status", F.when(same, "verified").otherwise("unverified"))


def coerce_key(c: Column, kind: str) -> Column:
    """Key text without brackets and quotes around it, cast; NULL where that is impossible."""
    if kind == "string":
        return F.nullif(F.trim(c), F.lit(""))
    return int_text(F.regexp_replace(F.trim(c), "^[\\[\\]\"']+|[\\[\\]\"']+$", ""), kind)
