"""Filters. Plain comparisons reach the scan; list filters are joins against a key table."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
}


def compare(column: str, op: str, value) -> Column:
    return _COMPARE[op](F.col(column), F.lit(value))


def all_of(*clauses: Column | None) -> Column:
    """AND of the clauses that are set."""
    return reduce(operator.and_, [c for c in clauses if c is not None], F.lit(True))


def key_missing(keys: list[str]) -> Column:
    """NULL or blank in any key column."""
    return reduce(
        operator.or_, [F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "") for k in keys]
    )


def split_required(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with whole keys, rejected rows)."""
    missing = key_missing(keys)
    return df.filter(~missing), df.filter(missing)


def include_exclude(df: DataFrame, key: str, include: DataFrame | None, exclude: DataFrame | None) -> DataFrame:
    """Exclude beats include; no include list means everything."""
    out = df if exclude is None else df.join(exclude.select(key).distinct(), key, "left_anti")
    return out if include is None else out.join(include.select(key).distinct(), key, "left_semi")


def relevant(codes: Column, wanted: list[str], text: Column, keyword: str) -> Column:
    """Codes overlap the wanted list, or the keyword is in the text, or there are no codes."""
    none = codes.isNull() | (F.size(codes) == 0)
    overlap = F.coalesce(F.arrays_overlap(codes, F.array(*[F.lit(w) for w in wanted])), F.lit(False))
    return none | overlap | F.lower(text).contains(keyword.lower())


def search(ts: str, start: str, end: str, column: str | None = None, term: str | None = None) -> Column:
    """A closed date range, plus a literal-text clause only when a term is given."""
    day = F.col(ts)
    dated = (day >= F.lit(start).cast("timestamp")) & (day < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    clause = F.contains(F.lower(column), F.lower(F.lit(term))) if term else None
    return all_of(dated, clause)
