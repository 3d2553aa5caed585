"""Array, map and numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.coercion import implied_cents

# Inclusive type-code ranges.
CREDIT_CODES = (100, 399)
DEBIT_CODES = (400, 699)


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_where(arr: Column, test) -> Column:
    """First element that passes, NULL when none does."""
    return F.try_element_at(F.filter(arr, test), F.lit(1))


def pick_where(arr: Column, test, field: str) -> Column:
    """One field of the array elements that pass."""
    return F.transform(F.filter(arr, test), lambda x: x[field])


def has_any(arr: Column, values: list[str]) -> Column:
    return F.arrays_overlap(arr, F.array(*[F.lit(v) for v in values]))


def stride_groups(parts: Column, stride: int = 4) -> Column:
    """Flat (code, amount, ...) list to an array of (code, amount) with valid 3-digit codes."""
    starts = F.filter(F.sequence(F.lit(0), F.size(parts), F.lit(stride)), lambda i: i + 1 < F.size(parts))
    pairs = F.transform(
        starts,
        lambda i: F.struct(
            F.trim(F.get(parts, i)).alias("code"),
            implied_cents(F.get(parts, i + 1)).alias("amount"),
        ),
    )
    return F.filter(pairs, lambda p: p["code"].rlike("^[0-9]{3}$"))


def last_wins_map(pairs: Column) -> Column:
    """Array of (code, amount) to a map; a repeated code keeps its last amount."""
    kept = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda later: later["code"] == p["code"]
        ),
    )
    return F.map_from_entries(kept)


def balance_map(segments: Column) -> Column:
    """Each comma-separated segment is parsed on its own, then merged in order."""
    cells = lambda s: F.split(F.regexp_replace(F.trim(s), ",*/*$", ""), ",")
    groups = F.flatten(F.transform(segments, lambda s: let(cells(s), lambda c: stride_groups(c))))
    return let(groups, last_wins_map)


def debit_credit(code: Column) -> Column:
    number = F.when(code.rlike("^ *[0-9]+ *$"), F.trim(code).try_cast("int"))
    return F.when(number.between(*CREDIT_CODES), "C").when(number.between(*DEBIT_CODES), "D")


def zip_named(names: Column, values: Column) -> Column:
    """Column-name array and row array to a map; cells beyond the names are ignored."""
    width = F.least(F.size(names), F.size(values))
    return F.map_from_arrays(F.slice(names, F.lit(1), width), F.slice(values, F.lit(1), width))


def value_at(arr: Column, position: Column) -> Column:
    """Element at a zero-based position; a short or missing array gives NULL."""
    return F.get(arr, position)
