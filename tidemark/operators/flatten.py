"""Nested structs to flat columns, driven by the schema and never by the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.projection import normal_name

LIST_POLICIES = ("json", "null", "brackets", "comma", "first")


def _list_value(c: Column, kind: T.ArrayType, policy: str) -> Column:
    if policy == "null":
        return F.when(F.size(c) > 0, F.to_json(c))
    if policy == "brackets":
        return F.coalesce(F.to_json(c), F.lit("[]"))
    if policy == "comma" and isinstance(kind.elementType, T.StringType):
        return F.when(F.size(c) > 0, F.concat_ws(",", c)).when(c.isNotNull(), F.lit("[]"))
    if policy == "first":
        return F.try_element_at(c, F.lit(1))
    return F.to_json(c)


def flat_columns(
    schema: T.StructType,
    parent: Column | None = None,
    prefix: str = "",
    separator: str = "_",
    lists: str = "json",
    max_depth: int | None = None,
    depth: int = 0,
) -> list[tuple[str, Column]]:
    """(name, expression) for every leaf. Below `max_depth` levels a struct becomes JSON text."""
    if lists not in LIST_POLICIES:
        raise ValueError(f"lists must be one of {LIST_POLICIES}")
    out: list[tuple[str, Column]] = []
    for field in schema.fields:
        c = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        name = f"{prefix}{separator}{field.name}" if prefix else field.name
        kind = field.dataType
        if isinstance(kind, T.StructType) and (max_depth is None or depth < max_depth):
            out += flat_columns(kind, c, name, separator, lists, max_depth, depth + 1)
        elif isinstance(kind, (T.StructType, T.MapType)):
            out.append((name, F.to_json(c)))
        elif isinstance(kind, T.ArrayType):
            out.append((name, _list_value(c, kind, lists)))
        else:
            out.append((name, c))
    return out


def flatten(
    df: DataFrame, lists: str = "json", max_depth: int | None = None, separator: str = "_", normalize: bool = False
) -> DataFrame:
    """All structs flattened into joined names; one projection, no shuffle."""
    pairs = flat_columns(df.schema, separator=separator, lists=lists, max_depth=max_depth)
    return df.select(*[c.alias(normal_name(n) if normalize else n) for n, c in pairs])


def flatten_named(
    df: DataFrame, fields: list[str], bare: list[str] = (), renames: dict[str, str] | None = None
) -> DataFrame:
    """Flatten only the listed structs; a key that already starts with the prefix, or a field
    listed in `bare`, gets no prefix. Explicit renames win."""
    renames = renames or {}

    def walk(c: Column, kind: T.StructType, prefix: str) -> list[tuple[str, Column]]:
        out = []
        for f in kind.fields:
            if f"{prefix}.{f.name}" in renames:
                name = renames[f"{prefix}.{f.name}"]
            elif f.name.startswith(prefix) or prefix in bare:
                name = f.name
            else:
                name = f"{prefix}_{f.name}"
            child = c.getField(f.name)
            out += walk(child, f.dataType, name) if isinstance(f.dataType, T.StructType) else [(name, child)]
        return out

    kept = [F.col(c) for c in df.columns if c not in fields]
    flat = [c.alias(n) for f in fields for n, c in walk(F.col(f), df.schema[f].dataType, f)]
    return df.select(*kept, *flat)


def hoist(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Nested keys merged into the top level without a prefix; a later name replaces an earlier one."""
    structs = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
    chosen = {f.name: f.dataType for f in structs if fields is None or f.name in fields}
    merged: dict[str, Column] = {c: F.col(c) for c in df.columns if c not in chosen}
    for name, kind in chosen.items():
        merged.update({f.name: F.col(name).getField(f.name) for f in kind.fields})
    return df.select(*[c.alias(n) for n, c in merged.items()])


def map_to_columns(df: DataFrame, column: str, keys: list[str], prefix: str | None = None) -> DataFrame:
    """Declared map keys become prefixed, normalized columns."""
    head = column if prefix is None else prefix
    picked = {normal_name(f"{head}_{k}"): F.try_element_at(F.col(column), F.lit(k)) for k in keys}
    return df.withColumns(picked).drop(column)


def struct_block(df: DataFrame, column: str, prefix: str) -> list[Column]:
    """The fields of one struct under a prefix, for address, price or geometry blocks."""
    pairs = flat_columns(df.schema[column].dataType, F.col(column), prefix)
    return [c.alias(n) for n, c in pairs]


def serialize(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumns({f: F.to_json(F.col(f)) for f in fields})
