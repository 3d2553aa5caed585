"""Column selection, renaming and decoding."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.coercion import lenient_cast, plain_text

# Names that clash with reserved words downstream.
RESERVED_RENAMES = {
    "class": "taxon_class",
    "order": "taxon_order",
    "type": "document_type",
}


def project(
    df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, always: list[str] = ()
) -> DataFrame:
    """Case-insensitive include, then exclude; `always` columns (the cursor) come back in any case."""
    wanted = {c.lower() for c in include} if include else None
    dropped = {c.lower() for c in exclude or ()}
    kept = [c for c in df.columns if (wanted is None or c.lower() in wanted) and c.lower() not in dropped]
    forced = {c.lower() for c in always}
    kept += [c for c in df.columns if c.lower() in forced and c not in kept]
    return df.select(*kept)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_reserved(df: DataFrame, rules: dict[str, str] = RESERVED_RENAMES) -> DataFrame:
    return df.withColumnsRenamed({c: rules[c.lower()] for c in df.columns if c.lower() in rules})


def whitelist(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only declared columns survive, each cast to its declared type (unparsable becomes NULL)."""
    kept = {c: t for c, t in columns.items() if c in df.columns}
    return df.select(*[lenient_cast(F.col(c), df.schema[c].dataType, t).alias(c) for c, t in kept.items()])


def normal_name(name: str, unique_id: str | None = None) -> str:
    """Lower-case word characters, runs of others become one '_'; a leading digit gets a prefix."""
    clean = re.sub(r"_+", "_", re.sub(r"\W", "_", name.strip().lower())).strip("_")
    if clean[:1].isdigit():
        clean = f"field_{clean}"
    if unique_id is None:
        return clean
    tag = re.sub(r"[^a-z0-9_]", "", unique_id.lower())
    return f"{clean or tag}__{tag}"


def normalize_headers(df: DataFrame) -> DataFrame:
    names = [normal_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalization: {clashes}")
    return df.toDF(*names)


def with_lineage(df: DataFrame, file_name: bool = False, **constants) -> DataFrame:
    """Constant audit columns, and the source file name where rows come from files."""
    extra = {k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()}
    if file_name:
        extra["source_file"] = F.input_file_name()
    return df.withColumns(extra)


def promote(df: DataFrame, moves: dict[str, str], drop_parents: bool = True) -> DataFrame:
    """`{"new": "field.sub"}`: sub-fields become top-level columns and the parents go."""
    out = df.withColumns({new: F.col(path) for new, path in moves.items()})
    return out.drop(*{p.split(".")[0] for p in moves.values()}) if drop_parents else out


def first_present(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor blank."""
    return F.coalesce(*[F.when(c.cast("string") != "", c) for c in candidates])


def decode_label(code: Column, labels: dict, default: str) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(default))


def variant_value(options: list[tuple[Column, T.DataType]]) -> Column:
    """One text value out of several typed alternatives, first non-null wins."""
    return F.coalesce(*[plain_text(c, t) for c, t in options])
