"""Declared tables: name, keys and column types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.coercion import lenient_cast


@dataclass(frozen=True)
class TableSpec:
    """A destination table. `columns` maps names to Spark type names; keys come first."""

    name: str
    primary_key: tuple[str, ...] = ()
    columns: dict[str, str] = field(default_factory=dict)

    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())

    def conform(self, df: DataFrame) -> DataFrame:
        """Declared columns first, cast and padded with NULL; undeclared ones are kept after them."""
        present = {c.lower(): c for c in df.columns}
        declared = [
            (lenient_cast(F.col(present[c.lower()]), df.schema[present[c.lower()]].dataType, t) if c.lower() in present else F.lit(None).cast(t)).alias(c)
            for c, t in self.columns.items()
        ]
        names = {c.lower() for c in self.columns}
        return df.select(*declared, *[c for c in df.columns if c.lower() not in names])


@dataclass(frozen=True)
class ReadPlan:
    """What to read of one table; compiles to select and filter only."""

    table: str
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    cursor: str | None = None
    low: object = None
    high: object = None
    predicate: tuple[str, str, object] | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        from tidemark.operators.predicates import compare
        from tidemark.operators.projection import project

        if self.predicate:
            df = df.filter(compare(*self.predicate))
        if self.cursor and self.low is not None:
            df = df.filter(F.col(self.cursor) > F.lit(self.low).cast(df.schema[self.cursor].dataType))
        if self.cursor and self.high is not None:
            df = df.filter(F.col(self.cursor) <= F.lit(self.high).cast(df.schema[self.cursor].dataType))
        always = [self.cursor] if self.cursor else []
        return project(df, list(self.include) or None, list(self.exclude), always)
