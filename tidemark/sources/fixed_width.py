"""Fixed-width records from 1-based start/length specs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coercion import fixed_field, fixed_field_bad
from tidemark.sources.lines import detail_lines


@dataclass(frozen=True)
class FixedField:
    name: str
    start: int
    length: int
    kind: str = "STRING"
    decimals: int | None = None
    date_format: str = "yyyyMMdd"

    def raw(self) -> Column:
        return F.substring("line", self.start, self.length)

    def value(self) -> Column:
        return fixed_field(self.raw(), self.kind, self.decimals, self.date_format).alias(self.name)

    def bad(self) -> Column:
        return fixed_field_bad(self.raw(), self.kind, self.decimals, self.date_format)


def parse(lines: DataFrame, fields: list[FixedField], header_trailer: bool = True, fixed: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns per detail line, with the file name and a flag on malformed lines; `keep` names position columns to
    pass on, `fixed` is for detail_lines()."""
    rows = detail_lines(lines, fixed) if header_trailer else lines.filter(F.trim("line") != "")
    malformed = reduce(lambda a, b: a | b, [f.bad() for f in fields])
    return rows.select("file", *keep, *[f.value() for f in fields], malformed.alias("malformed"))
