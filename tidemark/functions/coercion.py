"""Text-to-type coercion with NULL, reject or keep-original outcomes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT_TEXT = r"(?i)^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"

# Source type name -> logical type.
LOGICAL_TYPES = {
    "bit": "boolean",
    "boolean": "boolean",
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "float": "double",
    "double": "double",
    "double precision": "double",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "date": "date",
    "time": "string",
    "datetime": "timestamp_ntz",
    "smalldatetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "bigdatetime": "timestamp_ntz",
    "timestamp": "timestamp",
    "timestamp with time zone": "timestamp",
    "datetimeoffset": "timestamp",
    "binary": "binary",
    "varbinary": "binary",
    "image": "binary",
    "blob": "binary",
    "char": "string",
    "varchar": "string",
    "text": "string",
    "json": "string",
    "xml": "string",
    "interval": "int",
}


def int_text(c: Column, kind: str = "bigint") -> Column:
    """Whole-number text, blanks around it allowed; '3.7' and junk give NULL."""
    text = c.cast("string")
    return F.when(text.rlike(_INT_TEXT), F.trim(text).try_cast(kind))


def float_text(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(_FLOAT_TEXT), F.trim(text).try_cast("double"))


def lenient_cast(c: Column, source: T.DataType, target: str) -> Column:
    """Cast where what does not parse is NULL. Text is tested before it is cast to a number: a failed
    try_cast costs an exception per row, which a column of bad values cannot afford."""
    if isinstance(source, T.StringType):
        if target in ("tinyint", "smallint", "int", "bigint"):
            return int_text(c, target)
        if target in ("float", "double"):
            return float_text(c).cast(target)
        if target.startswith("decimal"):
            return F.when(c.rlike(_FLOAT_TEXT), F.trim(c).try_cast(target))
        if target.startswith("timestamp"):
            return F.try_to_timestamp(c).cast(target)
    return c.cast(target) if source.simpleString() == target else c.try_cast(target)


def truncated_int(c: Column) -> Column:
    """A real number loses its fraction toward zero (the numeric branch of lenient ints)."""
    return F.when(~F.isnan(c), c.try_cast("bigint"))


def yes_no(c: Column) -> Column:
    """yes/true -> True, no/false -> False in any case, anything else NULL."""
    word = F.lower(F.trim(c))
    return F.when(word.isin("yes", "true"), F.lit(True)).when(word.isin("no", "false"), F.lit(False))


def typed_or_raw(c: Column, kind: str) -> Column:
    """Canonical text of the typed value when it parses, else the original text."""
    if kind in ("DATE", "DATETIME"):
        parsed = F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd'T'HH:mm:ss")
    elif kind == "CHECKBOX":
        parsed = F.when(c != "", F.lit("true")).otherwise(F.lit("false"))
    elif kind in ("NUMBER", "CURRENCY", "PERCENT"):
        # the digits stay as they are: no type holds all of them
        parsed = F.when(F.trim(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(c))
    else:
        parsed = c
    return F.when(c.isNull(), None).otherwise(F.coalesce(parsed, c))


def fixed_field(raw: Column, kind: str, decimals: int | None = None, date_format: str = "yyyyMMdd") -> Column:
    """One fixed-width cell: blank is NULL, all-zero whole numbers and dates are NULL."""
    text = F.trim(raw)
    filled = text != ""
    if kind in ("INT", "LONG"):
        target = "int" if kind == "INT" else "bigint"
        return F.when(filled & ~text.rlike("^0+$"), int_text(text, target))
    if kind == "FLOAT" and decimals is not None:
        return F.when(filled, int_text(text).cast("double") / F.lit(float(10**decimals)))
    if kind == "FLOAT":
        return F.when(filled, float_text(text))
    if kind == "NAIVE_DATE":
        return F.when(filled & ~text.rlike("^0+$"), F.to_date(F.try_to_timestamp(text, F.lit(date_format))))
    return F.when(filled, text)


def fixed_field_bad(raw: Column, kind: str, decimals: int | None = None, date_format: str = "yyyyMMdd") -> Column:
    """True where a filled cell does not parse, which fails its whole file."""
    text = F.trim(raw)
    parsed = fixed_field(raw, kind, decimals, date_format)
    if kind == "STRING":
        return F.lit(False)
    empty = (text == "") if kind == "FLOAT" else text.rlike("^0*$")
    return ~empty & parsed.isNull()


def signed(value: Column, sign: Column) -> Column:
    return F.when(sign == "-", -value).otherwise(value)


def implied_cents(c: Column) -> Column:
    """Digits with two implied decimals: '+20921242' -> 209212.42, '' -> NULL, '000' -> 0."""
    return float_text(F.regexp_replace(F.trim(c), r"^\++", "")) / F.lit(100.0)


def binary_as_base64(c: Column) -> Column:
    """One unbroken line; Spark may wrap its base64 at 76 characters."""
    return F.translate(F.base64(c), "\r\n", "")


def binary_as_text(c: Column) -> Column:
    """UTF-8 text; malformed bytes become the replacement character."""
    return F.make_valid_utf8(c.cast("string"))


def logical_type(source: str, precision: int | None = None, scale: int | None = None) -> str:
    """Spark type name for a source type; unknown types become string."""
    name = source.strip().lower()
    if name in ("decimal", "numeric"):
        width = precision or 18
        return f"decimal({width},{min(scale or 0, width)})" if width <= 38 else "string"
    return LOGICAL_TYPES.get(name, "string")


def vector_text(c: Column) -> Column:
    """JSON list or bracketed comma list -> array<double>; one bad element makes it NULL."""
    inner = F.trim(F.regexp_replace(F.trim(c), r"^\[(.*)\]$", "$1"))
    parts = F.filter(F.split(inner, ","), lambda p: F.trim(p) != "")
    cleaned = F.transform(parts, lambda p: float_text(F.regexp_replace(F.trim(p), "^[\"']+|[\"']+$", "")))
    bad = F.exists(cleaned, lambda v: v.isNull())
    return F.when(c.isNull() | bad, None).otherwise(cleaned)


def plain_text(c: Column, kind: T.DataType) -> Column:
    """Text form of any scalar: decimals as digits, dates and timestamps as ISO."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(kind, T.BinaryType):
        return binary_as_base64(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
