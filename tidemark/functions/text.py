"""String functions: narrative mining, joining, cleaning, JSON in prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coercion import binary_as_base64

# The labels of a payment narrative, by the column that takes what follows.
NARRATIVE_LABELS = {
    "ach_cust_id": "Cust ID",
    "ach_description": "Desc",
    "ach_comp_name": "Comp Name",
    "ach_comp_id": "Comp ID",
    "ach_batch_discr": "Batch Discr",
    "ach_sec_code": "SEC",
    "ach_cust_name": "Cust Name",
    "ach_tran_date": "Date",
    "ach_tran_time": "Time",
    "ach_addenda": "Addenda",
}
_ANY_LABEL = r"(?i)\b(" + "|".join(r"\s+".join(label.split()) for label in NARRATIVE_LABELS.values()) + "):"


def _first_word(c: Column) -> Column:
    return F.regexp_substr(c, F.lit(r"^\S+"))


#: How a piece gives its value where it is not the whole piece.
_PIECE_RULES = {
    "ach_cust_id": _first_word,
    "ach_comp_id": _first_word,
    "ach_sec_code": _first_word,
    "ach_tran_date": lambda c: F.regexp_substr(c, F.lit(r"^\d\d-\d\d-\d\d")),
    "ach_tran_time": lambda c: F.regexp_substr(c, F.lit(r"^\d\d:\d\d\s*[AaPp][Mm]")),
    "ach_addenda": lambda c: F.rtrim(F.substring_index(c, "\n", 1)),
}
_RELEASE = r"[0-9]+(?:\.[0-9]+)*"
FIXED_VERSION = rf"(?i)\bfixed in(?: version)? +({_RELEASE}(?: (?:and|or) {_RELEASE})*)"


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, trimmed; no match is NULL."""
    found = F.trim(F.regexp_extract(c, pattern, group))
    return F.when(found != "", found)


def narrative_fields(df: DataFrame, column: str) -> DataFrame:
    """`df` with one column for each label of a narrative, which is cut once at every label in any case: the value is the
    piece up to the next label, or its first word, date, time or line. Of a repeated label the first piece that has a
    value counts; without one it is NULL."""
    text = F.col(column)
    labels = F.transform(F.regexp_extract_all(text, F.lit(_ANY_LABEL), F.lit(1)), lambda x: F.lower(F.regexp_replace(x, r"\s+", " ")))
    pieces = F.split(text, _ANY_LABEL, -1)
    # the first piece stands before any label
    pairs = F.zip_with(labels, F.slice(pieces, F.lit(2), F.size(pieces) - 1), lambda x, p: F.struct(x.alias("label"), F.trim(F.regexp_replace(p, r"^\s+|\s+$", "")).alias("piece")))
    cut = df.withColumn("_pairs", pairs)

    def value(name: str, label: str) -> Column:
        rule = _PIECE_RULES.get(name, lambda c: c)
        mine = F.transform(F.filter("_pairs", lambda p: p["label"] == label.lower()), lambda p: F.nullif(rule(p["piece"]), F.lit("")))
        return F.get(F.filter(mine, lambda v: v.isNotNull()), F.lit(0)).alias(name)

    return cut.select(*df.columns, *[value(name, label) for name, label in NARRATIVE_LABELS.items()])


def fixed_version(c: Column) -> Column:
    """The release, or releases joined by and/or, that a notice names as fixed."""
    return extract(c, FIXED_VERSION)


def distinct_matches(c: Column, pattern: str) -> Column:
    """All matches of the whole pattern, each once, sorted."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))))


def section(c: Column, start: str, end: str | None, default: str, window: int | None = None, cap: int | None = None) -> Column:
    """Text after one heading up to the next (any case), or to the end; `window` characters if the next is missing and
    at most `cap` in all, where the caller sets them.

    Sections of ten characters or fewer fall back to the default.
    """
    upper = F.upper(c)
    at = F.locate(start, upper)
    begin = at + F.lit(len(start))
    if end is None:
        length = F.length(c) if window is None else F.lit(window)
    else:
        stop = F.locate(end, F.substr(upper, begin))
        length = F.when(stop > 0, stop - 1).otherwise(F.length(c) if window is None else F.lit(window))
    body = F.regexp_replace(F.substr(c, begin, length), r"^\s+|\s+$", "")
    return F.when((at > 0) & (F.length(body) > 10), body if cap is None else F.substring(body, 1, cap)).otherwise(F.lit(default))


def truncate_marked(c: Column, max_chars: int, marker: str = "... [truncated]") -> Column:
    cut = F.concat(F.substring(c, 1, max_chars), F.lit(marker))
    return F.when(F.length(c) > max_chars, cut).otherwise(F.coalesce(c, F.lit("")))


def join_values(arr: Column, separator: str = ",") -> Column:
    """Delimited text of the non-null elements; nothing left is NULL."""
    kept = F.filter(arr.cast("array<string>"), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.concat_ws(separator, kept))


def join_names(arr: Column, separator: str = "; ", first: str = "name", second: str = "raw_name") -> Column:
    """Join one field of an array of structs, falling back to a second field when blank."""
    names = F.transform(arr, lambda a: F.coalesce(F.nullif(a[first], F.lit("")), F.nullif(a[second], F.lit(""))))
    return join_values(names, separator)


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer values are left whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def slug(c: Column) -> Column:
    """Lower case, blanks and slashes to '_', other punctuation removed."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[ /]", "_"), r"[^\p{L}\p{N}_]", "")


def without_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1_000_000_000)).otherwise(c)


def table_name_of(file_name: Column) -> Column:
    """Target table from an export file name, dropping extensions and a UUID prefix."""
    base = F.regexp_replace(file_name, r"\.csv|\.gz|\.zip", "")
    head = F.substring_index(base, "_", 1)
    rest = F.regexp_replace(base, r"^[^_]*_", "")
    prefixed = base.contains("_") & head.contains("-")
    return F.when(prefixed, F.lower(rest)).otherwise(F.regexp_replace(F.lower(base), " ", "_"))


def is_placeholder(c: Column) -> Column:
    return c.isNull() | (c == "") | (c.startswith("<") & c.endswith(">"))


def json_in_prose(c: Column) -> Column:
    """Text from the first '{' to the last '}' when it is valid JSON, else NULL."""
    found = extract(c, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def json_fields(c: Column, schema: str) -> Column:
    return F.from_json(json_in_prose(c), schema)


def decode_payload(payload: Column) -> dict[str, Column]:
    """Message bytes: JSON text, else raw text, else base64 of bytes that are not UTF-8."""
    text = payload.cast("string")
    readable = F.is_valid_utf8(text)
    parsed = readable & F.try_parse_json(F.when(readable, text)).isNotNull()
    return {
        "json": F.when(parsed, text),
        "raw_data": F.when(readable & ~F.coalesce(parsed, F.lit(False)), text),
        "raw_data_base64": F.when(~readable, binary_as_base64(payload)),
    }


def decode_cp1252(c: Column) -> Column:
    """Bytes of a Windows-1252 file as text: Latin-1 plus the 0x80-0x9F block."""
    block = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    block = [(low, high) for low, high in block if high]
    latin = F.decode(c.cast("binary"), "ISO-8859-1")
    return F.translate(latin, "".join(p[0] for p in block), "".join(p[1] for p in block))
