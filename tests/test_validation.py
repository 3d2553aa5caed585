"""Strict CSV rows: 100 generated rows with one bad cell in each of seven."""

from tidemark.operators import quality as Q
from tidemark.sinks.merge import upsert

RULES = {
    "int_column": "int", "long_column": "int", "bool_column": "bool", "string_column": "string",
    "json_column": "json", "naive_date_column": "date", "naive_date_time_column": "timestamp",
}
BAD = {
    2: ("int_column", "304b"), 3: ("string_column", "  "), 5: ("long_column", "65442949415460829b"), 11: ("json_column", '{"a": 1 "b": 2}'),
    15: ("bool_column", "FALSE1"), 23: ("naive_date_column", "2014-04-DD"), 25: ("naive_date_time_column", "7/19/2016 12:39:TT"),
}
REPEATED = {60: 50, 61: 51, 62: 52}


def rows():
    for i in range(100):
        row = {
            "line": i, "int_column": str(600 + REPEATED.get(i, i)), "string_column": f"text {i}", "long_column": str(10**15 + i), "float_column": "not checked",
            "json_column": '{"k": [1, 2]}', "bool_column": ["true", "FALSE", "True"][i % 3], "naive_date_column": "2016-07-19",
            "naive_date_time_column": "2016-07-19 8:56:09" if i % 2 else "2016-07-19 18:56:09",
        }
        if i in BAD:
            column, value = BAD[i]
            row[column] = value
        yield row


def test_accept_reject(spark, tmp_path):
    spark.createDataFrame([tuple(r.values()) for r in rows()], list(next(rows()))).coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / "in"))
    landed = spark.read.csv(str(tmp_path / "in"), header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    good, bad = Q.split_valid(landed, RULES)
    assert (good.count(), bad.count()) == (93, 7)
    reasons = {int(r.line): r.reasons for r in bad.collect()}
    assert {k: len(v) for k, v in reasons.items()} == dict.fromkeys(BAD, 1)
    assert reasons[2] == ["Invalid int value in int_column: '304b'"]
    merged = upsert(good.limit(0), good, ["int_column"], ["line"])
    assert merged.count() == 90
    assert good.filter("naive_date_time_column = timestamp'2016-07-19 08:56:09'").count() > 40
