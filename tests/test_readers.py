"""Delimited files, landed JSON documents and hooks: the cases that decide how a file is read."""

import gzip

import pyarrow as pa
import pytest

from tidemark.operators import hooks
from tidemark.sources import delimited, nested


@pytest.mark.parametrize("body, whole", [
    ('a,b\n1,"x, y"\n2,"say ""hi"""\n"",z\n', False),
    ('a,b\n1,"x\ny"\n2,z\n', True),
    ('a,b\n"1""\n",z\n', True),
    # two quotes in one line, of which the second opens a value that goes on
    ('a,b\nu"v,"x\ny"\n', True),
    ("a,b\n1,2\n", False),
])
def test_line_breaks_in_quoted_values_are_found(spark, tmp_path, body, whole):
    (tmp_path / "f.csv").write_text(body)
    assert delimited.breaks_lines(spark, str(tmp_path), ",") is whole
    read = lambda multi: sorted(map(str, delimited.read_with_header(spark, str(tmp_path), multi_line=multi).collect()))
    assert read(None) == read(True)


def test_headers_of_packed_long_and_empty_files(spark, tmp_path):
    wide = ";".join(f"column_{i}" for i in range(2000))
    (tmp_path / "wide.csv").write_text("\ufeff" + wide + "\r\n" + ";".join("x" * 2000))
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress((wide + "\n").encode()))
    (tmp_path / "empty.csv").write_text("")
    found = {r["path"].rsplit("/", 1)[1]: r["line"] for r in delimited.header_lines(spark, str(tmp_path)).collect()}
    assert found == {"wide.csv": wide, "packed.csv.gz": wide}
    assert delimited.sniff(spark, str(tmp_path)) == ";"
    (tmp_path / "other.csv").write_text("a|b|c")
    with pytest.raises(ValueError):
        delimited.sniff(spark, str(tmp_path))


def test_json_documents_with_lists_objects_and_neither(spark, tmp_path):
    for name, text in {"a": '{"data":\n [{"id": 1},\n {"id": 9007199254740993}]}', "b": '{"data": {"id": 3}}', "c": '{"data": []}', "d": "{}", "e": "no json"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = nested.read_json_documents(spark, str(tmp_path), "data", "id:bigint").collect()
    assert sorted((r["page"], r["id"]) for r in rows) == [("a.json", 1), ("a.json", 9007199254740993), ("b.json", 3)]


def test_hooks_keep_nulls_and_whole_numbers(spark):
    df = spark.createDataFrame([(9007199254740993, None), (None, "x")], "n long, s string")
    same = hooks.apply_hook(df, lambda r: [r, {"s": "more"}], "n long, s string")
    assert sorted(map(tuple, same.collect()), key=str) == sorted([(9007199254740993, None), (None, "x"), (None, "more"), (None, "more")], key=str)
    assert hooks.apply_hook(df, lambda r: [], "n long").collect() == []
    assert hooks.apply_batch_hook(df, lambda b: None, "n long").collect() == []
    counted = hooks.apply_batch_hook(df, lambda b: pa.table({"x": [0], "rows": [b.num_rows]}), "rows int")
    assert sum(r["rows"] for r in counted.collect()) == 2
