"""File formats from hand-written files."""

import datetime
import gzip
import io
import os
import zipfile

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.sources import archive, bai2, delimited, discovery, fixed_width, lines, nested


def write(folder, name, content):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode("utf-8"))
    return path


BANK = """01,BANKX,CUSTX,240115,0930,1,80,1,2/
02,CUSTX,ORIG1,1,240114,2359,USD,2/
03,ACC1,,010,+20921242,,,015,000,,/
88,015,500,,,040,-5000,,/
16,142,150000,S,100,200,,REF1,CREF1,Opening text/
88,Cust ID: 77 Desc: PAYROLL RUN Comp Name: ACME

88,SEC: PPD Cust Name: JO DOE Date: 01-02-24 Time: 10:30 AM
88,-
16,475,2500,V,240115,1200,REF2,,/
16,999,12,0,,,/
49,0,5/
02,CUSTX,ORIG2,1,240115,2359,EUR,2/
16,399,100,Z,REF3,,late/
03,ACC2,GBP,010,1,,/
16,400,,D,1,2,,,/
98,0,1,2/
99,0,1,9/
"""


def bank_rows(spark, path):
    rows = bai2.wide_balances(bai2.transactions(lines.read_lines(spark, path)), ["010", "015", "040"])
    return rows.orderBy("block", "seq").collect()


def test_bank_report(spark, tmp_path):
    write(tmp_path, "a.bai", BANK)
    rows = bank_rows(spark, str(tmp_path))
    first = rows[0]
    assert len(rows) == 5
    assert (first.sender_id, first.receiver_id, first.file_date) == ("BANKX", "CUSTX", datetime.date(2024, 1, 15))
    assert (first.bank_account_number, first.currency, first.originator_id) == ("ACC1", "USD", "ORIG1")
    assert (first.balance_010, first.balance_015, first.balance_040) == (209212.42, 5.0, -50.0)
    assert (first.amount, first.debit_credit_mark, first.funds_type) == (1500.0, "C", "S")
    assert (first.same_day_amount, first.one_day_amount, first.two_plus_day_amount) == (1.0, 2.0, None)
    assert (first.bank_reference, first.customer_reference) == ("REF1", "CREF1")
    assert first.description.startswith("Opening text Cust ID: 77")
    assert (first.ach_cust_id, first.ach_description, first.ach_comp_name) == ("77", "PAYROLL RUN", "ACME")
    assert (first.ach_sec_code, first.ach_cust_name, first.ach_tran_date, first.ach_tran_time) == ("PPD", "JO DOE", "01-02-24", "10:30 AM")
    assert (rows[1].bank_reference, rows[1].customer_reference, rows[1].description, rows[1].debit_credit_mark) == ("REF2", None, None, "D")
    assert rows[2].debit_credit_mark is None
    # A new group keeps the account, and the account keeps the currency it was opened with.
    assert (rows[3].bank_account_number, rows[3].currency, rows[3].originator_id, rows[3].balance_010) == ("ACC1", "USD", "ORIG2", 209212.42)
    assert (rows[4].bank_account_number, rows[4].currency, rows[4].amount, rows[4].debit_credit_mark) == ("ACC2", "GBP", None, "D")


def test_bank_report_split_into_blocks(spark, tmp_path):
    """A file cut into many splits gives the same rows as one read whole."""
    body = "".join(f"03,ACC{i},USD,010,{i},,/\n16,142,{i},0,R{i},,/\n88,Cust ID: {i}\n" for i in range(300))
    write(tmp_path, "big.bai", "01,S,R,240115,0930/\n02,S,O,1,240114,2359,EUR/\n" + body)
    key = lambda r: (r.bank_reference, r.bank_account_number, r.balance_010, r.ach_cust_id, r.sender_id, r.originator_id)
    whole = {key(r) for r in bank_rows(spark, str(tmp_path))}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert lines.read_lines(spark, str(tmp_path)).select("block").distinct().count() > 10
        assert {key(r) for r in bank_rows(spark, str(tmp_path))} == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert whole == {(f"R{i}", f"ACC{i}", i / 100, str(i), "S", "O") for i in range(300)}


FIELDS = [
    fixed_width.FixedField("id", 1, 4, "LONG"),
    fixed_width.FixedField("name", 5, 6),
    fixed_width.FixedField("amount", 11, 6, "FLOAT", 2),
    fixed_width.FixedField("day", 17, 8, "NAIVE_DATE", None, "MMddyyyy"),
]


def test_fixed_width_cp1252(spark, tmp_path):
    body = ["HDR", "0001Zoë € 00012301022024", "0000      00000000000000", "", "  12plain       12312023", "TRL 00000005", "  "]
    write(tmp_path, "x.txt", "\r\n".join(body).encode("cp1252"))
    rows = fixed_width.parse(lines.read_lines(spark, str(tmp_path), "cp1252"), FIELDS).orderBy(F.col("id").asc_nulls_first()).collect()
    assert [(r.id, r.name, r.amount, str(r.day), r.malformed) for r in rows] == [
        (None, None, 0.0, "None", False),
        (1, "Zoë €", 1.23, "2024-01-02", False),
        (12, "plain", None, "2023-12-31", False),
    ]


def test_malformed_line_fails_its_file_only(spark, tmp_path):
    write(tmp_path, "good.txt", "H\n0001abc   00010001022024\nT\n")
    write(tmp_path, "bad.txt", "H\n0002abc   00010001022024\n00x3abc   00010001022024\nT\n")
    rows = fixed_width.parse(lines.read_lines(spark, str(tmp_path)), FIELDS)
    good, failed = Q.whole_files(rows, "file", F.col("malformed"))
    assert [(r.file, r.id) for r in good.collect()] == [("good.txt", 1)]
    assert [(r.file, r.bad_lines) for r in failed.collect()] == [("bad.txt", 1)]


def test_trailer_counts(spark, tmp_path):
    write(tmp_path, "ok.txt", "H\na\nb\nT 04\n")
    write(tmp_path, "off.txt", "H\na\nb\nT 05\n")
    write(tmp_path, "short.txt", "H\nT 02\n")
    write(tmp_path, "text.txt", "H\na\nT xx\n")
    read = lines.read_lines(spark, str(tmp_path))
    status = lambda inc: {r.file: r.status for r in Q.trailer_check(read, "file", ["block", "seq"], 3, 2, inc).collect()}
    assert status(True) == {"ok.txt": "ok", "off.txt": "count_mismatch", "short.txt": "too_short", "text.txt": "bad_trailer"}
    assert status(False)["ok.txt"] == "count_mismatch"


def test_header_csv(spark, tmp_path):
    write(tmp_path, "a.csv", "﻿Name;;Age;\nAnn;x;3;\nBob;y;;\n")
    df = delimited.read_with_header(spark, str(tmp_path))
    assert df.columns == ["Name", "Age"]
    assert sorted(map(tuple, df.collect())) == [("Ann", "3"), ("Bob", None)]


def test_sniffer(spark, tmp_path):
    for name, text in (("c", "a,b,c;d"), ("t", "a\tb"), ("p", "a|b|c,d"), ("one", "abc")):
        write(tmp_path, f"{name}/f.csv", text + "\n")
    assert [delimited.sniff(spark, str(tmp_path / n)) for n in ("c", "t", "p", "one")] == [",", "\t", "|", ","]


def test_layout_tsv(spark, tmp_path):
    write(tmp_path, "a.txt", "1\tx\ty\n2\tz\n")
    rows = delimited.read_layout(spark, str(tmp_path), ["id", "a", "b"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "x", "y"), ("2", "z", None)]


def test_archives(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        out.writestr("12-ab_Call Notes.csv", "id,text\n1,\"a, b\"\n2,c\n")
        out.writestr("Other.csv", "id\n9\n")
    write(tmp_path, "z/x.zip", buffer.getvalue())
    read = archive.zip_lines(spark, str(tmp_path / "z"))
    assert {r.table_name for r in read.collect()} == {"call notes", "other"}
    rows = archive.csv_members(read, "call notes", "id int, text string").orderBy("id").collect()
    assert [(r.id, r.text) for r in rows] == [(1, "a, b"), (2, "c")]
    write(tmp_path, "g/7f-1_Contacts.csv.gz", gzip.compress(b"id,name\n5,eve\n"))
    row = archive.gz_csv(spark, str(tmp_path / "g"), "id int, name string").first()
    assert (row.id, row.name, row.table_name) == (5, "eve", "contacts")


def test_json_and_xml(spark, tmp_path):
    write(tmp_path, "j/p.json", '{\n "total": 2,\n "data": [{"id": 1}, {"id": 2, "n": "x"}]\n}')
    rows = nested.read_json_pages(spark, str(tmp_path / "j"), "data array<struct<id: int, n: string>>", "data").collect()
    assert sorted((r.id, r.n or "") for r in rows) == [(1, ""), (2, "x")]
    write(tmp_path, "x/p.xml", "<list><row><a>1</a><b/></row><row><a>2</a><b>t</b></row></list>")
    rows = nested.read_xml_rows(spark, str(tmp_path / "x"), "row", "a string, b string").collect()
    assert sorted(map(tuple, rows)) == [("1", ""), ("2", "t")]


def test_discovery(spark, tmp_path):
    for i, name in enumerate(["r_1.csv", "r_2.csv", "r_3.csv", "skip.txt"]):
        os.utime(write(tmp_path, name, "x"), (1_700_000_000 + (10 - i) * 60,) * 2)
    files = discovery.listing(spark, str(tmp_path), r"^r_\d\.csv$")
    assert discovery.newest_file(files).first().name == "r_1.csv"
    done = spark.createDataFrame([("r_2.csv",)], "name string")
    assert [r.name for r in discovery.unseen_files(files, done).collect()] == ["r_1.csv", "r_3.csv"]


def test_line_order(spark, tmp_path):
    write(tmp_path, "a.txt", "\n".join(f"line {i}" for i in range(1000)))
    rows = lines.read_lines(spark, str(tmp_path)).orderBy("block", "seq").collect()
    assert [r.line for r in rows] == [f"line {i}" for i in range(1000)]


def test_members_go_by_header_names(spark, tmp_path):
    import pytest

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        out.writestr("12-ab_People.csv", "﻿name, id\n\"a\nb\",7\n\nc,x\n")
        out.writestr("12-cd_People.csv", "id,other,name\n8,1,\n")
        out.writestr("12-ef_Empty.csv", "")
    write(tmp_path, "z/x.zip", buffer.getvalue())
    rows = archive.named_members(archive.zip_records(spark, str(tmp_path / "z")), "people", {"key": ("id", "int"), "name": ("name", "string")})
    assert sorted([(r.key, r.name) for r in rows.collect()], key=str) == [(7, "a\nb"), (8, None), (None, "c")]
    write(tmp_path, "g/7f-1_Contacts.csv.gz", gzip.compress(b"name,id\neve,5\n"))
    with pytest.raises(Exception):
        archive.gz_csv(spark, str(tmp_path / "g"), "id int, name string").collect()


def test_each_zip_member_is_a_partition(spark, tmp_path, monkeypatch):
    """Members of one archive are read by tasks of their own, longer ones in several batches; empty folders give no rows."""
    for name, sizes in (("a", (25_001, 3)), ("deep/b", (0, 1))):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
            out.writestr("sub/", "")
            for i, n in enumerate(sizes):
                out.writestr("sub/People.csv", "\ufeffid,name\r\n" + "".join(f'{k},"n\n{i}"\r\n' for k in range(n)))
        write(tmp_path, f"z/{name}.zip", buffer.getvalue())
    for folder in (str(tmp_path / "z"), f"file://{tmp_path}/z"):
        found = archive.zip_records(spark, folder)
        assert found.rdd.getNumPartitions() == 4
        counts = found.groupBy("archive", "table_name").agg(F.count("*").alias("n"), F.max("record_no").alias("last")).collect()
        assert sorted(tuple(r) for r in counts) == [("a.zip", "sub/people", 25_004, 25_001), ("b.zip", "sub/people", 1, 1)]
        rows = archive.named_members(found, "sub/people", {"id": ("id", "int"), "name": ("name", "string")})
        assert rows.filter("name = 'n\n0'").count() == 25_001 and rows.agg(F.max("id")).first()[0] == 25_000
    (tmp_path / "none").mkdir()
    assert archive.zip_lines(spark, str(tmp_path / "none")).collect() == []
    plan = archive.zip_records(spark, str(tmp_path / "z"))._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan
