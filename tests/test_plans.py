"""Plan shapes that matter at scale."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering as O
from tidemark.operators.joins import in_windows
from tidemark.queries.registry import load_all
from tidemark.sources import bai2
from tidemark.sources.tables import Tables

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDTF")
USES_PYTHON = {"src07_zip_members", "src07_zip_archives", "enr01_budgeted_rows", "enr03_structured_answers", "enr04_consensus", "udf01_user_hooks", "udf01_line_udtf"}
# These run jobs while they are built; their shapes are covered by the operators' own tests.
EAGER = ("stm", "src", "snk", "sync")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details(df):
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", sorted(n for n in load_all() if not n.startswith(EAGER)))
def test_native_plans(name, spark, folder):
    text = plan(load_all()[name](spark, folder))
    if name not in USES_PYTHON:
        assert not any(p in text for p in PYTHON)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, folder):
    text = details(load_all()["fil01_static_predicate"](spark, folder))
    assert "GreaterThanOrEqual(l_quantity,45.0)" in text and "LessThanOrEqual(l_shipdate" in text
    assert "l_extendedprice" not in text and "l_tax" not in text


def test_compound_cursor_bound_is_pushed(spark, folder):
    assert "GreaterThanOrEqual(o_orderdate" in details(load_all()["inc03_compound_cursor"](spark, folder))


@pytest.mark.parametrize("name", ["win01_global_row_ids", "win01_row_ids_per_group", "win03_carry_forward", "inc15_offset_cursor", "srt02_deep_page", "src02_chunk_bounds"])
def test_ordered_scans_write_no_table_in_between(name, spark, folder, monkeypatch):
    monkeypatch.setattr(O, "PAGE_LIMIT", 10)
    text = plan(load_all()[name](spark, folder))
    assert "ExistingRDD" not in text.replace("Scan ExistingRDD[_part", "") and "rangepartitioning" not in text


def test_row_numbers_use_no_single_task_over_rows(spark, folder):
    rows = O.global_row_number(Tables(spark, folder).events.select("ts", "event_id"), ["ts", "event_id"])
    single = [line for line in plan(rows).splitlines() if "SinglePartition" in line]
    assert len(single) <= 1, "only the per-slice counts meet in one task"
    shuffles = [line for line in plan(rows).splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2, "the slices' counts, and the rows once"


def test_top_n_cuts_groups_before_the_shuffle(spark, folder):
    assert plan(load_all()["win05_top_per_parent"](spark, folder)).count("WindowGroupLimit") == 2


def test_dedupe_cuts_groups_before_the_shuffle(spark, folder):
    rows = O.keep_one(Tables(spark, folder).events, ["user_id"], ["ts", "event_id"], "last")
    assert plan(rows).count("WindowGroupLimit") == 2


def test_scans_shuffle_rows_once(spark, folder):
    """The summary join reuses the partitioning of the block window."""
    t = Tables(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = O.carry_forward(t.events, ["event_type"], ["ts"], F.date_trunc("day", "ts"), {"x": F.col("value")})
        shuffles = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(shuffles) == 4, "rows once; block summaries for their sum, their window and the join"


def test_a_busy_hour_is_joined_with_its_windows_in_many_tasks(spark):
    base = datetime.datetime(2024, 1, 1)
    rows = [(i, base + datetime.timedelta(seconds=i)) for i in range(3000)] + [(9000, None)]
    runs = [(j, base + datetime.timedelta(seconds=200 * j), base + datetime.timedelta(seconds=200 * j + 1000)) for j in range(10)]
    events = spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1)
    found = in_windows(events, "ts", spark.createDataFrame([*runs, (10, None, base)], "run int, gte timestamp, lt timestamp"), "hour")
    assert found.columns == ["id", "ts", "run", "gte", "lt"]
    got = found.select("id", "run", F.spark_partition_id()).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted((i, j) for i in range(3000) for j in range(10) if 200 * j <= i < 200 * j + 1000)
    assert len({r[2] for r in got}) >= 8


def test_lines_reach_the_table_function_in_many_tasks_and_as_they_are(spark, folder):
    text = plan(load_all()["udf01_line_udtf"](spark, folder))
    assert "ArrowEvalPythonUDTF" not in text and "BatchEvalPythonUDTF" in text
    assert "RoundRobinPartitioning" in text


def _tasks(df):
    return {int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan(df))}


def test_ordered_scans_get_more_tasks_when_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_TASK", 40)
    for rows in (100, 1000):
        pos = spark.range(rows).select(F.lit("a").alias("file"), "id", F.floor(F.col("id") / 20).alias("block"))
        tasks = {-(-rows // 40)}
        carried = O.carry_forward(pos, ["file"], ["id"], F.col("block"), {"x": F.when(F.col("id") % 50 == 3, F.col("id"))})
        assert _tasks(carried) == tasks
        assert {r["id"]: r["x"] for r in carried.collect()} == {i: None if i < 3 else (i - 3) // 50 * 50 + 3 for i in range(rows)}
        text = F.when(F.col("id") % 4 == 0, F.concat(F.lit("16,142,"), F.col("id").cast("string"), F.lit("/"))).otherwise(F.lit("88,MORE"))
        records = bai2.records(pos.select("file", "block", F.col("id").alias("seq"), text.alias("line")))
        assert _tasks(records) == tasks
        assert sorted((r["f"][1], len(r["continuations"])) for r in records.where("no > 0").collect()) == sorted((str(i), 3) for i in range(0, rows, 4))
