"""Whole flows over several runs."""

from pyspark.sql import functions as F

from tidemark.plans.files import FileSpec, file_tables, sync_files
from tidemark.sources import discovery
from tidemark.sinks.versioned import VersionedTable
from tidemark.sources.fixed_width import FixedField
from tidemark.sources.tables import chunk_bounds, chunk_predicates

FIELDS = (FixedField("id", 1, 4, "LONG"), FixedField("name", 5, 6), FixedField("day", 11, 8, "NAIVE_DATE"))


def put(folder, name, *rows, count=None):
    lines = ["HDR", *rows, f"TRL{count if count is not None else len(rows) + 2:05d}"]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="cp1252")


def contents(group):
    return {r.id: r.name for r in group.read("cards").collect()}


def load(spark, folder, group, spec):
    return {r.file.split("/")[-1]: r.status for r in sync_files(spark, str(folder), group, "cards", spec).collect()}


def test_incremental_files(spark, tmp_path):
    spec = FileSpec(FIELDS, r"\.txt$", 4, 5)
    group = file_tables(spark, str(tmp_path / "t"), "cards", ["id"], buckets=4)
    landing = tmp_path / "in"
    put(landing, "a.txt", "0001Zoë   20240101", "0002bob   20240101")
    put(landing, "b.txt", "0002rob   20240102", count=9)
    put(landing, "c.txt", "0003ann   20240102", "0004x     2024XX02")
    assert load(spark, landing, group, spec) == {"a.txt": "ok", "b.txt": "count_mismatch", "c.txt": "malformed"}
    assert contents(group) == {1: "Zoë", 2: "bob"}
    put(landing, "b.txt", "0002rob   20240102")
    put(landing, "c.txt", "0003ann   20240102")
    assert load(spark, landing, group, spec) == {"b.txt": "ok", "c.txt": "ok"}
    assert contents(group) == {1: "Zoë", 2: "rob", 3: "ann"}
    assert load(spark, landing, group, spec) == {}


def test_a_backlog_is_loaded_in_batches_and_leaves_records_of_one_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(discovery, "FILES_AT_ONCE", 2)
    spec = FileSpec(FIELDS, r"\.txt$", 4, 5)
    group = file_tables(spark, str(tmp_path / "t"), "cards", ["id"], buckets=1)
    sizes = []
    for run in range(3):
        for k in range(5):
            put(tmp_path / "in", f"r{run}-{k}.txt", f"{k + 1:04d}n{run}    20240101", count=9 if k == 3 else None)
        status = load(spark, tmp_path / "in", group, spec)
        assert len(status) == 5 + run and [k for k, v in status.items() if v != "ok"] == [f"r{r}-3.txt" for r in range(run + 1)]
        sizes.append(len(str(group.records.latest())) + len(str(group._table("files", group.records.latest()).manifest())))
    assert contents(group) == {k: "n2" for k in (1, 2, 3, 5)} and group.read("files").count() == 12
    assert max(sizes) - min(sizes) < 20


def test_full_feed_marks_deletions(spark, tmp_path):
    spec = FileSpec(FIELDS, r"\.txt$", 4, 5, purge=True)
    group = file_tables(spark, str(tmp_path / "t"), "cards", ["id"], buckets=4)
    put(tmp_path / "one", "a.txt", "0001ann   20240101", "0002bob   20240101")
    put(tmp_path / "two", "a.txt", "0001ann   20240101", "0003eve   00000000")
    put(tmp_path / "gap", "a.txt", "0003eve   20240101")
    put(tmp_path / "gap", "b.txt", "0001ann   20240101", count=77)
    for run in ("one", "two", "gap"):
        load(spark, tmp_path / run, group, spec)
    rows = {r.id: (r.name, r.purge_indicator) for r in group.read("cards").collect()}
    assert rows == {1: ("ann", False), 2: (None, True), 3: ("eve", False)}


def test_chunk_predicates_cover_every_row_once(spark):
    rows = spark.createDataFrame([(k,) for k in [1, 1, 2, 5, 5, 5, 5, 8, 9, 12, 12, 13]], "k int")
    clauses = chunk_predicates(chunk_bounds(rows, "k", 3), "k")
    assert len(clauses) > 2
    assert [rows.filter(" + ".join(f"int({c})" for c in clauses) + " = 1").count()] == [12]
    assert [c for c in clauses if "<=" not in c] == [clauses[-1]]


def test_chunk_predicates_keep_null_keys_and_quote_values(spark):
    import datetime

    from tidemark.sources.tables import sql_literal

    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (None,), (None,), (9,)], "k int")
    for size in (2, 5, 100):
        clauses = chunk_predicates(chunk_bounds(rows, "k", size), "k")
        assert sum(rows.filter(c).count() for c in clauses) == 8
    assert sql_literal("o'k") == "'o''k'" and sql_literal(datetime.datetime(2024, 1, 2)) == "TIMESTAMP '2024-01-02 00:00:00'"


def test_versioned_table_keeps_winner_buckets_columns_and_null_keys(spark, tmp_path):
    import pytest

    from tidemark.sinks.versioned import VersionedTable

    rows = spark.createDataFrame([(i, "one") for i in range(40)] + [(None, "one")], "k int, v string")
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    table.replace(rows)
    loser = table._write(rows.withColumn("v", rows.k.cast("string")), 1)
    assert table.read().select("v").distinct().collect()[0][0] == "one" and set(loser.values()).isdisjoint(table.manifest()["buckets"].values())
    assert VersionedTable(spark, str(tmp_path / "t"), ["k"], buckets=3).read().count() == 41
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path / "t"), ["v"])
    batch = spark.createDataFrame([(None, "two", 1), (5, "two", 2)], "k int, v string, extra int")
    for _ in range(2):
        table.merge(batch, ["v"])
    got = table.read()
    assert got.columns == ["k", "v", "extra"] and got.count() == 41 and got.filter("extra IS NOT NULL").count() == 2


def test_budget_keeps_null_and_tied_keys(spark):
    from tidemark.operators.enrich import within_budget

    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e"), (None, "f"), (1, "c")], "k int, v string")
    for budget in (0, 1, 2, 3, 4, 5, 9):
        inside, outside = within_budget(df, "k", budget)
        assert inside.count() == min(budget, 5) and inside.count() + outside.count() == 7


def test_a_large_budget_is_cut_in_one_slice(spark, monkeypatch):
    from tidemark.operators import enrich, ordering

    monkeypatch.setattr(ordering, "PAGE_LIMIT", 10)
    df = spark.range(500).selectExpr("CASE WHEN id % 50 > 0 THEN id % 7 END AS k", "id % 90 AS v")
    for budget in (11, 200, 489, 490, 600):
        inside, outside = enrich.within_budget(df, "k", budget)
        assert inside.count() == min(budget, 490) and inside.count() + outside.count() == 500
        rest = outside.agg({"k": "min"}).first()[0]
        assert rest is None or inside.agg({"k": "max"}).first()[0] <= rest


def test_changes_in_any_order_keep_the_newest(spark, tmp_path):
    from itertools import permutations

    from tidemark.streaming.streams import apply_changes_into

    log = [("U", 10, 2), ("U", 20, 5), ("D", None, 7)]
    for turn, batches in enumerate(permutations([log[:1], log[1:2], log[2:]])):
        for last, wanted in ((3, []), (2, [(1, 20)])):
            table = VersionedTable(spark, str(tmp_path / f"t{turn}{last}"), ["k"], buckets=2)
            table.replace(spark.createDataFrame([(1, 0), (None, 4)], "k int, v int"))
            write = apply_changes_into(table, ["at"], "log")
            for number, batch in enumerate(batches):
                rows = [(1, op, v, at) for op, v, at in batch if last == 3 or op != "D"]
                write(spark.createDataFrame(rows, "k int, op string, v int, at int"), number)
            assert table.read().columns == ["k", "v"]
            assert sorted(tuple(r) for r in table.read().filter("k = 1").collect()) == wanted
            assert table.read().count() == len(wanted) + 1


def test_last_line_of_a_file_wins_and_splits_may_change(spark, tmp_path):
    from tidemark.sources.lines import detail_lines, read_lines

    spec = FileSpec(FIELDS, r"\.txt$", 4, 5)
    group = file_tables(spark, str(tmp_path / "t"), "cards", ["id"], buckets=4)
    put(tmp_path / "in", "a.txt", *[f"0001v{i:05d}20240101" for i in range(200)])
    load(spark, tmp_path / "in", group, spec)
    assert contents(group) == {1: "v00199"}
    put(tmp_path / "in", "b.txt", "0001b1    20240101", "0001b2    20240101")
    load(spark, tmp_path / "in", group, spec)
    assert contents(group) == {1: "b2"} and group.read("cards").columns == ["id", "name", "day"]
    put(tmp_path / "big", "c.txt", *[f"{i:04d}" for i in range(3000)])
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    spark.conf.set(keys[1], "1")
    try:
        spark.conf.set(keys[0], "3")
        details = detail_lines(read_lines(spark, str(tmp_path / "big")))
        spark.conf.set(keys[0], "17")
        assert details.count() == 3000
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_hours_that_were_empty_are_drifted_and_verified(spark):
    from tidemark.operators.changes import drifted_hours, repair_status

    hour = lambda h: F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp")
    kind = "entity string, h int, record_count long, is_partial boolean"
    counts = lambda rows: spark.createDataFrame(rows, kind).withColumn("hour_start", F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0))).drop("h")
    now = counts([("a", 1, 5, False), ("a", 2, 2, False), ("b", 2, 1, False), ("a", 4, 9, False), ("a", 5, 9, True)])
    before = counts([("a", 1, 5, False), ("a", 4, 3, True)])
    drifted = drifted_hours(now, before, hour(1), hour(4))
    assert sorted((r.entity, r.hour_start.hour, r.prev_count) for r in drifted.collect()) == [("a", 2, 0), ("b", 2, 0)]
    status = repair_status(drifted, counts([("a", 2, 2, False)]))
    assert {r.entity: (r.target_count, r.status) for r in status.collect()} == {"a": (2, "verified"), "b": (0, "unverified")}


def test_top_n_of_any_size_and_zone_names(spark):
    from tidemark.functions.dates import _zone_names, local_to_utc
    from tidemark.operators.ordering import top_n_per

    rows = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    top = top_n_per(rows, ["k"], [F.desc("id")], 1500)
    assert top.count() == 3000 and top.agg(F.min("id")).first()[0] == 2000
    zones = spark.createDataFrame([(z,) for z in _zone_names()] + [("Nowhere",)], "z string")
    utc = {r.z: str(r.u) for r in zones.select("z", local_to_utc(F.lit("2024-01-15 12:00:00").cast("timestamp"), F.col("z")).alias("u")).collect()}
    assert (utc["Japan"], utc["EST"], utc["Nowhere"]) == ("2024-01-15 03:00:00", "2024-01-15 17:00:00", "2024-01-15 12:00:00")
