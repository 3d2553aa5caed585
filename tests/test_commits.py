"""Commits of one table and of several, with writers that interleave or die."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as G
from tidemark.sinks.snapshots import KeySnapshot
from tidemark.sinks.group import Output, TableGroup, fan_out
from tidemark.sinks.versioned import VersionedTable

OUTPUTS = {
    "orders": Output(lambda b: b.select("id", "name")),
    "notes": Output(lambda b: b.select("id", F.posexplode("notes").alias("no", "text")), parent=("id",)),
    "tags": Output(lambda b: b.select("id", F.explode("tags").alias("tag")).distinct(), parent=("id",)),
}
KEYS = {"orders": ["id"], "notes": ["id", "no"], "tags": ["id", "tag"]}
BATCH = "id long, name string, notes array<string>, tags array<string>"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_interleaved_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *r: spark.createDataFrame(list(r), "id long, v string")
    VersionedTable(spark, path, ["id"], 2).replace(frame((1, "first")))
    a, b = VersionedTable(spark, path, ["id"]), VersionedTable(spark, path, ["id"])
    base = a.manifest()
    ours, theirs = [{**base, "version": 2, "buckets": t._write(frame((k, n)), 2)} for t, k, n in ((a, 2, "a"), (b, 3, "b"))]
    first, second = a.journal.prepare(ours), b.journal.prepare(theirs)
    assert first != second
    a.journal.commit(first, 2)
    with pytest.raises(RuntimeError):
        b.journal.commit(second, 2)
    assert rows(a.read()) == rows(b.read()) == [(2, "a")]
    b.merge(frame((3, "b")), ["v"])
    assert rows(a.read()) == [(2, "a"), (3, "b")]


@pytest.mark.parametrize("apply", ["log", "feed", "tombstones"])
def test_replays_with_null_keys_add_no_copies(spark, apply):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    batch = spark.createDataFrame([(None, "new", "U", "update_postimage", False, 1), (2, "two", "I", "insert", False, 2), (3, "x", "D", "delete", True, 3)], "id long, v string, op string, _change_type string, gone boolean, _commit_version int")
    run = {
        "log": lambda t: G.apply_log(t, batch, ["id"], ["_commit_version"]),
        "feed": lambda t: G.apply_feed(t, batch, ["id"], deletes=True),
        "tombstones": lambda t: G.apply_tombstones(t, batch, ["id"], "gone", ["_commit_version"]),
    }[apply]
    once = run(target)
    assert rows(once) == rows(run(once)) == [(1, "a"), (2, "two"), (None, "new")]


def test_null_keys_do_not_vanish(spark):
    keys = spark.createDataFrame([(1,), (None,), (2,)], "id long")
    assert rows(G.vanished(keys, keys.filter("id IS NULL OR id = 1"), ["id"])) == [(2,)]


def test_fan_out_is_one_commit(spark, tmp_path):
    group = TableGroup(spark, str(tmp_path / "g"), KEYS, buckets=2)
    batch = lambda *r: spark.createDataFrame(list(r), BATCH)
    assert fan_out(group, batch((1, "one", ["x", "y"], ["a"]), (2, "two", [], ["a", "b"]), (None, "none", ["n"], [])), OUTPUTS, {"cursor": 1}, ("w", 0))
    assert not fan_out(group, batch((9, "replay", [], [])), OUTPUTS, batch=("w", 0))
    assert rows(group.read("notes")) == [(1, 0, "x"), (1, 1, "y"), (None, 0, "n")]
    # the parents of a batch lose what it no longer has; others keep theirs
    assert fan_out(group, batch((1, "ONE", ["z"], []), (3, "three", ["q"], ["c"]), (None, "none", [], [])), OUTPUTS, {"cursor": 2}, ("w", 1))
    orders, notes, tags = group.read("orders", "notes", "tags")
    assert rows(orders) == [(1, "ONE"), (2, "two"), (3, "three"), (None, "none")]
    assert rows(notes) == [(1, 0, "z"), (3, 0, "q")] and rows(tags) == [(2, "a"), (2, "b"), (3, "c")]
    assert group.state() == {"cursor": 2} and group.committed("w") == 1


def test_a_writer_that_dies_between_tables_changes_nothing(spark, tmp_path):
    group = TableGroup(spark, str(tmp_path / "g"), KEYS, buckets=2)
    first = spark.createDataFrame([(1, "one", ["x"], ["a"])], BATCH)
    second = spark.createDataFrame([(1, "ONE", ["y"], ["b"]), (2, "two", ["z"], [])], BATCH)
    fan_out(group, first, OUTPUTS)
    before = [rows(df) for df in group.read(*KEYS)]
    for dies in (1, 2):
        broken = dict(list(OUTPUTS.items())[:dies]) | {"tags": Output(lambda b: b.select("no such column"))}
        with pytest.raises(Exception):
            fan_out(group, second, broken, {"cursor": 5})
        assert [rows(df) for df in group.read(*KEYS)] == before and group.state() == {}
    fan_out(group, second, OUTPUTS)
    assert rows(group.read("orders")) == [(1, "ONE"), (2, "two")]
    # a record published meanwhile makes the later writer fail as a whole
    with pytest.raises(RuntimeError):
        with group.commit() as tables:
            fan_out(group, first, OUTPUTS)
            tables["orders"].merge(second.select("id", "name"), ["name"])
    assert rows(group.read("orders")) == [(1, "one"), (2, "two")]


def test_expired_records(spark, tmp_path):
    group = TableGroup(spark, str(tmp_path / "g"), KEYS, buckets=2)
    for n in range(5):
        fan_out(group, spark.createDataFrame([(1, f"v{n}", [f"{n}"], []), (n, "new", [], ["t"])], BATCH), OUTPUTS)
    now = [rows(df) for df in group.read(*KEYS)]
    assert group.expire(keep=2) == 3 and [rows(df) for df in group.read(*KEYS)] == now
    fan_out(group, spark.createDataFrame([(7, "x", [], [])], BATCH), OUTPUTS)
    assert group.read("orders").filter("id = 7").count() == 1


def test_snapshots_open_only_buckets_that_changed(spark, tmp_path):
    snapshot = KeySnapshot(spark, str(tmp_path / "k"), ["a", "b"], buckets=32)
    keys = lambda values: spark.createDataFrame([(v, str(v), 1) for v in values], "a long, b string, x int")
    first = [*range(2000), None]
    assert snapshot.advance(keys(first)) is None
    same = snapshot.advance(keys(first[::-1]))
    assert same.buckets == set() and rows(same.vanished) == rows(same.new) == []
    second = [v for v in first if v not in (5, 77)] + [9001]
    found = snapshot.advance(keys(second))
    assert rows(found.vanished) == [(5, "5"), (77, "77")] and rows(found.new) == [(9001, "9001")]
    assert 1 <= len(found.buckets) <= 3
    opened = {f.split("_bucket=")[1].split("/")[0] for f in found.vanished.inputFiles() if "_bucket=" in f}
    assert opened == {str(b) for b in found.buckets}
    # repeated keys touch their bucket and change nothing
    again = snapshot.advance(keys([*second, 9001, 9001]))
    assert len(again.buckets) == 1 and rows(again.vanished) == rows(again.new) == []
    gone = snapshot.advance(keys([]))
    assert gone.vanished.count() == len(second) and snapshot.advance(keys([1])).new.count() == 1
