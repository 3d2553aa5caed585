"""Properties on random data, checked against plain Python."""

import itertools
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import changes as G, incremental as I, ordering as O
from tidemark.plans.sync import sync_table
from tidemark.session import small_side
from tidemark.sinks.merge import upsert
from tidemark.sinks.versioned import VersionedTable
from tidemark.spec import ReadPlan, TableSpec

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
logs = st.lists(st.tuples(st.integers(0, 4), st.sampled_from("IUDX"), st.integers(0, 99)), max_size=25)


def apply_in_order(target, log):
    state = dict(target)
    for key, op, value in log:
        if op in "IU":
            state[key] = value
        elif op == "D":
            state.pop(key, None)
    return state


@few
@given(logs, st.randoms())
def test_change_log_is_order_independent(spark, log, rnd):
    """Rows carry their position, so the input order does not matter."""
    target = [(i, -i) for i in range(3)]
    rows = [(k, op, v, seq // 3, seq) for seq, (k, op, v) in enumerate(log)]
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "key int, op string, value int, commit_seq int, intent_seq int")
    out = G.apply_log(spark.createDataFrame(target, "key int, value int"), frame, ["key"], ["commit_seq", "intent_seq"])
    assert {r.key: r.value for r in out.collect()} == apply_in_order(target, log)


@few
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=20))
def test_upsert_replay_changes_nothing(spark, batch):
    target = spark.createDataFrame([(i, 100 + i) for i in range(4)], "key int, value int")
    rows = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "key int, value int, seq int")
    once = upsert(target, rows, ["key"], ["seq"])
    twice = upsert(once, rows, ["key"], ["seq"])
    expected = {i: 100 + i for i in range(4)} | dict(batch)
    assert {r.key: r.value for r in once.collect()} == {r.key: r.value for r in twice.collect()} == expected


values = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 60), st.one_of(st.none(), st.integers(0, 9))), max_size=40, unique_by=lambda r: (r[0], r[1]))


@few
@given(values)
def test_ordered_scans(spark, rows):
    frame = spark.createDataFrame(rows, "g string, pos int, v int")
    block = F.floor(F.col("pos") / 7)
    carried = O.carry_forward(frame, ["g"], ["pos"], block, {"seen": F.col("v")})
    numbered = O.number_in_group(carried, ["g"], ["pos"], block, "n")
    got = {(r.g, r.pos): (r.seen, r.n) for r in numbered.collect()}
    expected = {}
    for g, group in itertools.groupby(sorted(rows, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        last = None
        for n, (_, pos, v) in enumerate(group, 1):
            last = v if v is not None else last
            expected[(g, pos)] = (last, n)
    assert got == expected


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("HCC")), max_size=40), st.integers(2, 9))
def test_records_are_gathered_across_blocks(spark, rows, width):
    frame = spark.createDataFrame([(g, i, k) for i, (g, k) in enumerate(rows)], "g string, pos int, kind string")
    out = O.gather_records(frame, ["g"], ["pos"], F.floor(F.col("pos") / width), F.col("kind") == "C", ["kind"])
    expected = []
    for group in "ab":
        for i, (g, k) in enumerate(rows):
            if g == group and k == "H":
                expected.append((g, [i]))
            elif g == group and expected and expected[-1][0] == g:
                expected[-1][1].append(i)
    assert sorted((r.g, [line.pos for line in r.lines]) for r in out.collect()) == expected


def test_range_blocks_split_a_hot_group(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    blocks = O.range_blocks(rows, ["g", "id"])
    sizes = [r["count"] for r in blocks.groupBy("_part").count().collect()]
    assert max(sizes) < 3.5 * 30_000 / len(sizes)
    assert blocks.filter("g = 'hot'").select("_part").distinct().count() > 1
    numbered = O.number_in_group(blocks, ["g"], ["id"], F.col("_part"))
    assert numbered.filter("g = 'hot'").agg(F.sum((F.col("row_no") != F.col("id") / 3 + 1).cast("int"))).first()[0] == 0


def test_blocks_follow_directions_and_nulls(spark):
    values = [None, float("nan"), -1.5, 0.0, 3.0, None, 7.25]
    frame = spark.createDataFrame([(values[i % 7], "xyz"[i % 3] if i % 5 else None, i) for i in range(500)], "v double, s string, i int")
    for order in (["v", "s", "i"], [F.desc("v"), F.asc_nulls_last("s"), F.desc("i")], [F.desc_nulls_first("s"), F.col("v").asc(), "i"], [F.expr("i % 10").desc(), "i"]):
        expected = [r.i for r in frame.orderBy(*order).collect()]
        numbered = {r.n: r.i for r in O.global_row_number(frame, order, "n").collect()}
        assert [numbered[n] for n in range(1, 501)] == expected
        part = {r.n: r.i for r in O.rows_between(frame, order, 120, 180, "n").collect()}
        assert part == {n: expected[n - 1] for n in range(120, 181)}
        assert O.rows_between(frame, order, 470, None, "n").count() == 31 and O.rows_between(frame, order, 600, 700, "n").count() == 0


@few
@given(st.lists(st.integers(-50, 50), max_size=60))
def test_global_numbers_and_totals(spark, items):
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(items)], "v int, i int")
    numbered = O.global_row_number(frame, ["v", "i"], "n")
    total = O.global_running_total(frame, ["v", "i"], F.col("v"), "s")
    order = sorted((v, i) for i, v in enumerate(items))
    sums = list(itertools.accumulate(v for v, _ in order))
    assert {(r.v, r.i): r.n for r in numbered.collect()} == {k: n for n, k in enumerate(order, 1)}
    assert {(r.v, r.i): r.s for r in total.collect()} == dict(zip(order, sums))


@few
@given(st.lists(st.integers(0, 50), max_size=20), st.one_of(st.none(), st.integers(0, 60)))
def test_cursor_never_moves_back(spark, seen, saved):
    frame = spark.createDataFrame([(v,) for v in seen], "ts int")
    known = [x for x in (*seen, saved) if x is not None]
    assert I.next_cursor(frame, "ts", saved).first().cursor == (max(known) if known else None)


@pytest.mark.parametrize("bounds", [(None,), (9, None), (3, 3, 14, None), (100, None)])
def test_any_batch_size_drains_to_the_same_table(spark, bounds):
    source = spark.createDataFrame([(i % 7, i, float(i)) for i in range(20)], "id int, mod int, v double")
    spec = TableSpec("t", ("id",), {"id": "bigint", "mod": "int", "v": "double"})
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="tidemark-") + "/t", ["id"], buckets=4)
    for high in bounds:
        state = sync_table(source, table, spec, ReadPlan("t", cursor="mod", high=high))
    assert state == {"t": {"cursor": "19"}} == table.state()
    assert {r.id: r.mod for r in table.read().collect()} == {i % 7: i for i in range(20)}


def test_versioned_table(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="tidemark-") + "/t", ["id"], buckets=8)
    table.replace(spark.createDataFrame([(i, "a") for i in range(40)], "id int, v string"), {"cursor": 1})
    first = table.manifest()
    change = spark.createDataFrame([(3, "b", False), (4, "c", True), (99, "n", False)], "id int, v string, gone boolean")
    assert table.merge(change, ["v"], deleted="gone", state={"cursor": 2}, batch=("w", 0))
    assert not table.merge(change.withColumn("v", F.lit("again")), ["v"], batch=("w", 0))
    assert table.merge(change.limit(0), ["v"], batch=("other", 0))
    rows = {r.id: r.v for r in table.read().collect()}
    assert rows == {i: "a" for i in range(40) if i != 4} | {3: "b", 99: "n"}
    second = table.manifest()
    kept = [b for b in first["buckets"] if second["buckets"].get(b) == first["buckets"][b]]
    assert len(kept) >= len(first["buckets"]) - 3, "untouched buckets are not written again"
    assert table.state() == {"cursor": 2}
    assert {r.id for r in table._read(first, range(8)).collect()} == set(range(40)), "old versions stay readable"


def test_expired_versions(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="tidemark-") + "/t", ["id"], buckets=2)
    table.replace(spark.createDataFrame([(i, 0) for i in range(20)], "id int, v int"))
    for n in range(1, 5):
        table.merge(spark.createDataFrame([(n, n)], "id int, v int"), ["v"])
    assert table.expire(keep=2) == 3
    assert {r.id: r.v for r in table.read().collect()} == {i: i if 1 <= i <= 4 else 0 for i in range(20)}
    assert table.expire(keep=2) == 0


def test_best_cursor(spark):
    columns = "id int, seen date, updated_on timestamp, modified_at timestamp, never date"
    frame = spark.createDataFrame([(1, None, None, None, None)], columns).union(
        spark.sql("select 2, date'2024-01-01', timestamp'2024-01-02', timestamp'2024-01-03', cast(null as date)")
    )
    assert I.best_cursor(frame) == "modified_at"
    assert I.best_cursor(frame.select("seen", "never")) == "seen"
    assert I.best_cursor(frame.select("never")) is None


def test_shrunk_container_spans(spark):
    frame = lambda rows: spark.createDataFrame(rows, "c string, row_count long")
    out = G.shrunk_rows(frame([("a", 250_001), ("b", 3), ("c", 2)]), frame([("a", 2), ("b", 3)]), ["c"])
    got = {r.c: (r.n, r.lo, r.hi) for r in out.groupBy("c").agg(F.count("row_no").alias("n"), F.min("row_no").alias("lo"), F.max("row_no").alias("hi")).collect()}
    assert got == {"a": (249_999, 3, 250_001), "c": (2, 1, 2)}
    assert out.distinct().count() == 250_001


def test_join_side_is_measured(spark):
    small = spark.range(10).withColumn("t", F.lit("x"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(small_side(small))
    assert not hinted(small_side(small, max_bytes=100))
