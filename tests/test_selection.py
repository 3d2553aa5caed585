"""Percentiles of intervals too large for one task, by counting, against sorted lists."""

import math
import random

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A


def expected(values, p):
    order = sorted(values, key=lambda v: (math.isnan(v), v) if isinstance(v, float) else (False, v))
    return order[-(-len(order) * p // 100) - 1] if order else None


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def shapes():
    rng = random.Random(11)
    nan, inf = float("nan"), float("inf")
    return {
        "spread": [rng.gauss(0, 1) for _ in range(3000)],
        "far": [10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(3000)],
        "two values": [1.0] * 1500 + [1.0000000000000002] * 1500,
        "equal": [7.5] * 2000,
        "edges": [nan] * 40 + [inf] * 900 + [-inf] * 900 + [0.0] * 100 + [5e-324] * 100,
        "ends": [-1.7e308] * 400 + [1.7e308] * 400 + [rng.random() for _ in range(400)],
        "few": [3.0, 1.0, 2.0],
        "none": [],
        None: [float(i % 997) for i in range(2500)],
    }


def test_percentiles_of_hot_intervals(spark, monkeypatch):
    monkeypatch.setattr(A, "SORTED_VALUES", 50)
    monkeypatch.setattr(A, "BINS", 64)
    groups = shapes()
    rows = [(g, v) for g, values in groups.items() for v in [*values, None]]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    narrow = A.interval_metrics(df.filter("abs(v) < 1e20 OR v IS NULL"), F.col("g"), "day", "v").collect()
    assert {r.day for r in narrow} == set(groups)
    for r in narrow:
        kept = [v for v in groups[r.day] if abs(v) < 1e20]
        assert r.n >= len(kept) and all(same(r[f"p{p}"], expected(kept, p)) for p in A.PERCENTILES), r.day
    found = {r["_name"]: r for r in A._selected(df.filter("v IS NOT NULL").select(F.col("g").alias("day"), F.col("v").alias("_v")),
             df.groupBy(F.col("g").alias("day")).agg(F.count("v").alias("_n")).filter("_n > 0"), "day").collect()}
    for g, values in groups.items():
        assert not values or all(same(found[g][f"p{p}"], expected(values, p)) for p in A.PERCENTILES), g


def test_large_integers(spark, monkeypatch):
    monkeypatch.setattr(A, "SORTED_VALUES", 5)
    values = [2**60 + i // 3 for i in range(60)]
    df = spark.createDataFrame([("d", v) for v in values], "day string, _v long")
    found = A._selected(df, spark.createDataFrame([("d", 60)], "day string, _n long"), "day").first()
    assert [found[f"p{p}"] for p in A.PERCENTILES] == [expected(values, p) for p in A.PERCENTILES]


def test_no_window_over_values(spark):
    df = spark.range(1000).select((F.col("id") % 5).cast("string").alias("g"), F.col("id").cast("double").alias("v"))
    plan = A.interval_metrics(df, F.col("g"), "day", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan.replace("SortAggregate", "").replace("sort_array", "")
