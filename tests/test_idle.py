"""Keyed state with a time-out: spans, late rows and what stays in the state."""

import datetime

import numpy as np
import pandas as pd

from tidemark.streaming import streams as ST
from tidemark.streaming.idle import _Spans, idle_keys, keyed_state, merge_spans

SCHEMA = "id long, user long, ts timestamp"
at = lambda hour, minute=0: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour, minutes=minute)


def run(spark, base, lots):
    """Each lot is landed and drained by a run of its own; state goes on through the checkpoint."""
    for lot in lots:
        spark.createDataFrame(lot, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/topic")
        out = idle_keys(ST.topic(spark, f"{base}/topic", SCHEMA), ["user"], "ts", ["id"], "3 HOURS", "1 hour")
        with keyed_state(spark):
            ST.drain(out, f"{base}/data", f"{base}/checkpoint")
    rows = spark.read.schema(out.schema).parquet(f"{base}/data").collect()
    spans = sorted(((r["user"], r["first"], r["last"], r["n"]) for r in rows if r["kind"] == "idle"), key=str)
    aside = sorted((r["kind"], r["id"], r["user"]) for r in rows if r["kind"] != "idle")
    return spans, aside


def test_spans_end_late_rows_come_out_and_odd_rows_stay_whole(spark, tmp_path):
    big = 2**62 + 1
    spans, aside = run(spark, str(tmp_path), [
        [(1, 7, at(1)), (2, 7, at(3)), (big, 7, None), (4, None, at(2)), (5, None, at(4))],
        # 9:00 is in time and too far from 3:00; 2:30 is behind the mark of 3:00
        [(6, 7, at(9)), (7, 7, at(2, 30)), (8, big, at(20)), (9, big, at(20))],
        # behind the mark of 19:00, also for a key that was never seen
        [(10, 7, at(10)), (11, 3, at(18)), (12, big, at(22, 59))],
    ])
    assert spans == sorted([(7, at(1), at(3), 2), (7, at(9), at(9), 1), (None, at(2), at(4), 2)], key=str)
    assert aside == [("late", 7, 7), ("late", 10, 7), ("late", 11, 3), ("undated", big, 7)]


def test_spans_do_not_hang_on_how_rows_are_cut():
    rng = np.random.default_rng(3)
    for _ in range(200):
        times = rng.integers(0, 300, rng.integers(1, 40))
        whole = merge_spans([], times, 10)
        held = []
        for part in np.array_split(times, rng.integers(1, 6)):
            held = merge_spans(held, part, 10)
        assert held == whole and sum(n for *_, n in held) == len(times)
        assert all(b[0] - a[1] > 10 for a, b in zip(held, held[1:]))


class _Handle:
    """State of one bucket, with its calls counted."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    getValueState = lambda self, *_: self
    exists = lambda self: self.value is not None
    get = lambda self: self._called(self.value)
    update = lambda self, value: self._called(setattr(self, "value", value))
    clear = lambda self: self._called(setattr(self, "value", None))
    registerTimer = lambda self, at: self._called(self.timers.add(at))
    deleteTimer = lambda self, at: self._called(self.timers.discard(at))

    def _called(self, result):
        self.calls += 1
        return result


def test_calls_for_state_do_not_grow_with_keys():
    handle, state = _Handle(), _Spans(10)
    state.init(handle)
    rng = np.random.default_rng(5)
    mark = type("Mark", (), {"at": 0, "getCurrentWatermarkInMs": lambda self: self.at})()
    keys = np.array([f"k{i}" for i in range(500)] + [None], object)
    times, ended = {k: [] for k in keys}, []
    for _ in range(3):
        frame = pd.DataFrame({"bucket": 0, "key": rng.choice(keys, 4000), "row": "{}", "at_us": rng.integers(0, 400_000, 4000)})
        for k, at in zip(frame["key"], frame["at_us"]):
            times[k].append(at)
        assert list(state.handleInputRows((0,), iter([frame[:1500], frame[1500:]]), mark)) == []
    assert handle.calls <= 10 and len(handle.timers) == 1
    while handle.timers:
        mark.at = handle.timers.pop()
        for out in state.handleExpiredTimer((0,), mark, None):
            ended += out[["key", "first_us", "last_us", "n"]].itertuples(index=False, name=None)
    assert handle.value is None
    assert sorted(ended, key=str) == sorted(((k, *s) for k in keys for s in merge_spans([], np.array(times[k]), 10_000)), key=str)
