"""Per-key state with a time-out: spans of activity that end when a key stays idle, and rows that came too late."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Stands for no time; state is handed over as whole numbers, which have no NULL there.
UNDATED = -(1 << 63)
#: State is kept and fetched for so many buckets of keys. A checkpoint holds to the number, so it must not change.
BUCKETS = 1024
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which state variables and timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def merged(frame: pd.DataFrame, idle: int) -> pd.DataFrame:
    """Spans (key, first, last, n) of many keys at once, in no order: those of one key at most `idle` apart become one."""
    if frame.empty:
        return frame
    frame = frame.assign(code=pd.factorize(frame["key"], use_na_sentinel=False)[0])
    frame = frame.sort_values(["code", "first"], ignore_index=True)
    code, first, n = (frame[c].to_numpy(np.int64) for c in ("code", "first", "n"))
    reach = frame.groupby("code")["last"].cummax().to_numpy(np.int64)
    begins = np.r_[0, np.flatnonzero((np.diff(code) != 0) | (first[1:] - reach[:-1] > idle)) + 1]
    ends = np.r_[begins[1:], len(code)] - 1
    return pd.DataFrame({"key": frame["key"].to_numpy(object)[begins], "first": first[begins], "last": reach[ends], "n": np.add.reduceat(n, begins)})


def merge_spans(spans: list[tuple[int, int, int]], times: np.ndarray, idle: int) -> list[tuple[int, int, int]]:
    """(first, last, rows) of one key's spans with new times taken in; those at most `idle` apart are one."""
    rows = [*spans, *((at, at, 1) for at in np.asarray(times).tolist())]
    out = merged(pd.DataFrame(rows, columns=["first", "last", "n"], dtype=np.int64).assign(key=""), idle)
    return list(zip(*(out[c].tolist() for c in ("first", "last", "n"))))


class _Spans(StatefulProcessor):
    """State of a bucket of keys: their open spans. A timer stands at the end of the first one."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getValueState("spans", "key array<string>, first array<long>, last array<long>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = self._open()
        spans = held
        for frame in rows:
            at = frame["at_us"].to_numpy(np.int64)
            undated = at == UNDATED
            late = ~undated & (at // 1000 < mark) & (mark > 0)
            aside = late | undated
            if not aside.all():
                fresh = pd.DataFrame({"key": frame["key"].to_numpy(object)[~aside], "first": at[~aside], "last": at[~aside], "n": 1})
                spans = merged(pd.concat([spans, fresh]) if len(spans) else fresh, self.idle_ms * 1000)
            if aside.any():
                out = frame.loc[aside, ["key", "row"]]
                out.insert(0, "kind", np.where(undated, "undated", "late")[aside])
                yield out.assign(first_us=None, last_us=None, n=None)
        if spans is not held:
            self._keep(held, spans)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = self._open()
        over = self._due(held["last"]) <= mark
        # the caller deletes the timer that went off
        self._keep(held[:0], held[~over])
        if over.any():
            out = held[over].rename(columns={"first": "first_us", "last": "last_us"})
            out.insert(0, "kind", "idle")
            out.insert(2, "row", None)
            yield out

    def close(self) -> None:
        pass

    def _open(self) -> pd.DataFrame:
        key, *numbers = self.spans.get() if self.spans.exists() else ([], [], [], [])
        return pd.DataFrame({"key": np.array(key, object), **{c: np.array(v, np.int64) for c, v in zip(("first", "last", "n"), numbers)}})

    def _due(self, last):
        """The first watermark at which no row that is in time can reach a span."""
        return last // 1000 + self.idle_ms + 1

    def _keep(self, before: pd.DataFrame, spans: pd.DataFrame) -> None:
        old, new = (int(self._due(s["last"].min())) if len(s) else None for s in (before, spans))
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is None:
            self.spans.clear()
        else:
            self.spans.update(tuple(spans[c].tolist() for c in ("key", "first", "last", "n")))
            self.handle.registerTimer(new)


def idle_keys(stream: DataFrame, keys: list[str], ts: str, carry: list[str], idle: str, delay: str) -> DataFrame:
    """Spans of activity per key and the rows left out of them, as one stream (append mode; start it in keyed_state()).

    A row is late when it is older than the newest time of earlier micro-batches less `delay`; it comes out at once with
    `kind` late, its key and its `carry` columns, and a row without a time with `kind` undated. The others make spans
    of rows at most `idle` apart. When no row that is in time can reach a span any more, it comes out with `kind` idle,
    `first`, `last` and `n`, and its state goes. So state holds only keys that were active lately, however the rows are
    cut into micro-batches. Keys are dealt by hash over BUCKETS, each with its keys' spans as one value of state, so the calls
    for state and timers do not grow with the keys. A NULL key is a key like others. Times are compared with the watermark in milliseconds; keys
    and carried columns travel as JSON, which holds plain columns exactly.
    """
    length = stream.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {idle})")).first()[0]
    text = lambda names: F.to_json(F.struct(*names), {**JSON, "ignoreNullFields": "false"})
    kind = lambda names: T.StructType([stream.schema[name] for name in names])
    # a column without the watermark's mark: Spark would drop the late rows ahead of the processor
    rows = stream.withWatermark(ts, delay).select(
        text(keys).alias("key"), text(carry).alias("row"), F.coalesce(F.unix_micros(F.col(ts)), F.lit(UNDATED)).alias("at_us"))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    out = dealt.groupBy("bucket").transformWithStateInPandas(
        _Spans(length), "kind string, key string, row string, first_us long, last_us long, n long", "Append", "EventTime")
    parsed = out.withColumns({"_key": F.from_json("key", kind(keys), JSON), "_row": F.from_json("row", kind(carry), JSON)})
    return parsed.select("kind", "_key.*", "_row.*", F.timestamp_micros("first_us").alias("first"), F.timestamp_micros("last_us").alias("last"), "n")
