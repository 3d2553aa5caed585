"""Several keyed tables that change together: one commit record names the manifest of each.

A commit writes the tables' new folders and manifests first, under names that no record mentions, and then publishes one
record by a rename. Readers go through the record, so they see all tables before the commit or all after it, also when
a writer dies between two tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.ordering import keep_one
from tidemark.session import cut_lineage, small_side
from tidemark.sinks.merge import without_keys
from tidemark.sinks.versioned import Journal, VersionedTable


class _Pinned(Journal):
    """The journal of one table: a record of the group names the manifest in force."""

    def __init__(self, spark: SparkSession, folder: str, name: str | None):
        super().__init__(spark, folder)
        self.name = name

    def names(self) -> list[str]:
        return [self.name] if self.name else []

    def publish(self, document: dict) -> None:
        self.name = self.prepare(document, "pinned")


class TableGroup:
    def __init__(self, spark: SparkSession, path: str, tables: dict[str, list[str]], buckets: int = 16):
        """`tables` gives each table's keys; `buckets` is for tables that do not exist yet."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), tables, buckets
        self.records = Journal(spark, f"{self.path}/_commits")

    def _record(self) -> dict:
        return self.records.latest() or {"version": 0, "tables": {}, "state": {}, "batches": {}}

    def _table(self, name: str, record: dict) -> VersionedTable:
        folder = f"{self.path}/{name}"
        return VersionedTable(self.spark, folder, self.keys[name], self.buckets, _Pinned(self.spark, f"{folder}/_manifests", record["tables"].get(name)))

    def read(self, *names: str) -> DataFrame | list[DataFrame]:
        """The tables as of one record: a frame for one name, a list for several."""
        record = self._record()
        frames = [self._table(n, record).read() for n in names]
        return frames[0] if len(frames) == 1 else frames

    def has(self, name: str) -> bool:
        return name in self._record()["tables"]

    def state(self) -> dict:
        return self._record()["state"]

    def committed(self, writer: str) -> int:
        """The number of the last batch that a writer committed, -1 before any."""
        return self._record()["batches"].get(writer, -1)

    @contextmanager
    def commit(self, state: dict | None = None, batch: tuple[str, int] | None = None) -> Iterator[dict[str, VersionedTable]]:
        """The tables to replace() or merge() inside the block; all of it is published when the block ends, or nothing
        if it raises. A record that another writer published meanwhile makes this one fail."""
        record = self._record()
        tables = {n: self._table(n, record) for n in self.keys}
        yield tables
        named = {n: t.journal.name for n, t in tables.items() if t.journal.name}
        batches = record["batches"] if batch is None else {**record["batches"], batch[0]: batch[1]}
        self.records.publish(
            {"version": record["version"] + 1, "tables": {**record["tables"], **named}, "state": {**record["state"], **(state or {})}, "batches": batches}
        )

    def expire(self, keep: int = 10) -> int:
        """Delete all but the newest `keep` records and what only they used; returns how many. Readers of an expired
        record fail, so keep more than a long read can outlive."""
        names = self.records.names()
        old, kept = names[:-keep], [self.records.load(n) for n in names[-keep:]]
        for name in old:
            self.records.remove(name)
        for table in self.keys:
            pinned = {r["tables"][table] for r in kept if table in r["tables"]}
            journal = Journal(self.spark, f"{self.path}/{table}/_manifests")
            manifests = [journal.load(n) for n in pinned]
            fs, folder = journal.path(journal.folder)
            if not fs.exists(folder):
                continue
            newest = max((m["version"] for m in manifests), default=0)
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                # A manifest as new as the newest in use may belong to a commit in progress.
                if name not in pinned and name.lstrip(".") < f"{newest:09d}":
                    journal.remove(name)
            self._table(table, kept[-1]).drop_unused({v for m in manifests for v in m["buckets"].values()}, newest)
        return len(old)


@dataclass(frozen=True)
class Output:
    """Rows that a batch gives one table. With `parent`, columns of the batch and the table, the batch's rows are all that
    their parents have: rows of these parents that it lacks are removed."""

    rows: Callable[[DataFrame], DataFrame]
    order: list[str] = field(default_factory=list)
    parent: tuple[str, ...] = ()


def _replaced(table: VersionedTable, rows: DataFrame, parents: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """`rows` and, flagged _gone, the keys that the table has under the same parents and `rows` lacks."""
    mine = parents.select(*[F.col(p).alias(f"_parent_{p}") for p in parent])
    match = F.lit(True)
    for p in parent:
        match = match & F.col(p).eqNullSafe(F.col(f"_parent_{p}"))
    old = table.read().join(small_side(mine.distinct()), match, "left_semi").select(*{*table.keys, *parent})
    gone = without_keys(old, rows.select(*table.keys), table.keys).withColumn("_gone", F.lit(True))
    return rows.withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)


def fan_out(group: TableGroup, source: DataFrame, outputs: dict[str, Output], state: dict | None = None, batch: tuple[str, int] | None = None) -> bool:
    """Read a batch once and bring it to all tables in one commit. A batch number that was committed before is skipped."""
    if batch is not None and batch[1] <= group.committed(batch[0]):
        return False
    landed = cut_lineage(source)
    with group.commit(state, batch) as tables:
        for name, output in outputs.items():
            table, rows = tables[name], output.rows(landed)
            order = output.order or table.keys
            if table.manifest() is None:
                table.replace(keep_one(rows, table.keys, order, "last"))
            elif output.parent:
                table.merge(_replaced(table, cut_lineage(rows), landed, output.parent), order, deleted="_gone")
            else:
                table.merge(rows, order)
    return True
