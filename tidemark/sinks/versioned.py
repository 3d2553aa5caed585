"""A keyed Parquet table whose data and cursor change together.

Rows live in key-hash buckets. A commit writes new folders for the touched buckets only, then
publishes one small manifest (bucket -> folder, plus state) by a rename, which must be atomic there. Readers resolve the
newest manifest, so they see the old table or the new one, never a half-written or empty one. Every attempt writes
to a folder of its own, so a writer that loses the race changes nothing that a manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.ordering import keep_one
from tidemark.session import cut_lineage, small_side
from tidemark.sinks.merge import matches, without_keys

#: Tasks, and so files, that write one bucket at most.
WRITERS_PER_BUCKET = 4
#: Columns of tables that remember the position of each key's last change; readers do not see them.
POSITION, DELETED = "_position", "_deleted"


class Journal:
    """Numbered JSON documents in one folder. The newest is in force; each number is published once, by a rename."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def names(self) -> list[str]:
        fs, folder = self.path(self.folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")) if fs.exists(folder) else []

    def latest(self) -> dict | None:
        names = self.names()
        return self.load(names[-1]) if names else None

    def load(self, name: str) -> dict:
        fs, path = self.path(f"{self.folder}/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def prepare(self, document: dict, suffix: str = "tmp") -> str:
        """Write a document under a name that no other attempt has; nothing reads it yet."""
        name = f".{document['version']:09d}-{uuid.uuid4().hex}.{suffix}"
        fs, temporary = self.path(f"{self.folder}/{name}")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(document).encode()))
        out.close()
        return name

    def commit(self, prepared: str, version: int) -> None:
        fs, temporary = self.path(f"{self.folder}/{prepared}")
        _, final = self.path(f"{self.folder}/{version:09d}.json")
        if fs.exists(final) or not fs.rename(temporary, final):
            fs.delete(temporary, False)
            raise RuntimeError(f"version {version} was committed by another writer")

    def publish(self, document: dict) -> None:
        self.commit(self.prepare(document), document["version"])

    def remove(self, name: str) -> None:
        fs, path = self.path(f"{self.folder}/{name}")
        fs.delete(path, False)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 16, journal: Journal | None = None):
        """Choose `buckets` so that one bucket is a few tasks' work at the table's full size. A table that exists
        keeps the bucket count it was made with, and refuses other keys. `journal` says where its manifests are
        published, if not in its own folder."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.journal = journal or Journal(spark, f"{self.path}/_manifests")
        current = self.manifest()
        if current is not None:
            if current.get("keys", self.keys) != self.keys:
                raise ValueError(f"the table's keys are {current['keys']}, not {self.keys}")
            self.buckets = current.get("bucket_count", self.buckets)

    def manifest(self) -> dict | None:
        return self.journal.latest()

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, manifest: dict, buckets) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{v}/_bucket={b}" for b, v in manifest["buckets"].items() if int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        current = self.manifest()
        if current is None:
            raise LookupError(f"nothing committed at {self.path}")
        rows = self._read(current, range(self.buckets))
        return rows.filter(f"NOT coalesce({DELETED}, false)").drop(POSITION, DELETED) if POSITION in rows.columns else rows

    def state(self) -> dict:
        return (self.manifest() or {}).get("state", {})

    def _write(self, df: DataFrame, version: int) -> dict[str, str]:
        folder = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
        salt = F.pmod(F.hash(*self.keys), F.lit(WRITERS_PER_BUCKET))
        bucketed = df.withColumn("_bucket", self._bucket()).repartition("_bucket", salt)
        bucketed.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        fs, written = self.journal.path(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(written) if s.isDirectory()]
        return {n.split("=")[1]: folder for n in names if n.startswith("_bucket=")}

    def _touched(self, rows: DataFrame) -> set[int]:
        return {r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()}

    def _not_older(self, rows: DataFrame, manifest: dict, touched: set[int]) -> DataFrame:
        """The rows whose position is not before that of their key's last change."""
        old = self._read(manifest, touched)
        if POSITION not in old.columns:
            return rows
        known = old.select(*[F.col(k).alias(f"_old_{k}") for k in self.keys], F.col(POSITION).alias("_known"))
        batch = small_side(rows.select(*self.keys, POSITION), computed=True)
        late = known.join(batch, matches(self.keys, "_old_")).filter(F.col("_known") > F.col(POSITION)).select(*self.keys)
        return without_keys(rows, small_side(late), self.keys)

    def expire(self, keep: int = 10) -> int:
        """Delete all but the newest `keep` versions and the folders only they used; returns how many.

        Readers of an expired version fail, so keep more versions than a long read can outlive.
        """
        names = self.journal.names()
        old, kept = names[:-keep], names[-keep:]
        used = {v for n in kept for v in self.journal.load(n)["buckets"].values()}
        for name in old:
            self.journal.remove(name)
        self.drop_unused(used, int(kept[-1].split(".")[0]) if kept else 0)
        return len(old)

    def drop_unused(self, used: set[str], newest: int) -> None:
        """Delete the folders that are not in use. Those as new as the newest version or newer may belong to a commit in
        progress."""
        fs, folder = self.journal.path(self.path)
        for status in fs.listStatus(folder):
            version = status.getPath().getName()
            if version.startswith("v") and version not in used and version < f"v{newest:09d}":
                fs.delete(status.getPath(), True)

    def replace(self, df: DataFrame, state: dict | None = None) -> None:
        """First load, or truncate and reload."""
        current = self.manifest() or {"version": 0, "state": {}}
        version = current["version"] + 1
        self.journal.publish(
            {
                "version": version,
                "keys": self.keys,
                "bucket_count": self.buckets,
                "schema": df.schema.jsonValue(),
                "buckets": self._write(df, version),
                "state": current["state"] if state is None else state,
                "batches": current.get("batches", {}),
            }
        )

    def rewrite(self, rows: DataFrame, buckets: set[int], state: dict | None = None) -> None:
        """Replace what some buckets hold by `rows`, which all belong to them; the others stay as they are."""
        current = self.manifest()
        if current is None:
            raise LookupError("load the table with replace() first")
        version = current["version"] + 1
        kept = {b: v for b, v in current["buckets"].items() if int(b) not in buckets}
        written = self._write(rows, version) if buckets else {}
        self.journal.publish(
            {**current, "version": version, "buckets": {**kept, **written}, "state": current["state"] if state is None else {**current["state"], **state}}
        )

    def read_buckets(self, buckets: set[int]) -> DataFrame:
        """Only the rows of some buckets; the files of the others are not opened."""
        return self._read(self.manifest(), buckets)

    def bucket(self):
        """The column that says in which bucket a row's key belongs."""
        return self._bucket()

    def merge(
        self,
        rows: DataFrame,
        order: list[str],
        deleted: str | None = None,
        state: dict | None = None,
        batch: tuple[str, int] | None = None,
        ordered: bool = False,
    ) -> bool:
        """Upsert the last row per key; rows whose `deleted` column is true remove their key.

        `order` columns may be extra to the table's. Other columns that the table lacks are added to it, NULL in the
        rows it has; columns that the rows lack become NULL in theirs. A NULL key is a key like others. `batch` is (writer, number): a number this writer
        committed before is skipped, which makes replays harmless. `ordered` keeps the `order` values of each key's last
        change, deletes included, and drops rows older than that, so changes may arrive in any order; of equal
        positions the later batch wins.
        """
        current = self.manifest()
        if current is None:
            raise LookupError("load the table with replace() first")
        done = dict(current.get("batches", {}))
        if batch is not None:
            writer, number = batch
            if number <= done.get(writer, -1):
                return False
            done[writer] = number
        final = keep_one(rows, self.keys, order, "last")
        if ordered:
            gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted), F.lit(False))
            final = final.withColumns({POSITION: F.struct(*order), DELETED: gone})
        final = cut_lineage(final)
        touched = self._touched(final)
        if ordered and touched:
            final = cut_lineage(self._not_older(final, current, touched))
            touched = self._touched(final)
        buckets = {b: v for b, v in current["buckets"].items() if int(b) not in touched}
        version = current["version"] + 1
        schema = T.StructType.fromJson(current["schema"])
        extra = {*schema.names, *order, *([deleted] if deleted else [])}
        schema = T.StructType([*schema.fields, *(T.StructField(f.name, f.dataType) for f in final.schema.fields if f.name not in extra)])
        if touched:
            old = self._read({**current, "schema": schema.jsonValue()}, touched)
            live = final if deleted is None or ordered else final.filter(~F.col(deleted))
            live = live.select(*[c for c in schema.names if c in live.columns])
            merged = without_keys(old, small_side(final.select(*self.keys), computed=True), self.keys).unionByName(live, allowMissingColumns=True)
            buckets.update(self._write(merged, version))
        self.journal.publish(
            {
                "version": version,
                "keys": self.keys,
                "bucket_count": self.buckets,
                "schema": schema.jsonValue(),
                "buckets": buckets,
                "state": current["state"] if state is None else {**current["state"], **state},
                "batches": done,
            }
        )
        return True
