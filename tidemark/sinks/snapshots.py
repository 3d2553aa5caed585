"""Key snapshots that are compared by digests first.

The keys of the last snapshot lie in buckets, with a digest of each: how many keys, and two sums of their hashes. A
new snapshot is scanned once for its digests. Where a bucket's digest is the same, its keys are neither read nor
joined, so the cost of a comparison is one scan plus what the changed buckets hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.merge import without_keys
from tidemark.sinks.versioned import VersionedTable


@dataclass(frozen=True)
class Difference:
    """Keys that vanished since the last snapshot, keys that are new, and the buckets that hold them all."""

    vanished: DataFrame
    new: DataFrame
    buckets: set[int]


class KeySnapshot:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 256):
        """Choose `buckets` so that one bucket's keys are a small part of them; a few changes touch as many buckets."""
        self.table = VersionedTable(spark, path, keys, buckets)
        self.keys = keys

    def _digests(self, rows: DataFrame) -> dict[str, str]:
        """Digest by bucket. As many rows as buckets come to the driver."""
        parts = [F.sum(h.cast("decimal(38,0)")).cast("string") for h in (F.xxhash64(*self.keys), F.xxhash64(F.lit(1), *self.keys))]
        digests = rows.groupBy(self.table.bucket().alias("b")).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *parts).alias("d"))
        return {str(r["b"]): r["d"] for r in digests.collect()}

    def compare(self, current: DataFrame) -> Difference:
        """`current` against the last snapshot, which must exist. A NULL key is a key like others; a repeated one counts once."""
        return self._compare(current, self._digests(current.select(*self.keys)))

    def _compare(self, current: DataFrame, now: dict[str, str]) -> Difference:
        then = self.table.state()["digests"]
        changed = {int(b) for b in {*then, *now} if then.get(b) != now.get(b)}
        old = self.table.read_buckets(changed)
        new = current.select(*self.keys).filter(self.table.bucket().isin(sorted(changed))).distinct()
        return Difference(without_keys(old, new, self.keys), without_keys(new, old, self.keys), changed)

    def advance(self, current: DataFrame) -> Difference | None:
        """Compare, then make `current` the last snapshot; only changed buckets are written. None on the first run. The
        difference is read from the files of the earlier snapshot, which stay until they expire."""
        now = self._digests(current.select(*self.keys))
        if self.table.manifest() is None:
            self.table.replace(current.select(*self.keys).distinct(), {"digests": now})
            return None
        found = self._compare(current, now)
        rows = current.select(*self.keys).filter(self.table.bucket().isin(sorted(found.buckets))).distinct()
        self.table.rewrite(rows, found.buckets, {"digests": now})
        return found
