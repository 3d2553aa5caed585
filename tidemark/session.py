"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession, functions as F, types as T


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every plan here relies on; cluster sizing stays with the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def _base_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or overwritten."""
    base = _base_folder(spark)
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint in the shared folder, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    base = _base_folder(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint(eager=True)


BROADCAST_BYTES = 64 * 1024 * 1024


def small_side(df, max_bytes: int = BROADCAST_BYTES, computed: bool = False):
    """A join side that was computed once and measured: broadcast when it is small, else as it is.
    `computed` says that its lineage was cut already.

    Without this, Spark plans a shuffle of the large side before it can know how small this one is.
    """
    kept = df if computed else cut_lineage(df)
    variable = [f.name for f in kept.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in kept.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    lengths = [F.octet_length(F.col(c)) for c in variable] + [F.octet_length(F.to_json(F.col(c))) for c in nested]
    width = sum((F.coalesce(x, F.lit(0)).cast("long") for x in lengths), F.lit(16 * len(kept.columns)).cast("long"))
    size = kept.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(kept) if size <= max_bytes else kept


def scalar(df):
    """The single value of a one-row aggregate: a cursor or threshold held as state."""
    row = df.first()
    return None if row is None else row[0]
