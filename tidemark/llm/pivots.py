"""k-means over integer vectors with a pivot table: most centroids are ruled out without touching the vector.

Every vector's distances to a few fixed pivots are stored once, beside the vector. In each round the centroids'
distances to the pivots are worked out on the driver (centroids times pivots); by the triangle inequality the largest
difference of two such distances is a lower bound of the distance between vector and centroid. A vector's distance to
the centroid with the smallest bound is computed exactly, and then to those centroids whose bound does not exceed it.
Bounds are floating point with a margin far above their rounding; distances, sums and means are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_rows, own_columns, staged

DIMENSIONS = 64
SCALE = 64.0
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 8
#: Pivots are chosen among this many vectors with the smallest hashes.
PIVOT_SAMPLE = 512
VECTOR_ROWS = 4096
#: Share of two distances by which a bound is lowered; their rounding is some 1e-14.
MARGIN = 1e-9
#: Up to this magnitude a squared distance of integer vectors fits 64 bits.
NARROW = 2.0**26
_LOW = 80

ASSIGNED = "vec_id long, cluster int, distance long, n_exact int"
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64()), ("n_exact", pa.int32())])
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_exact int"


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole floats as exact integers: 64-bit ones where their squared distances fit, Python's own otherwise."""
    if not x.size or np.abs(x).max() <= NARROW:
        return x.astype(np.int64)
    return np.array([int(value) for value in x.ravel()], object).reshape(x.shape)


def _distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Rounded distances of all vectors to all points."""
    out = np.empty((len(vectors), len(points)))
    for j, point in enumerate(points):
        out[:, j] = np.sqrt(np.square(vectors - point).sum(axis=1))
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each next one has the largest sum of distances to those before."""
    chosen, total = [0], np.zeros(len(sample))
    while len(chosen) < min(count, len(sample)):
        total += _distances(sample, sample[chosen[-1] :][:1])[:, 0]
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return sample[chosen]


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: list[list[int]], pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each vector: its nearest centroid (of equally near ones the first), the exact squared distance, and to how
    many centroids the distance was computed."""
    rough = np.array(centroids, float)
    wide = bool(vectors.size) and max(np.abs(vectors).max(), np.abs(rough).max()) > NARROW
    exact = np.array(centroids, object if wide else np.int64)
    whole = np.array([int(x) for x in vectors.ravel()], object).reshape(vectors.shape) if wide else vectors.astype(np.int64)
    from_pivots = _distances(rough, pivots)
    bounds = np.empty((len(vectors), len(centroids)))
    for j, row in enumerate(from_pivots):
        bounds[:, j] = np.max(np.abs(to_pivots - row) - MARGIN * (to_pivots + row), axis=1)
    bounds = np.square(np.maximum(bounds, 0)) * (1 - MARGIN)
    first = bounds.argmin(axis=1)
    best = np.empty(len(vectors), exact.dtype)
    label, n_exact = first.copy(), np.ones(len(vectors), np.int32)
    for j, centroid in enumerate(exact):
        rows = np.flatnonzero(first == j)
        best[rows] = np.square(whole[rows] - centroid).sum(axis=1)
    for j, centroid in enumerate(exact):
        rows = np.flatnonzero((bounds[:, j] <= best) & (first != j))
        found = np.square(whole[rows] - centroid).sum(axis=1)
        nearer = (found < best[rows]) | (found == best[rows]) & (j < label[rows])
        best[rows[nearer]], label[rows[nearer]] = found[nearer], j
        n_exact[rows] += 1
    return label, best, n_exact


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`vec_id`, `vector` (whole numbers) and `to_pivots`, its distances to the pivots. Staged."""
    width = kept.schema.fieldNames()[-1]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.floor(SCALE * _matrix(batch.column(width), DIMENSIONS))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(pa.float64())) for m in (vectors, _distances(vectors, pivots))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *lists], ["vec_id", "vector", "to_pivots"])

    return staged(kept.mapInArrow(measured, "vec_id long, vector array<double>, to_pivots array<double>"), "pivot_table")


def _means(vectors: DataFrame, centroids: list[list[int]], pivots: np.ndarray) -> list[list[int]]:
    """The centroids after one round: the floors of their vectors' exact means; those without vectors stay."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centroids), DIMENSIONS), object), np.zeros(len(centroids), np.int64)
        for batch in batches:
            rows = _matrix(batch.column("vector"), DIMENSIONS)
            label, _, _ = nearest(rows, _matrix(batch.column("to_pivots"), len(pivots)), centroids, pivots)
            whole = _integers(rows)
            for j in np.unique(label):
                sums[j] += whole[label == j].sum(axis=0).astype(object)
            counts += np.bincount(label, minlength=len(centroids))
        used = [int(j) for j in np.flatnonzero(counts)]
        places = [(j, i, int(sums[j, i]), int(counts[j])) for j in used for i in range(DIMENSIONS)]
        high, low = [Decimal(s >> _LOW) for _, _, s, _ in places], [Decimal(s & (1 << _LOW) - 1) for _, _, s, _ in places]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in places], pa.int32()), pa.array([p[1] for p in places], pa.int32()), pa.array(high, pa.decimal128(38, 0)), pa.array(low, pa.decimal128(38, 0)), pa.array([p[3] for p in places], pa.int64())],
            ["cluster", "place", "high", "low", "n"])

    parts = vectors.mapInArrow(summed, "cluster int, place int, high decimal(38,0), low decimal(38,0), n long")
    out = [list(c) for c in centroids]
    # centroids times dimensions rows, whatever the table holds
    for row in parts.groupBy("cluster", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).collect():
        out[row.cluster][row.place] = ((int(row.high) << _LOW) + int(row.low)) // row.n
    return out


def _assigned(vectors: DataFrame, centroids: list[list[int]], pivots: np.ndarray) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, best, n_exact = nearest(_matrix(batch.column("vector"), DIMENSIONS), _matrix(batch.column("to_pivots"), len(pivots)), centroids, pivots)
            distance = [None if d >= 1 << 63 else int(d) for d in best] if best.dtype == object else best
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(label, pa.int32()), pa.array(distance, pa.int64()), pa.array(n_exact, pa.int32())], schema=_ASSIGNED)

    return staged(vectors.mapInArrow(assign, ASSIGNED), "assigned")


def cluster_vectors(df: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """For each row of `df` (vec_id, embedding; others ignored) with a vector of 64 finite components: vec_id, cluster,
    distance, cluster_inertia, inertia, centroid_sha256, n_exact.

    Components become floor(64 * x). Centroids start as the vectors with the smallest sha256 of `1:<vec_id>`; of rows
    with the same id, repeated or null (hashed as `1:`), the smaller vector comes first. Null vectors, those of another
    length and those with a null, NaN or infinite component give no row. Repeated rows are vectors of their own. With
    fewer vectors than centroids there are as many centroids as vectors; an empty table gives no rows. Components may
    have any 32-bit floating point value; a distance or sum of them that does not fit a long is null, the cluster is
    still the nearest. n_exact is the number of centroids that the pivots did not rule out in the last round.
    """
    spark = df.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = own_columns(df, "vec_id", "embedding").where((F.size("embedding") == DIMENSIONS) & finite)
    kept = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    sample = np.array([r.embedding for r in kept.orderBy(order, "embedding").limit(max(centroids, PIVOT_SAMPLE)).select("embedding").collect()], float)
    if not len(sample):
        return spark.createDataFrame([], RESULT)
    sample = np.floor(SCALE * sample)
    points = [[int(x) for x in v] for v in sample[:centroids]]
    with arrow_rows(spark, VECTOR_ROWS):
        pivots = choose_pivots(sample, PIVOTS)
        vectors = _pivot_table(kept, pivots)
        for _ in range(rounds):
            points = _means(vectors, points, pivots)
        found = _assigned(vectors, points, pivots)
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    # one row for each centroid
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(total.alias("total")).collect()}
    inertia = None if None in sums.values() else sum(sums.values())

    def long_or_null(x):
        return F.lit(None if x is None or x >= 1 << 63 else int(x)).cast("long")

    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    own = F.element_at(F.array(*[long_or_null(sums.get(j)) for j in range(len(points))]), F.col("cluster") + 1)
    digest = F.element_at(F.array(*[F.lit(d) for d in digests]), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance", own.alias("cluster_inertia"), long_or_null(inertia).alias("inertia"), digest.alias("centroid_sha256"), "n_exact")
