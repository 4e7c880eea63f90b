"""Centroid clustering in integers, with most centroids ruled out by leading coordinates of a rotation and the norm of the rest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from candlewick.llm.common import kept

#: Leading coordinates of the rotation that are stored; vectors compared at a time; components beyond this size would overflow sums of squares.
LEADING, STRIP, LARGEST = 16, 4_096, 1 << 27
_SLACK = 1e-9  # far above the rounding of the bounds, which decide only what is verified


def _usable(embedding: str, length: int) -> Column:
    value = F.col(embedding)
    number = lambda x: x.cast("double")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == float("inf")))
    return F.coalesce((F.size(value) == length) & ~bad, F.lit(False))


def _integers(vectors: DataFrame, vec_id: str, embedding: str, length: int, scale: int) -> DataFrame:
    """``vec_id`` and ``point``: floor(scale * x) of each component of the vectors that can be clustered."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding")).filter(_usable("embedding", length))
    fits = F.forall("point", lambda x: F.abs(x) <= LARGEST)
    complaint = F.raise_error(F.lit(f"a scaled component beyond {LARGEST} leaves no room for exact sums of squares")).cast("array<long>")
    return named.select("vec_id", scaled.alias("point")).select("vec_id", F.when(fits, F.col("point")).otherwise(complaint).alias("point"))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _rotation(points: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes, the widest first, from sums and products that tasks add up: ``length`` squared numbers reach the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length + 1, length + 1))
        for batch in batches:
            own = np.concatenate([_matrix(batch.column(0), np.float64), np.ones((batch.num_rows, 1))], axis=1)
            total += own.T @ own
        place = np.arange(total.size, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    sums = points.select("point").mapInArrow(products, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((length + 1) ** 2)
    for place, value in sums:
        total[place] = value
    total = total.reshape(length + 1, length + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    spread, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return mean, axes[:, np.argsort(-spread, kind="stable")]


class Rotated:
    """Points as leading coordinates of a rotation about a mean, and the norm of what the others hold."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, leading: int) -> None:
        self.mean, self.axes = mean, axes[:, :leading]

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        moved = points - self.mean
        lead = moved @ self.axes
        return lead, np.sqrt(np.maximum((moved**2).sum(1) - (lead**2).sum(1), 0))


def nearest(points: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotated: Rotated) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the smaller number of equally near ones) and squared distance of each point, and how many distances were computed.

    The distance of the leading coordinates plus the squared difference of the norms of the rest is never above the
    distance. The centroid with the least bound is measured in integers; so are all others whose bound isn't above that.
    """
    c_lead, c_rest = rotated.place(centroids.astype(np.float64))
    n = np.arange(len(points))
    bound = (lead**2).sum(1)[:, None] + (c_lead**2).sum(1) - 2 * lead @ c_lead.T + (rest[:, None] - c_rest) ** 2
    room = _SLACK * ((lead**2).sum(1) + rest**2)[:, None] + _SLACK * ((c_lead**2).sum(1) + c_rest**2) + 1e-6
    best = bound.argmin(1)
    distance = ((points - centroids[best]) ** 2).sum(1)
    open_ = bound - room <= distance[:, None]
    open_[n, best] = False
    row, other = np.nonzero(open_)
    if len(row):
        measured = np.concatenate([((points[row[a : a + STRIP]] - centroids[other[a : a + STRIP]]) ** 2).sum(1) for a in range(0, len(row), STRIP)])
        table = np.full(bound.shape, np.iinfo(np.int64).max)
        table[n, best] = distance
        table[row, other] = measured
        best = table.argmin(1)  # the first of equal ones
        distance = table[n, best]
    return best, distance, len(points) + len(row)


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, STRIP):
            part = batch.slice(at, STRIP)
            columns = {name: part.column(k) for k, name in enumerate(part.schema.names)}
            yield part, _matrix(columns["point"], np.int64), _matrix(columns["lead"], np.float64), columns["rest"].to_numpy()


def _moved(stored: DataFrame, centroids: np.ndarray, rotated: Rotated) -> np.ndarray:
    """Centroids moved to the floor of the mean of their points; those without points stay. Tasks send one sum per centroid and component."""
    k, length = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, length + 1), np.int64)
        for _, points, lead, rest in _strips(batches):
            best, _, _ = nearest(points, lead, rest, centroids, rotated)
            np.add.at(total, best, np.concatenate([points, np.ones((len(points), 1), np.int64)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int64)), pa.array(total.ravel())], ["place", "value"])

    exact = F.sum(F.col("value").cast("decimal(20,0)")).alias("value")
    found = stored.select("point", "lead", "rest").mapInArrow(sums, "place long, value long").groupBy("place").agg(exact).collect()
    total = {r["place"]: int(r["value"]) for r in found}
    moved = centroids.copy()
    for c in range(k):
        count = total.get(c * (length + 1) + length, 0)
        if count:
            moved[c] = [total[c * (length + 1) + j] // count for j in range(length)]
    return moved


def start(points: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors whose hashed ids are least, in order of the hash; null ids last, then by components. ``clusters`` rows reach the driver."""
    hashed = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    chosen = points.select(hashed.alias("hash"), "point").orderBy(F.asc_nulls_last("hash"), "point").limit(clusters).collect()
    return np.array([r["point"] for r in chosen], np.int64)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    length: int = 64,
    clusters: int = 40,
    rounds: int = 5,
    scale: int = 256,
    salt: str = "2:",
    leading: int = LEADING,
) -> DataFrame:
    """One row per vector of ``length`` finite components: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Components become floor(scale * x); all that is compared and summed is an integer. Centroids start as chosen by ``start`` (all vectors, if there are
    fewer), move ``rounds`` times, then every vector is assigned once more; equally near centroids give way to the smallest number. Vectors that are null,
    of another length, or with null or non-finite components have no row. Null and repeated ids count as vectors of their own; other columns are
    left out. Scaled components beyond 2**27 raise an error, since distances would not fit. An empty table gives no rows.

    Each vector is rotated once and stored; a round reads the store, shuffles one sum per task, centroid and component, and nothing else.
    """
    spark = vectors.sparkSession
    points = kept(_integers(vectors, vec_id, embedding, length, scale), "points")
    centroids = start(points, clusters, salt).reshape(-1, length)
    out = "vec_id {}, cluster int, distance long".format(points.schema["vec_id"].dataType.simpleString())
    if not len(centroids):
        none = points.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none.withColumn("centroid_sha256", F.lit(""))
    rotated = Rotated(*_rotation(points, length), min(leading, length))

    def stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotated.place(_matrix(batch.column(1), np.float64))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(lead) + 1, dtype=np.int32) * lead.shape[1]), pa.array(lead.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat, pa.array(rest)], ["vec_id", "point", "lead", "rest"])

    schema = points.schema.add("lead", T.ArrayType(T.DoubleType())).add("rest", "double")
    stored = kept(points.select("vec_id", "point").mapInArrow(stored_rows, schema), "rotated")
    for _ in range(rounds):
        centroids = _moved(stored, centroids, rotated)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, points_, lead, rest in _strips(batches):
            best, distance, _ = nearest(points_, lead, rest, centroids, rotated)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    rows = kept(stored.mapInArrow(assigned, out), "assigned")
    own = dict(rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect())  # a row per centroid
    digests = [(c, int(own.get(c, 0)), hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest()) for c, x in enumerate(centroids)]
    table = spark.createDataFrame(digests, "cluster int, cluster_inertia long, centroid_sha256 string")
    whole = F.lit(int(sum(own.values()))).cast("long").alias("inertia")
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", whole, "centroid_sha256")
