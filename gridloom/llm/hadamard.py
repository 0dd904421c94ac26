"""Centroid clustering of whole-number vectors with nearest centroids by Walsh-Hadamard progressive search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.session import fresh_path

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3

# Whole numbers are held within this bound, so that 64 squared differences of transformed vectors fit in 63 bits.
BOUND = 1 << 24

# Coefficients are added in these steps, coarse to fine; after the marked ones the leading centroid of a vector is finished,
# which bounds the distance of its nearest.
STEPS = ((0, 1, False), (1, 2, False), (2, 4, True), (4, 8, False), (8, 16, True), (16, 32, True), (32, 64, False))

# Vectors whose coefficients are worked on at once.
ROWS = 4096


def hadamard(size: int = DIMENSIONS) -> np.ndarray:
    """The Hadamard matrix with its rows in the order of their sign changes: coarse to fine."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


TRANSFORM = hadamard()


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid (the smaller number on ties) of each whole-number vector and the squared distance.

    The transform multiplies squared distances by 64, so sums of squared differences of coefficients grow towards 64
    times the distance. A centroid whose sum so far exceeds a distance that another one has is strictly worse and leaves;
    those that stay are finished to the last coefficient, so the result is exact.
    """
    number, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    there = centroids @ TRANSFORM.T
    for at in range(0, len(vectors), ROWS):
        here = vectors[at : at + ROWS] @ TRANSFORM.T
        n, k = len(here), len(there)
        row, centre = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
        total = np.zeros(n * k, dtype=np.int64)
        bound = np.full(n, np.iinfo(np.int64).max)
        for low, high, lead in STEPS:
            total += ((here[row, low:high] - there[centre, low:high]) ** 2).sum(axis=1)
            if lead:
                first = first_least(row, total)
                rest = ((here[:, high:] - there[centre[first], high:]) ** 2).sum(axis=1)
                bound = np.minimum(bound, total[first] + rest)
                stays = total <= bound[row]
                row, centre, total = row[stays], centre[stays], total[stays]
        first = first_least(row, total)
        number.append(centre[first])
        distance.append(total[first] // DIMENSIONS)
    return np.concatenate(number), np.concatenate(distance)


def first_least(row: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The place of the first least ``total`` of each row; ``row`` is in order and has all rows."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.flatnonzero(total == np.minimum.reduceat(total, starts)[row])
    return least[np.flatnonzero(np.r_[True, row[least][1:] != row[least][:-1]])]


def whole_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``_key`` and ``_vector``, floor(64 * x) of each component, of the vectors with 64 components that are all finite."""
    given = F.col(f"`{vector}`")
    fine = (F.size(given) == DIMENSIONS) & F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(given, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(BOUND))), F.lit(float(-BOUND)))))
    return embeddings.filter(fine).select(F.col(f"`{key}`").alias("_key"), scaled.alias("_vector"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, DIMENSIONS)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the least SHA-256 of ``seed:key``, a null key last; equal keys are in the order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_key").cast("string")), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "_vector").limit(count).collect()
    return np.array([r["_vector"] for r in rows], dtype=np.int64).reshape(-1, DIMENSIONS)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of their vectors by component; one without vectors stays.

    A task adds up its own vectors, so it sends no more than one row per centroid and component.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            own = matrix(batch.column("_vector"))
            number, _ = nearest(own, centroids)
            for c in range(len(centroids)):
                sums[c] += own[number == c].sum(axis=0)
            counts += np.bincount(number, minlength=len(centroids))
        for c in np.flatnonzero(counts).tolist():
            columns = [pa.array([c] * DIMENSIONS, pa.int32()), pa.array(range(DIMENSIONS), pa.int32()), pa.array(sums[c]), pa.array([int(counts[c])] * DIMENSIONS, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "i", "total", "n"])

    parts = vectors.select("_vector").mapInArrow(add, "cluster int, i int, total long, n long")
    rows = parts.groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["i"]] = int(r["total"]) // r["n"]
    return out


def cluster(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 1
) -> DataFrame:
    """Each kept vector's ``_key``, ``cluster``, ``distance`` (squared, in 64ths), ``cluster_inertia`` and ``inertia`` (distances
    summed over its cluster and over all) and ``centroid_sha256`` (of the final centroid's components, comma-joined).

    Vectors that are null, of another length, or with a null or non-finite component are not kept. Repeated rows are
    vectors of their own; with fewer vectors than ``count`` there are fewer centroids, with none there is no row. A null key is
    a key like others but comes last for the first centroids. Components beyond 262,144 are held there. Other columns
    of ``embeddings`` are not looked at.

    Centroids (16 of 64 numbers) are all that passes the driver; vectors are read once per round, and stay where they are.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, key, vector)
    schema = T.StructType([vectors.schema.fields[0], *T.StructType.fromDDL("cluster int, distance long").fields])
    centroids = first_centroids(vectors, count, seed)
    if not len(centroids):
        empty = T.StructType([*schema.fields, *T.StructType.fromDDL("cluster_inertia long, inertia long, centroid_sha256 string").fields])
        return spark.createDataFrame([], empty)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = nearest(matrix(batch.column("_vector")), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(number.astype(np.int32)), pa.array(distance)], names=schema.names)

    path = fresh_path(spark, "clusters")
    vectors.mapInArrow(assign, schema).write.parquet(path)
    assigned = spark.read.parquet(path)
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    largest = (1 << 63) - 1  # a sum beyond it is held there
    by_cluster = F.array(*[F.lit(min(sums.get(c, 0), largest)).cast("long") for c in range(len(centroids))])
    return assigned.select(
        "*", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"), F.lit(min(sum(sums.values()), largest)).cast("long").alias("inertia"),
        F.get(F.array(*[F.lit(d) for d in digests]), F.col("cluster")).alias("centroid_sha256"),
    )
