"""Centroid clustering of integer vectors, nearest centroids found by partial distances.

Every round is a pass over the stored vectors. A task finds the nearest centroid of its vectors and sums up each
cluster's components, so that a round sends as many rows as there are clusters from a task, and the driver holds the
centroids only. Components and sums are integers, so nothing depends on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import prepare, store, trimmed

WIDTH, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
#: Components are held within this, which is 524,288 before scaling: squared distances then fit 64 bits.
LARGEST = 1 << 27
#: Dimensions that are summed up before a centroid is looked at again.
STEP = 8
#: Vectors that are compared at a time.
SLICE = 8192


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector; of equally near ones the smaller number.

    ``order`` has all dimensions, those of high variance first. The first STEP of them are summed up for all centroids,
    which then come by that partial distance. A centroid is abandoned once its partial distance is above the best whole
    one so far; as later ones begin no lower, a vector whose next centroid begins above its best is done.
    """
    x, c = vectors[:, order], centroids[:, order]
    n, k = len(x), len(c)
    begun = np.zeros((n, k), dtype=np.int64)
    for d in range(min(STEP, x.shape[1])):
        begun += (x[:, d, None] - c[None, :, d]) ** 2
    by = np.argsort(begun, axis=1, kind="stable")
    best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    rows = np.arange(n)
    for place in range(k):
        which = by[rows, place]
        partial = begun[rows, which]
        open_ = partial <= best[rows]
        rows, which, partial = rows[open_], which[open_], partial[open_]
        if not len(rows):
            break
        at, of, total = rows, which, partial
        for a in range(STEP, x.shape[1], STEP):
            total = total + ((x[at, a : a + STEP] - c[of, a : a + STEP]) ** 2).sum(axis=1)
            stays = total <= best[at]
            at, of, total = at[stays], of[stays], total[stays]
        better = (total < best[at]) | (of < number[at])
        best[at[better]], number[at[better]] = total[better], of[better]
    return number, best


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, WIDTH).astype(np.int64)


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, v: floor(256 x) of each component as packed 32-bit integers, of the vectors that are whole."""
    whole = F.size("embedding") == WIDTH
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("embedding").isNotNull() & whole & finite)

    @trimmed
    def pack(batches):
        for batch in batches:
            values = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            whole = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in whole], pa.binary())], names=["vec_id", "v"])

    prepare(vectors.sparkSession)
    return rows.mapInArrow(pack, "vec_id long, v binary")


def _sums(vectors: DataFrame, centroids: np.ndarray, order: np.ndarray) -> list:
    """(cluster, rows, sum of each component) of every cluster that has rows."""

    @trimmed
    def partial(batches):
        count, total = np.zeros(len(centroids), dtype=np.int64), np.zeros((len(centroids), WIDTH), dtype=np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                x = _matrix(batch.column(0).slice(a, SLICE))
                number, _ = nearest(x, centroids, order)
                count += np.bincount(number, minlength=len(centroids))
                np.add.at(total, number, x)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    parts = vectors.select("v").mapInArrow(partial, "cluster int, n long, s array<long>")
    exact = [F.sum(F.col("s")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(WIDTH)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()


def _variances(vectors: DataFrame) -> np.ndarray:
    """Dimensions by falling variance; only speed depends on it, so doubles will do."""

    @trimmed
    def partial(batches):
        n, s, q = 0, np.zeros(WIDTH), np.zeros(WIDTH)
        for batch in batches:
            x = _matrix(batch.column(0)).astype(np.float64)
            n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([s.tolist()]), pa.array([q.tolist()])], names=["n", "s", "q"])

    parts = vectors.select("v").mapInArrow(partial, "n double, s array<double>, q array<double>")
    row = parts.agg(F.sum("n"), *(F.sum(F.col(k)[d]) for k in "sq" for d in range(WIDTH))).first()
    if not row[0]:
        return np.arange(WIDTH)
    s, q = np.array(row[1 : WIDTH + 1]) / row[0], np.array(row[WIDTH + 1 :]) / row[0]
    return np.argsort(-np.round(q - s * s, 6), kind="stable")


def _first(vectors: DataFrame, clusters: int) -> np.ndarray:
    """The ``clusters`` vectors with the smallest hashes of their ids: at most so many rows come to the driver."""
    by = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(by.alias("h"), "vec_id", "v").orderBy("h", "vec_id", "v").limit(clusters).collect()
    return np.array([np.frombuffer(r["v"], dtype="<i4") for r in rows], dtype=np.int64).reshape(-1, WIDTH)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of each whole vector; the final centroids).

    ``vectors`` (vec_id, embedding: array of numbers): those that are null, have other than 64 components, or any that
    is null or not finite are left out, as are other columns. Components beyond 524,288 count as that. Repeated rows
    and ids each count; a null id hashes as '2:'. With fewer vectors than clusters there are as many clusters as
    vectors; an empty table gives no rows. Equally near centroids: the smaller number.
    """
    held = store(quantised(vectors), "vectors")
    order, centroids = _variances(held), _first(held, clusters)
    for _ in range(rounds if len(centroids) else 0):
        for r in _sums(held, centroids, order):
            centroids[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(WIDTH)]

    @trimmed
    def assigned(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                number, best = nearest(_matrix(batch.column(1).slice(a, SLICE)), centroids, order)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, SLICE), pa.array(number.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return held.mapInArrow(assigned, "vec_id long, cluster int, distance long"), centroids


def digests(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each whole vector, as cluster() has them."""
    rows, centroids = cluster(vectors, clusters, rounds)
    rows = store(rows, "clusters")
    spark = vectors.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    table = [(k, sums.get(k, 0), sum(sums.values()), d) for k, d in enumerate(digests(centroids))]
    # A row for each cluster.
    of = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
