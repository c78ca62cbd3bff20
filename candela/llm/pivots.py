"""Exact integer k-means with a LAESA table: distances of all vectors to a few fixed pivots, stored once.

For a pivot p the triangle inequality gives |d(v, p) - d(c, p)| <= d(v, c). In every round the few centroids are
measured against the pivots; the largest difference over all pivots bounds a vector's distance to a centroid from below.
Centroids are tried in the order of their bounds, and only those whose bound does not exceed the best distance
so far get an exact integer distance. Bounds are widened by more than the rounding error, so ties stay ties.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.session import materialize

PIVOTS = 12
#: Vectors, in order of a hash, among which the pivots are chosen.
PIVOT_SAMPLE = 512
#: Components beyond this cannot be squared and added exactly in 64 bits.
LARGEST = 1 << 16
#: Vectors measured at once.
BLOCK = 4096


def integer_vectors(vectors: DataFrame, components: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component of the vectors that have ``components`` usable ones."""
    fits = (F.size("embedding") == components) & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) <= LARGEST), F.lit(False)))
    usable = vectors.select("vec_id", F.when(fits, F.col("embedding")).alias("embedding")).where("embedding is not null")
    return usable.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; equal ids in the order of their components."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    chosen = kept.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    return np.array([row.v for row in chosen], np.int64).reshape(len(chosen), -1)


def choose_pivots(some: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Pivots far apart: each next one has the largest sum of distances to those before."""
    if not len(some):
        return some
    chosen, total = [0], np.zeros(len(some))
    while len(chosen) < min(count, len(some)):
        total += np.sqrt(((some - some[chosen[-1]]) ** 2).sum(1))
        total[chosen] = -1
        chosen.append(int(total.argmax()))
    return some[chosen]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _to_pivots(pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                v = _matrix(part.column("v"), np.int64)
                table = np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in pivots], 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, table.size + 1, len(pivots), np.int32)), pa.array(table.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), lists], names=["vec_id", "v", "to_pivots"])

    return run


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each vector's nearest centroid, and how many distances were computed."""
    of_centroids = np.sqrt(((centroids[:, None] - pivots[None]) ** 2).sum(2))
    bound = np.abs(to_pivots[:, None] - of_centroids[None]).max(2)
    order = np.argsort(bound, 1, kind="stable")
    best = np.full(len(v), np.iinfo(np.int64).max)
    number = np.full(len(v), len(centroids))
    measured = 0
    for j in range(len(centroids)):
        c = order[:, j]
        near = np.flatnonzero(bound[np.arange(len(v)), c] * (1 - 1e-9) - 1e-3 <= np.sqrt(best.astype(float)))
        if not len(near):
            break  # the bounds only grow
        d = ((v[near] - centroids[c[near]]) ** 2).sum(1)
        measured += len(near)
        better = (d < best[near]) | ((d == best[near]) & (c[near] < number[near]))
        best[near[better]], number[near[better]] = d[better], c[near[better]]
    return number, best, measured


def _blocks(batches):
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _matrix(part.column("v"), np.int64), _matrix(part.column("to_pivots"), float)


def _partial_sums(centroids, pivots):
    def run(batches):
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, v, to_pivots in _blocks(batches):
            number, _, _ = nearest(v, to_pivots, centroids, pivots)
            np.add.at(sums, number, v)
            counts += np.bincount(number, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _assigned(centroids, pivots):
    def run(batches):
        for part, v, to_pivots in _blocks(batches):
            number, best, _ = nearest(v, to_pivots, centroids, pivots)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", components: int = 64) -> DataFrame:
    """One row per kept vector row: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``components`` components, none null, NaN, infinite or beyond LARGEST in size. Of
    equally near centroids the smaller number wins; an empty one stays where it is. With fewer than ``k`` kept vectors
    there are fewer centroids. Rows that share an id are vectors of their own, a null id hashes as the text 'null'. An
    empty table gives an empty result; other columns are ignored, whatever their names.
    """
    kept = integer_vectors(vectors, components)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    sampled = kept.orderBy(F.xxhash64("vec_id"), "v").limit(PIVOT_SAMPLE).select("v").collect()  # PIVOT_SAMPLE rows
    if not sampled:
        return kept.selectExpr("vec_id", "0 as cluster", *(f"0L as {c}" for c in ("distance", "cluster_inertia", "inertia")), "'' as centroid_sha256").where("vec_id <> vec_id")
    pivots = choose_pivots(np.array([row.v for row in sampled], np.int64))
    table = materialize(kept.mapInArrow(_to_pivots(pivots), f"vec_id {kind}, v array<long>, to_pivots array<double>"), "pivot-table")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds):
        parts = table.mapInArrow(_partial_sums(centroids, pivots), "cluster long, n long, sums array<long>")
        sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(components))).alias("sums"))
        moved = centroids.copy()
        for row in sums.collect():  # k rows
            moved[row.cluster] = [s // row.n for s in row.sums]
        if (moved == centroids).all():
            break  # every further round would be the same
        centroids = moved
    found = materialize(table.mapInArrow(_assigned(centroids, pivots), f"vec_id {kind}, cluster int, distance long"), "clusters")
    inertia = {row.cluster: row.s for row in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [(c, inertia.get(c, 0), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    about = table.sparkSession.createDataFrame(digests, "cluster int, cluster_inertia long, centroid_sha256 string")  # k rows
    joined = found.join(F.broadcast(about), "cluster").withColumn("inertia", F.lit(sum(inertia.values())).cast("long"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
