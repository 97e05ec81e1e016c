"""Operator 11: centroid clustering with Ptolemaic pivots.

Vectors are integers, so distances, means and ties are exact.  The start centroids are the pivots.  Every vector keeps its distances to
the pivots, computed once.  In a Euclidean space Ptolemy's inequality gives, for a pivot pair (p, s), a vector x and a centroid c,

    d(x, c) * d(p, s)  >=  | d(x, p) * d(c, s) - d(x, s) * d(c, p) |,

a lower bound that needs nothing but cached distances.  Bounds are rounded down by more than double precision can err; a centroid whose bound isn't above
the best exact distance so far is compared exactly.

A round is one pass over the written vectors: tasks send counts and sums by centroid, Spark adds them up, and the driver gets one row for each centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

DIMS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: The scaled length of a vector, at most: then every squared distance fits a long.
LONGEST = 1 << 30
#: Relative error of a bound, with room to spare.
SLACK = 2.0**-46


def squared(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows (int64) to one vector."""
    away = rows - to
    return np.einsum("nd,nd->n", away, away)


class Pivots:
    """Fixed vectors, and the pairs of them that bounds are taken from."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = np.unique(vectors, axis=0)
        self.pairs = list(combinations(range(len(self.vectors)), 2))
        self.apart = [float(np.sqrt(squared(self.vectors[a : a + 1], self.vectors[b])[0])) for a, b in self.pairs]

    def distances(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(rows, p) for p in self.vectors], axis=1).astype(np.float64))

    def below(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """For each row and centroid a number that their squared distance is never below."""
        to = self.distances(centroids)
        best = np.zeros((len(cached), len(centroids)))
        for (a, b), apart in zip(self.pairs, self.apart, strict=True):
            x, y = cached[:, a, None] * to[None, :, b], cached[:, b, None] * to[None, :, a]
            np.maximum(best, (np.abs(x - y) - SLACK * (x + y)) / apart, out=best)
        return best * best * (1 - SLACK)


def assign(rows: np.ndarray, cached: np.ndarray, pivots: Pivots, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each row (ties: smaller number), the squared distance, and how many centroids were compared exactly."""
    below = pivots.below(cached, centroids)
    nearest = below.argmin(axis=1)
    distance = np.empty(len(rows), np.int64)
    for c in range(len(centroids)):
        at = np.flatnonzero(nearest == c)
        distance[at] = squared(rows[at], centroids[c])
    first, compared = nearest.copy(), np.ones(len(rows), np.int64)
    for c in range(len(centroids)):
        at = np.flatnonzero((below[:, c] <= distance * (1 + SLACK)) & (first != c))
        d = squared(rows[at], centroids[c])
        compared[at] += 1
        better = (d < distance[at]) | (d == distance[at]) & (c < nearest[at])
        nearest[at[better]], distance[at[better]] = c, d[better]
    return nearest, distance, compared


def whole_numbers(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector) of the rows of (vec_id, embedding) that have ``dims`` components, none of them null or non-finite; components are
    floor(scale * x). A vector whose scaled length is LONGEST or more is left out too: its squared distances need not fit a long."""
    v = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    sound = (F.size("x") == dims) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    short = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c) < float(LONGEST // scale) ** 2
    return v.where(F.when(sound, short).otherwise(False)).select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("vector"))


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ``seed:vec_id`` has the smallest sha256, in that order; a null vec_id counts as no digits; ties stand in order of the vectors."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(name, "vector").select("vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64).reshape(len(rows), len(rows[0].vector) if rows else 0)


def _rows(column, kind, wide: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), wide)


def _cached(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """vec_id, the vector (32-bit) and its pivot distances (double), packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                far = pivots.distances(rows.astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in rows.astype(np.int32)], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary())], ["vec_id", "vector", "far"])

    return store.written(vectors.select(F.col("vec_id").cast("long"), "vector").mapInArrow(run, "vec_id long, vector binary, far binary"), "pivot-distances")


def _moved(table: DataFrame, pivots: Pivots, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    k, dims = centroids.shape
    names = ["n", *(f"s{i}" for i in range(dims))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            if b.num_rows:
                rows = _rows(b.column(0), np.int32, dims).astype(np.int64)
                nearest = assign(rows, _rows(b.column(1), np.float64, len(pivots.vectors)), pivots, centroids)[0]
                for c in range(k):
                    own = rows[nearest == c]
                    sums[c] += np.concatenate([[len(own)], own.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), *(pa.array(x) for x in sums.T)], ["cluster", *names])

    told = table.select("vector", "far").mapInArrow(run, "cluster int, " + ", ".join(f"{n} long" for n in names))
    out = centroids.copy()
    for r in told.groupBy("cluster").agg(*(F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in names)).collect():  # k rows
        if r.n:
            out[r.cluster] = [int(r[n]) // int(r.n) for n in names[1:]]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, compared (centroids compared exactly in the last pass), cluster_inertia, inertia and centroid_sha256 of every row of
    (vec_id, vector: array of int, all of one length).

    Rows that share a vec_id are vectors of their own, a null vec_id too; with fewer than k vectors there are as many centroids; equal centroids
    are allowed (the smaller number gets the vectors); other columns are ignored; an empty table gives no rows. An inertia that doesn't fit a
    long is null."""
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, compared int"
    centroids = starts(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    pivots = Pivots(centroids)
    table = _cached(vectors, pivots)
    for _ in range(rounds):
        moved = _moved(table, pivots, centroids)
        if (moved == centroids).all():
            break  # all further rounds give the same
        centroids = moved
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                nearest, distance, compared = assign(_rows(b.column(1), np.int32, dims).astype(np.int64), _rows(b.column(2), np.float64, len(pivots.vectors)), pivots, centroids)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nearest.astype(np.int32)), pa.array(distance), pa.array(compared.astype(np.int32))], ["vec_id", "cluster", "distance", "compared"])

    last = store.written(table.mapInArrow(run, schema), "clusters")
    total = {r.cluster: int(r.d) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    fits = lambda x: x if x < 1 << 63 else None
    told = [(c, fits(total.get(c, 0)), fits(sum(total.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in range(len(centroids))]
    return last.join(F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of ``embeddings`` that ``whole_numbers`` keeps; ties, repeats, nulls and empty tables: see ``cluster``."""
    return cluster(whole_numbers(store.table(spark, sf_dir, "embeddings"))).drop("compared")


def _oracle() -> str:
    """The same as one common table expression for each round."""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(x, lambda c: floor({SCALE} * c)::BIGINT) AS q FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings) WHERE len(x) = {DIMS} AND len(list_filter(x, lambda c: isfinite(c))) = {DIMS} AND list_sum(list_transform(x, lambda c: c * c)) < {(LONGEST // SCALE) ** 2})",
        f"e AS MATERIALIZED (SELECT r, unnest(range({DIMS})) AS i, unnest(q) AS x FROM v)",
        f"c0 AS MATERIALIZED (SELECT n, unnest(range({DIMS})) AS i, unnest(q) AS x FROM (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS n, q FROM v QUALIFY n < {CENTROIDS}))",
    ]
    near = "(SELECT r, arg_min(n, d * {k} + n) AS n, min(d) AS d FROM (SELECT e.r, c.n, sum((e.x - c.x) * (e.x - c.x))::HUGEINT AS d FROM e JOIN c{t} c USING (i) GROUP BY ALL) GROUP BY r)"
    for t in range(ROUNDS):
        parts.append(f"a{t} AS MATERIALIZED {near.format(t=t, k=CENTROIDS)}")
        parts.append(f"m{t} AS (SELECT n, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS k FROM a{t} JOIN e USING (r) GROUP BY n, i)")
        parts.append(f"c{t + 1} AS MATERIALIZED (SELECT c.n, c.i, CASE WHEN m.k IS NULL THEN c.x ELSE ((m.s - ((m.s % m.k) + m.k) % m.k) // m.k)::BIGINT END AS x FROM c{t} c LEFT JOIN m{t} m ON m.n = c.n AND m.i = c.i)")
    parts.append(f"a AS MATERIALIZED {near.format(t=ROUNDS, k=CENTROIDS)}")
    parts.append(f"h AS (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY n)")
    return "WITH " + ",\n".join(parts) + "\nSELECT v.vec_id, a.n::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256 FROM a JOIN v USING (r) JOIN h USING (n)"


ORACLE = _oracle()
