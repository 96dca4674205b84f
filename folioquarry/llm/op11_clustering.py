"""Centroid clustering with Elkan's bounds; exact in integers.

A vector's components become integers, ``floor(scale * x)``. Centroids are integer vectors, a few rows that the driver
holds (``k`` times ``dims`` numbers). A round passes once over the vectors; what is known of each stays with it in a written
table: its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to each of the k
centroids. After the centroids have moved, bounds move by as much. A vector is measured only where its upper bound
reaches half the distance to the next centroid, and then only against centroids whose own lower bound, and whose half distance
from the vector's centroid, it reaches.

Ties. Bounds are rounded outwards, to 32 bits, and only a centroid that is strictly farther is skipped, so that one
at an equal distance is always measured; measured distances are exact integers, and the smaller number wins.

The pass that assigns also sums: a task gives one row a cluster, with the sum and the count of its vectors, which Spark adds up
in decimals. Nothing is dealt by cluster, so a cluster of all rows is no hot key.

Defined results. Vectors of another length, with a null or with a component that is not finite are left out; an empty table gives no
rows. Every kept row counts, rows with one id or one vector included. Ids are of any type that can be text; rows without an id begin a
cluster only where others are too few. With fewer vectors than ``k`` there are as many clusters as vectors. Integers beyond
``LIMIT`` count as ``LIMIT``, so that squares fit into a long; sums of distances beyond a long count as its greatest.
Columns but ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, scratch, written

#: The greatest absolute value of a component.
LIMIT = 1 << 27
LONGEST = (1 << 63) - 1
#: Relative error of a square root of a converted long, generously.
SLACK = 1e-15
_LOW = 31


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, x): the vectors that count, in integers."""
    kept = vectors.select("vec_id", "embedding").where(
        (F.size("embedding") == dims) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    )
    scaled = F.transform("embedding", lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return kept.select("vec_id", scaled.alias("x"))


def first_centroids(whole: DataFrame, k: int) -> np.ndarray:
    """The k vectors of least SHA-256 of ``1:<vec_id>``, in that order."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = whole.orderBy(F.col("vec_id").isNull(), name, "x").select("x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    apart = x - c
    return (apart * apart).sum(axis=-1)


def above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + SLACK)


def below(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - SLACK)


class Bounds:
    """A batch of vectors with its bounds, against one set of centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.half = below(_squared(centroids[:, None], centroids[None])) / 2
        others = self.half.copy()
        np.fill_diagonal(others, np.inf)
        self.nearest = others.min(axis=1)

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, all_exact: bool) -> tuple[np.ndarray, int]:
        """Sets ``cluster`` and both bounds; returns exact squared distances, where measured, and how many were measured."""
        open_ = upper >= self.nearest[cluster]
        rows = np.arange(len(x)) if all_exact else np.flatnonzero(open_)
        exact, measured = np.full(len(x), -1, dtype=np.int64), len(rows)
        own = cluster[rows]
        exact[rows] = _squared(x[rows], self.centroids[own])
        upper[rows], lower[rows, own] = above(exact[rows]), below(exact[rows])
        for j in range(len(self.centroids)):
            rows = np.flatnonzero(open_ & (cluster != j) & (upper >= lower[:, j]) & (upper >= self.half[cluster, j]))
            found = _squared(x[rows], self.centroids[j])
            measured += len(rows)
            lower[rows, j] = below(found)
            nearer = (found < exact[rows]) | ((found == exact[rows]) & (j < cluster[rows]))
            moved = rows[nearer]
            cluster[moved], exact[moved], upper[moved] = j, found[nearer], above(found[nearer])
        return exact, measured


def _assigned(centroids: np.ndarray, shift: np.ndarray | None, last: bool):
    """(vec_id, x[, cluster, upper, lower]) -> the same after one assignment, and a row of sums for each cluster of the task."""
    k, dims = centroids.shape

    def run(batches):
        import pyarrow as pa

        def floats(values):
            return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * k), pa.array(values.ravel()))

        bounds = Bounds(centroids)
        sums, members = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        parts, measured, empty = np.zeros((k, 2), dtype=object), 0, None
        for batch in batches:
            n = len(batch)
            empty = batch.slice(0, 0)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, dims).astype(np.int64)
            if shift is None:
                cluster, upper, lower = np.zeros(n, dtype=np.int32), np.full(n, np.inf), np.zeros((n, k))
            else:
                cluster = batch.column(2).to_numpy(zero_copy_only=False).copy()
                upper = (batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64) + shift[cluster]) * (1 + SLACK)
                lower = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(n, k).astype(np.float64)
                lower = np.maximum(lower - shift, 0) * (1 - SLACK)
            exact, count = bounds.assign(x, cluster, upper, lower, last)
            measured += count
            members += np.bincount(cluster, minlength=k)
            if last:
                for part, value in enumerate((exact >> _LOW, exact & ((1 << _LOW) - 1))):
                    each = np.zeros(k, dtype=np.int64)
                    np.add.at(each, cluster, value)
                    parts[:, part] += each
            else:
                np.add.at(sums, cluster, x)
            null = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.nulls(n, pa.list_(pa.int32())) if last else batch.column(1), pa.array(cluster), pa.array(exact),
                 pa.array(np.nextafter(upper.astype(np.float32), np.float32(np.inf))),
                 pa.nulls(n, pa.list_(pa.float32())) if last else floats(np.maximum(np.nextafter(lower.astype(np.float32), np.float32(-np.inf)), np.float32(0))),
                 null, pa.nulls(n, pa.list_(pa.int64())), null],
                names=NAMES,
            )
        if empty is not None:
            rows = np.flatnonzero(members)
            values = parts.astype(np.int64) if last else sums
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), empty.column(0).type), pa.nulls(len(rows), pa.list_(pa.int32())), pa.array(rows.astype(np.int32)), pa.nulls(len(rows), pa.int64()),
                 pa.nulls(len(rows), pa.float32()), pa.nulls(len(rows), pa.list_(pa.float32())), pa.array(members[rows]), pa.array(values[rows].tolist(), pa.list_(pa.int64())),
                 pa.array([measured if i == 0 else 0 for i in range(len(rows))], pa.int64())],
                names=NAMES,
            )

    return run


NAMES = ["vec_id", "x", "cluster", "distance", "upper", "lower", "members", "sums", "measured"]


def _pass(state: DataFrame, centroids: np.ndarray, shift: np.ndarray | None, last: bool, keep: bool = False) -> DataFrame:
    kinds = T._parse_datatype_string("x array<int>, cluster int, distance bigint, upper float, lower array<float>, members bigint, sums array<bigint>, measured bigint")
    schema = T.StructType([T.StructField("vec_id", state.schema["vec_id"].dataType), *kinds.fields])
    return written(mapped(state, _assigned(centroids, shift, last), schema), keep=keep)


def moved(centroids: np.ndarray, table: DataFrame) -> np.ndarray:
    """The centroids after a round: floors of exact means; a centroid without vectors stays."""
    each = table.where("members IS NOT NULL").select("cluster", "members", F.posexplode("sums").alias("at", "value"))
    rows = each.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members")).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.at] = int(r.total) // r.members
    return out


def cluster_vectors(vectors: DataFrame, dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid): a row for each vector that counts; distances are squared."""
    spark = vectors.sparkSession
    with scratch(spark):
        whole = written(whole_vectors(vectors, dims, scale))
        centroids = first_centroids(whole, k)
        if not len(centroids):
            return whole.where("false").selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "x AS centroid").limit(0)
        state, shift = whole, None
        for _ in range(rounds):
            table = _pass(state, centroids, shift, last=False)
            after = moved(centroids, table)
            shift, centroids = above(_squared(after, centroids)), after
            state = table.where("members IS NULL").select("vec_id", "x", "cluster", "upper", "lower")
        table = _pass(state, centroids, shift, last=True, keep=True)
    total = lambda i: F.sum(F.element_at("sums", i).cast("decimal(38,0)"))
    sums = table.where("members IS NOT NULL").groupBy("cluster").agg((total(1) * (1 << _LOW) + total(2)).cast("decimal(38,0)").alias("own")).collect()
    long = lambda value: min(int(value), LONGEST)
    inertia = long(sum(int(r.own) for r in sums))
    known = spark.createDataFrame(
        [(r.cluster, long(r.own), inertia, centroids[r.cluster].tolist()) for r in sums], "cluster int, cluster_inertia bigint, inertia bigint, centroid array<int>"
    )
    rows = table.where("members IS NULL").select("vec_id", "cluster", "distance")
    # k rows at most
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def clustered_rows(vectors: DataFrame) -> DataFrame:
    """The clusters of 64 components in 16 clusters and 3 rounds, with the digest of each centroid."""
    found = cluster_vectors(vectors)
    digest = F.sha2(F.array_join(F.transform("centroid", lambda v: v.cast("string")), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")
