"""Centroid clustering in integers with PCA-rotated filtering.

Vectors are rotated onto their principal axes once; the leading coordinates and the norm of all the others are stored
beside the integers. The squared distance of the leading coordinates plus the squared difference of the two norms is
never above the squared distance to a centroid, so most centroids are ruled out without a look at the integers; those
that survive are verified in integers. Sums, means and distances are exact, the same on every run and layout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.columns import prepared, stage

DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
# Rotated coordinates that are stored; the others count by their norm.
LEADING = 8
# Components from here on would take a squared distance out of a long's range; such vectors are not kept.
COMPONENT_LIMIT = float(1 << 17)
# Rounding of the lower bound, in parts of the squared norms of vector and centroid.
SLACK = 1e-9

Batches = Iterator[pa.RecordBatch]


def keepable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, all of them finite numbers below COMPONENT_LIMIT."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < COMPONENT_LIMIT))
    return F.coalesce((F.size(vector) == dims) & inside, F.lit(False))


def integers(rows: DataFrame, id_col: str, vector: str, dims: int = DIMS) -> DataFrame:
    """(id, x): the vectors that are kept, each component as floor(SCALE * component)."""
    doubles = rows.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    scaled = F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("int"))
    return doubles.filter(keepable(F.col("v"), dims)).select("id", scaled.alias("x"))


@dataclass(frozen=True)
class Rotation:
    """An orthonormal change of axes about a point, the widest axes first."""

    centre: np.ndarray
    axes: np.ndarray

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates, and the norm of the others, of each row."""
        turned = (x - self.centre) @ self.axes
        return turned[:, :LEADING], np.linalg.norm(turned[:, LEADING:], axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def rotation(vectors: DataFrame, dims: int) -> Rotation:
    """The principal axes of all vectors, from sums that every task hands over once."""
    def sums(batches: Batches) -> Batches:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = _matrix(batch.column(0), dims).astype(np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    each = vectors.select("x").mapInArrow(sums, "sums array<double>").select(F.posexplode("sums").alias("at", "part"))
    added = each.groupBy("at").agg(F.sum("part").alias("sum")).collect()
    total = np.zeros((dims + 1) ** 2)
    for row in added:
        total[row["at"]] = row["sum"]
    total = total.reshape(dims + 1, dims + 1)
    count = max(1.0, total[-1, -1])
    centre = total[-1, :-1] / count
    spread = total[:-1, :-1] / count - np.outer(centre, centre)
    return Rotation(centre, np.linalg.eigh(spread)[1][:, ::-1])


def rotated(vectors: DataFrame, turn: Rotation, dims: int) -> DataFrame:
    """(id, x, lead, rest): the integers packed, the leading coordinates packed, and the norm of the others."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch.column("x"), dims).astype("<i4")
            lead, rest = turn.split(x)
            packed = [pa.array([row.tobytes() for row in side], pa.binary()) for side in (x, lead.astype("<f8"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *packed, pa.array(rest)], names=["id", "x", "lead", "rest"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {id_type}, x binary, lead binary, rest double")


@dataclass(frozen=True)
class Centroids:
    """Integer centroids beside their rotated forms."""

    points: np.ndarray
    lead: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(points: list[list[int]], turn: Rotation) -> Centroids:
        whole = np.array(points, dtype=np.int64)
        return Centroids(whole, *turn.split(whole))

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each row, the smaller number if two are equally near; its squared distance; and
        how many distances were worked out in integers."""
        least = (rest[:, None] - self.rest) ** 2
        for axis in range(self.lead.shape[1]):
            least += (lead[:, axis, None] - self.lead[:, axis]) ** 2
        norms = (lead**2).sum(axis=1) + rest**2
        slack = SLACK * (norms[:, None] + (self.lead**2).sum(axis=1) + self.rest**2) + 1e-6
        cluster = least.argmin(axis=1)
        distance = _squared(x, self.points[cluster])
        open_to = least - slack <= distance[:, None]
        open_to[np.arange(len(x)), cluster] = False
        verified = len(x)
        for number in range(len(self.points)):
            rows = np.flatnonzero(open_to[:, number])
            found = _squared(x[rows], self.points[number])
            verified += len(rows)
            nearer = (found < distance[rows]) | (found == distance[rows]) & (number < cluster[rows])
            cluster[rows[nearer]], distance[rows[nearer]] = number, found[nearer]
        return cluster, distance, verified


def _squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    apart = x.astype(np.int64) - points
    return np.einsum("ij,ij->i", apart, apart)


def _assigned(batch: pa.RecordBatch, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The integers of a batch, and each row's cluster and distance."""
    packed = [b"".join(batch.column(c).to_pylist()) for c in ("x", "lead")]
    x = np.frombuffer(packed[0], "<i4").reshape(batch.num_rows, -1)
    lead = np.frombuffer(packed[1], "<f8").reshape(batch.num_rows, -1)
    return x, *centroids.nearest(x, lead, np.asarray(batch.column("rest")))[:2]


def _cluster_sums(centroids: Centroids) -> Callable[[Batches], Batches]:
    """Per task and cluster the number of its vectors, and behind it the sum of each component."""
    def run(batches: Batches) -> Batches:
        k, dims = centroids.points.shape
        sums = np.zeros((k, dims + 1), dtype=np.int64)
        for batch in batches:
            x, cluster, _ = _assigned(batch, centroids)
            for number in range(k):
                own = x[cluster == number]
                sums[number, 0] += len(own)
                sums[number, 1:] += own.sum(axis=0, dtype=np.int64)
        filled = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(sums[filled].tolist(), pa.list_(pa.int64()))], names=["cluster", "sums"])
    return run


def moved(vectors: DataFrame, points: list[list[int]], turn: Rotation) -> list[list[int]]:
    """The centroids after one round: the floors of their vectors' means; a centroid without vectors stays."""
    each = vectors.mapInArrow(_cluster_sums(Centroids.of(points, turn)), "cluster int, sums array<long>")
    parts = each.select("cluster", F.posexplode("sums").alias("at", "part"))
    total = parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("sum"))
    sums = {(row["cluster"], row["at"]): int(row["sum"]) for row in total.collect()}
    return [
        [sums[c, i + 1] // sums[c, 0] for i in range(len(point))] if (c, 0) in sums else point
        for c, point in enumerate(points)
    ]


def first_points(vectors: DataFrame, k: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; rows with one id follow each other by their components."""
    text = F.concat(F.lit("3:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    hashed = vectors.select(F.sha2(text.cast("binary"), 256).alias("hash"), "x")
    return [list(row["x"]) for row in hashed.orderBy("hash", "x").limit(k).collect()]


def clusters(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = DIMS,
             k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    Kept are vectors of ``dims`` components, none of them null or not finite; those with a component of 131,072 or
    more, whose distances a long may not hold, are not kept either. Repeated rows and rows with one id are vectors of
    their own, a null id hashes like an empty one. With fewer than ``k`` vectors each starts a cluster; none give an
    empty result. An inertia that a long cannot hold is null. The driver sees k centroids and their sums, and the
    sums of products of components; nothing that grows with the table.
    """
    prepared(rows.sparkSession)
    vectors = integers(rows, id_col, vector, dims)
    points = first_points(vectors, k)
    id_type = vectors.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, cluster int, distance long"
    if not points:
        nothing = [F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]
        return vectors.filter(F.lit(False)).select(F.col("id").alias(id_col), *nothing)
    turn = rotation(vectors, dims)
    turned = stage(rotated(vectors, turn, dims), "centroid-vectors")
    for _ in range(rounds):
        points = moved(turned, points, turn)

    def run(batches: Batches) -> Batches:
        centroids = Centroids.of(points, turn)
        for batch in batches:
            _, cluster, distance = _assigned(batch, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    assigned = stage(turned.mapInArrow(run, schema), "centroid-assigned")
    total = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    inertia = {row["cluster"]: int(row["sum"]) for row in total.collect()}
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]

    def held(value: int) -> int | None:
        return value if value < 1 << 63 else None

    of_cluster = F.array(*(F.lit(held(inertia.get(c, 0))).cast("long") for c in range(len(points))))
    return assigned.select(
        F.col("id").alias(id_col), "cluster", "distance", F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(held(sum(inertia.values()))).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"))
