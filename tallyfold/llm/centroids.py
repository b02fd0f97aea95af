"""Centroid clustering in whole numbers, with a PCA-rotated filter before the exact distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage

SCALE = 1024
#: Components below this in absolute value become whole numbers whose squared distances fit a long (64 * 2**56).
REACH = float(1 << 17)
#: Leading rotated coordinates that are stored beside each vector.
LEADING = 8
#: Rows of one block of distances.
BLOCK = 4096


@dataclass
class Filter:
    """A rotation about a middle: any orthonormal one gives true bounds, the principal one gives sharp ones."""

    middle: np.ndarray
    axes: np.ndarray

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the rest."""
        away = x.astype(np.float64) - self.middle
        lead = away @ self.axes
        rest = np.einsum("ij,ij->i", away, away) - np.einsum("ij,ij->i", lead, lead)
        return lead, np.sqrt(np.maximum(rest, 0.0))

    def bounds(self, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """For each row and centroid what the squared distance cannot fall below.

        That is |lead - lead_c|^2 + (rest - rest_c)^2, less the rounding of these sums.
        """
        of, behind = self.project(centroids)
        own, theirs = np.einsum("ij,ij->i", lead, lead) + rest * rest, np.einsum("ij,ij->i", of, of) + behind * behind
        norms = own[:, None] + theirs
        return norms - 2.0 * (lead @ of.T + rest[:, None] * behind) - 1e-9 * norms - 1e-3

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid; of equally near ones the smaller number.

        The centroid of least bound is measured first; every other one whose bound does not
        exceed that distance is measured too, all in 64-bit whole numbers.
        """
        bound = self.bounds(lead, rest, centroids)
        first = np.argmin(bound, axis=1)
        number, distance = first.copy(), squared(x, centroids[first])
        for k in range(len(centroids)):
            rows = np.flatnonzero((bound[:, k] <= distance) & (first != k))
            d = squared(x[rows], centroids[k])
            better = (d < distance[rows]) | ((d == distance[rows]) & (k < number[rows]))
            distance[rows[better]], number[rows[better]] = d[better], k
        return number, distance


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    away = x - c
    return np.einsum("ij,ij->i", away, away)


def _wide(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary rows of `width` numbers each, as a matrix."""
    if len(column) == 0:
        return np.empty((0, width), dtype=dtype)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype).reshape(-1, width)


def _packed(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    bounds = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def whole_vectors(table: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """(vec_key, x): the kept vectors as arrays of whole numbers floor(SCALE * component)."""
    v = F.col(vector)
    good = (F.size(v) == size) & F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(REACH)))
    kept = table.filter(v.isNotNull() & F.coalesce(good, F.lit(False)))
    return kept.select(F.col(key).alias("vec_key"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("int")).alias("x"))


def rotation(vectors: DataFrame, size: int, leading: int = LEADING) -> Filter:
    """The principal axes over all vectors; the first unit axes where there are not two vectors."""
    middle = np.zeros(size)
    n, *means = vectors.agg(F.count(F.lit(1)), *(F.avg(F.get("x", i)) for i in range(size))).first()
    if n < 2:
        return Filter(middle, np.eye(size)[:, :leading])
    doubles = vectors.select(array_to_vector(F.transform("x", lambda c: c.cast("double"))).alias("v"))
    axes = PCA(k=min(leading, size), inputCol="v", outputCol="p").fit(doubles).pc.toArray()
    axes, _ = np.linalg.qr(axes)
    return Filter(np.array(means, dtype=np.float64), axes)


def _store(vectors: DataFrame, how: Filter, size: int) -> DataFrame:
    """(vec_key, x, lead, rest), the arrays as little-endian binary, written once for all rounds."""
    key_type = dict(vectors.dtypes)["vec_key"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            x = batch.column("x").flatten().to_numpy().astype(np.int32).reshape(-1, size)
            lead, rest = how.project(x)
            yield pa.RecordBatch.from_arrays([batch.column("vec_key"), _packed(x), _packed(lead), pa.array(rest)], names=["vec_key", "x", "lead", "rest"])

    return cut_lineage(vectors.mapInArrow(rows, f"vec_key {key_type}, x binary, lead binary, rest double"))


def _assigned(batches: Iterator[pa.RecordBatch], how: Filter, centroids: np.ndarray) -> Iterator[tuple]:
    size, leading = how.axes.shape
    for batch in _blocks(batches):
        x = _wide(batch.column("x"), np.int32, size).astype(np.int64)
        lead = _wide(batch.column("lead"), np.float64, leading)
        number, distance = how.nearest(x, lead, batch.column("rest").to_numpy(), centroids)
        yield batch, x, number, distance


def _moved(stored: DataFrame, how: Filter, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floors of exact means. Each task sums its vectors, so a row a cluster and task is shuffled."""
    size, k = how.axes.shape[0], len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
        for _, x, number, _ in _assigned(batches, how, centroids):
            n += np.bincount(number, minlength=k)
            for c in range(k):
                total[c] += x[number == c].sum(axis=0)
        there = np.flatnonzero(n)
        columns = [pa.array(there), pa.array(n[there]), *(pa.array(total[there, i]) for i in range(size))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", *(f"s{i}" for i in range(size))])

    names = [f"s{i}" for i in range(size)]
    partial = stored.mapInArrow(sums, "cluster bigint, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    out = centroids.copy()
    for row in partial.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in names)).collect():
        out[row["cluster"]] = [row[s] // row["n"] for s in names]
    return out


def seeds(vectors: DataFrame, k: int, salt: int) -> np.ndarray:
    """The k vectors of smallest hash, in its order; equal hashes go by components."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_key").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in first], dtype=np.int64)


def cluster(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10, salt: int = 3, leading: int = LEADING,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each kept vector.

    Components become floor(1024 * x). Centroids start as the k vectors whose sha256 of
    "salt:key" is smallest; each round assigns every vector to the nearest centroid (squared
    distance, ties to the smaller number) and moves every non-empty one to the floor of the
    exact mean. Rounds after one that moves nothing would change nothing and are left out.
    Distances come from whole numbers only; the rotated coordinates, stored once, decide which
    centroids are measured. The driver holds k centroids, their
    sums and the axes.

    Left out are vectors that are null, of another size, or with a component that is null,
    not finite, or of 2**17 and more in absolute value, whose distances a long cannot hold.
    With fewer than k vectors there are fewer centroids. A null key hashes as the empty text;
    repeated rows are vectors of their own. No vectors, no rows. Other columns are not read.
    A cluster's inertia that a long cannot hold is null.
    """
    vectors = whole_vectors(table, key, vector, size)
    how = rotation(vectors, size, leading)
    stored = _store(vectors, how, size)
    centroids = seeds(vectors, k, salt)
    if len(centroids) == 0:
        centroids = np.zeros((1, size), dtype=np.int64)
    for _ in range(rounds):
        moved = _moved(stored, how, centroids)
        if (moved == centroids).all():
            break
        centroids = moved
    key_type = dict(stored.dtypes)["vec_key"]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, number, distance in _assigned(batches, how, centroids):
            yield pa.RecordBatch.from_arrays([batch.column("vec_key"), pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_key", "cluster", "distance"])

    out = cut_lineage(stored.mapInArrow(last, f"vec_key {key_type}, cluster int, distance bigint"))
    # At most k rows.
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia = [_long(sums.get(c, 0)) for c in range(len(centroids))]
    names = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()]
    return out.select(
        F.col("vec_key").alias(key), "cluster", "distance", _of_cluster(inertia).alias("cluster_inertia"),
        _long(sum(sums.values())).alias("inertia"), _of_cluster(names).alias("centroid_sha256"),
    )


def _long(value: int) -> Column:
    return F.lit(value if value < 1 << 63 else None).cast("bigint")


def _of_cluster(values: list[Column]) -> Column:
    return F.get(F.array(*values), F.col("cluster"))
