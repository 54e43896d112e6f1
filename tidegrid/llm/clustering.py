"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector carries its exact integer dot products with all centroids, written to the shared folder after each round. When centroids
move, a dot product changes by the vector's components times the changes of that centroid, of which only the nonzero
ones are touched: centroids that stand still cost nothing, and a round in which none moves is not run. With the vector's
and the centroid's squared lengths the dot product gives the squared distance, and the nearest centroid follows.

What travels: per task one row of component sums for each centroid, summed by (centroid, component). The driver holds centroids,
which are the model: centroids times components. Vectors never move. The state of a round is removed when the
next one is written; a lost executor costs at most the round it was lost in.

Defined cases: vectors that are null, of another length, or with a null or non-finite component take no part; ties go to
the smaller centroid; every row counts, also repeated ones, and rows that share the id of a starting centroid are
ordered by vector; a row with a null id is clustered but never a starting centroid; with fewer rows than centroids
there are as many centroids as rows with an id, with none no rows come out; an empty centroid stays where it is, with an
inertia of 0; further columns are ignored. Components must lie within 2**27 after scaling (or, for other widths, distances
within 2**62), else the job fails rather than return wrong distances.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm.topk_search import scaled, usable
from tidegrid.session import scratch_path

STATE = "vec_id long, vector array<int>, squares long, dots array<long>, cluster int, distance long"
OUT = "vec_id long, cluster int, distance long"
FIELDS = ["vec_id", "vector", "squares", "dots", "cluster", "distance"]


def kept_vectors(rows: DataFrame, width: int = 64, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector``: the rows that take part, with components floor(scale * x)."""
    most = 1 << min(27, (61 - max(width, 2).bit_length()) // 2)
    whole = scaled(F.col(vector), scale)
    small = F.forall(whole, lambda x: F.abs(x) <= most)
    checked = F.when(small, whole).otherwise(F.raise_error(F.lit(f"a component is beyond {most} after scaling")))
    return rows.filter(usable(F.col(vector)) & (F.size(vector) == width)).select(
        F.col(vec_id).cast("long").alias("vec_id"), checked.cast("array<int>").alias("vector")
    )


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose ``salt:id`` has the smallest SHA-256, in that order."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter("vec_id IS NOT NULL").orderBy(order, "vector").limit(k).select("vector").collect()
    return np.array([r.vector for r in rows], np.int64)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of fixed length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def add_changes(dots: np.ndarray, vectors: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Dot products after each centroid has moved by its row of ``changes``."""
    dots = dots.copy()
    most = np.abs(vectors).max(initial=0).astype(float) * float(np.abs(changes).max(initial=0)) * vectors.shape[1]
    kind = np.float64 if most < 2**53 else np.int64  # exact either way
    by_component = np.ascontiguousarray(vectors.T, dtype=kind)
    for c, change in enumerate(changes.astype(kind)):
        moved = np.flatnonzero(change)
        if len(moved):
            rows = by_component if len(moved) == len(change) else by_component[moved]
            dots[:, c] += (change[moved] @ rows).astype(np.int64)
    return dots


def _update(state: DataFrame, centroids: np.ndarray, changes: np.ndarray, last: bool) -> DataFrame:
    """Dot products moved on, and each vector's nearest centroid."""
    k, width = centroids.shape
    lengths = (centroids * centroids).sum(axis=1)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vector"), width)
            if "dots" in batch.schema.names:
                squares, dots = batch.column("squares").to_numpy(), matrix(batch.column("dots"), k)
            else:
                whole = vectors.astype(np.int64)
                squares, dots = (whole * whole).sum(axis=1), np.zeros((len(vectors), k), np.int64)
            dots = add_changes(dots, vectors, changes)
            distances = squares[:, None] + lengths - 2 * dots
            nearest = distances.argmin(axis=1)  # the first of equals
            found = [pa.array(nearest, pa.int32()), pa.array(distances[np.arange(len(nearest)), nearest])]
            if last:
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *found], names=["vec_id", "cluster", "distance"])
                continue
            edge = pa.array(np.arange(0, dots.size + 1, k, dtype=np.int32))
            kept = pa.ListArray.from_arrays(edge, pa.array(dots.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(squares), kept, *found], names=FIELDS
            )

    return state.mapInArrow(run, OUT if last else STATE)


def _sums(state: DataFrame, k: int, width: int) -> tuple[np.ndarray, list[list[int]]]:
    """Rows of each cluster and the exact sums of their components."""

    def add(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            vectors, cluster = matrix(batch.column("vector"), width), batch.column("cluster").to_numpy()
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += vectors[cluster == c].sum(axis=0, dtype=np.int64)
        for c in np.flatnonzero(n):
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array([c], pa.int32()), "sums": pa.array([[int(n[c]), *total[c].tolist()]], pa.list_(pa.int64()))}
            )

    rows = state.select("cluster", "vector").mapInArrow(add, "cluster int, sums array<long>")
    rows = rows.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    )
    n, total = np.zeros(k, object), [[0] * width for _ in range(k)]
    for r in rows.collect():  # centroids times components
        if r["at"]:
            total[r["cluster"]][r["at"] - 1] = int(r["x"])
        else:
            n[r["cluster"]] = int(r["x"])
    return n, total


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a superseded state from the shared folder."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2") -> tuple[DataFrame, DataFrame]:
    """``vec_id, cluster, distance`` after ``rounds`` rounds and a last assignment, and the centroids as ``cluster,
    centroid, cluster_inertia, inertia`` (a row each).

    ``vectors`` has ``vec_id, vector`` with integer vectors of one length, as ``kept_vectors`` gives them.
    """
    spark = vectors.sparkSession
    facts = "cluster int, centroid array<long>, cluster_inertia long, inertia long"
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], OUT), spark.createDataFrame([], facts)
    k, width = centroids.shape
    state, path, before = vectors, None, np.zeros_like(centroids)
    for turn in range(rounds + 1):
        changes = centroids - before
        if turn and not changes.any():
            break  # nothing moves any more
        to = scratch_path(spark, "distances")
        _update(state, centroids, changes, turn == rounds).write.parquet(to)
        if path:
            _remove(spark, path)
        path, state = to, spark.read.parquet(to)
        if turn < rounds:
            n, total = _sums(state, k, width)
            before = centroids
            moved = [[x // int(m) for x in t] if m else old for m, t, old in zip(n, total, centroids.tolist())]
            centroids = np.array(moved, np.int64)
    inertia = [0] * k
    for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect():
        inertia[r["cluster"]] = r["d"]
    rows = [(c, centroids[c].tolist(), inertia[c], sum(inertia)) for c in range(k)]
    return state.select("vec_id", "cluster", "distance"), spark.createDataFrame(rows, facts)
