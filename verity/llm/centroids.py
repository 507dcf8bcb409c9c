"""Centroid clustering over an incrementally kept distance matrix.

Components become integers, so every figure is exact and a rerun agrees. Each
vector keeps its dot product with every centroid. When the centroids move, a
vector's products change by the nonzero component changes alone:
``new = old + sum(change[c, j] * x[j])``; a centroid that stays costs nothing.
With the squared norm of a centroid (the same for all vectors) the nearest one
is an argmin over ``norm - 2 * product``.

The vectors with their products are a table in the shared checkpoint folder,
written once a round: it cuts the lineage, so a lost executor rereads files.
Only the centroids (at most ``k`` times ``dims`` numbers) and the sums over
each cluster travel; the sums are pre-aggregated in every task.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging, bound_arrow_batches

K, DIMS, ROUNDS, SCALE = 40, 64, 5, 256
# With components up to this a distance fits a long: 4 * 64 * BOUND**2 <= 2**62.
BOUND = 1 << 27


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the vectors of exactly ``dims`` components, none null or
    non-finite, as integers ``floor(scale * component)``. A vector with a
    component beyond ``BOUND`` fails the query: its distances have no exact
    long."""
    v = F.col("v")
    whole = F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    far = F.exists(F.col("x"), lambda c: F.abs(c) > BOUND)
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
            .filter((F.size(v) == dims) & finite).select("vec_id", whole.alias("x"))
            .select("vec_id", F.when(far, F.raise_error(F.lit(f"vector component beyond {BOUND} after scaling")))
                    .otherwise(F.col("x")).alias("x")))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def move(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """``state`` (vec_id, x and, but for the first time, products) after the
    centroids went from ``old`` to ``new``: products brought up to date,
    nearest centroid (the smaller number among equals) and squared distance."""
    change = new - old
    moved = [(c, np.flatnonzero(change[c])) for c in np.flatnonzero(change.any(axis=1))]
    norms = (new * new).sum(axis=1)
    k, dims = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), dims)
            products = _matrix(batch.column("products"), k) if "products" in batch.schema.names \
                else np.zeros((len(x), k), np.int64)
            for c, parts in moved:
                products[:, c] += x[:, parts] @ change[c, parts]
            score = norms - 2 * products
            cluster = score.argmin(axis=1)
            distance = (x * x).sum(axis=1) + score[np.arange(len(x)), cluster]
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("x"), _lists(products),
                 pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "x", "products", "cluster", "distance"])

    id_type = state.schema["vec_id"].dataType.simpleString()
    return state.mapInArrow(run, f"vec_id {id_type}, x array<long>, products array<long>, cluster int, distance long")


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The componentwise exact floor of each cluster's mean; a centroid
    without vectors stays. One row a cluster reaches the driver."""
    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("x")[j]) for j in range(centroids.shape[1])]).alias("total"))
    out = centroids.copy()
    for row in sums.collect():
        out[row.cluster] = [t // row.n for t in row.total]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
                    dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = "2") -> DataFrame:
    """Per kept vector (see ``integer_vectors``): ``vec_id``, ``cluster``,
    ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances
    summed over its cluster and over all) and ``centroid_sha256`` (of its
    centroid's components in decimal, joined by commas).

    The first centroids are the ``k`` vectors with the smallest sha256 of
    ``<seed>:<id>`` (then by id and components; a null id hashes as no
    digits); with fewer vectors there are fewer centroids. Each round assigns
    every vector and replaces every non-empty centroid by its vectors' mean;
    a last assignment follows. Equal centroids: the smaller number takes the
    vectors. Rows with a null or repeated id, and equal rows, count each for
    itself. A table without kept vectors gives no rows. Other columns are not
    read, whatever their names.
    """
    spark = vectors.sparkSession
    bound_arrow_batches(spark)
    staging = Staging(spark, "centroids")
    state = integer_vectors(vectors, id_col, vector_col, dims, scale)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.orderBy(digest, "vec_id", "x").limit(k).collect()
    centroids = np.array([r.x for r in first], np.int64).reshape(-1, dims)
    if not first:
        out = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {state.schema['vec_id'].dataType.simpleString()}, {out}")
    old = np.zeros_like(centroids)
    for n in range(rounds + 1):
        if (old == centroids).all() and n:
            break  # nothing moved, nor will it
        state = staging.write(move(state, old, centroids), f"round-{n}")
        staging.drop(f"round-{n - 1}")
        old, centroids = centroids, means(state, centroids) if n < rounds else centroids

    # At most k rows.
    sums = [(r.cluster, r.total, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest())
            for r in state.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()]
    inertia = sum(total for _, total, _ in sums)
    facts = spark.createDataFrame(sums, "cluster int, cluster_inertia long, centroid_sha256 string")
    return (state.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"),
        "centroid_sha256"))
