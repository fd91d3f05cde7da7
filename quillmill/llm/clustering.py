"""Centroid clustering with Hamerly's bounds, over exact integers.

A vector keeps two bounds from round to round: one above its distance to its own centroid, one below that to every other. When
centroids move, the first grows by the drift of its own and the second shrinks by the largest drift among the others. As long as the
first stays below the second (or below half the way to the nearest other centroid), no other centroid can be as near, and
the vector keeps its cluster without a single distance. Otherwise the first bound is made exact, and where that doesn't decide,
all distances are computed, as integers. Bounds are rounded outwards, so that results are those of a full search.

State (vector, cluster, bounds) is a Parquet table in the shared folder for each round, so that a lost executor costs the round's
own tasks; the table before the last is deleted. Sums change by what moved only. The driver sees centroids and sums: as many numbers
as clusters times components.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import checkpoint_dir, delete, table

COMPONENTS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
MOST = 1 << 27  # components beyond this, times 256, make squared distances that a long can't hold
EXACT = 1 << 22  # below it, sums of 64 products are exact in doubles, so that a matrix product gives the integers
OUT, IN = 1 + 1e-12, 1 - 1e-12  # far more than the rounding of a root or a sum

STATE = "vec_id {id}, vector binary, cluster int, was int, upper double, lower double, distance long"


def integers(vectors: DataFrame, vec_id: str, vector: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): of the rows with exactly so many components, none null or non-finite, floor(scale * x) as 32-bit
    integers. A component beyond 2 ** 27 there is an error, as squared distances would not fit a long."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), x.cast("array<double>").alias("vector")).where(F.coalesce((F.size("vector") == components) & finite, F.lit(False)))
    id_type = whole.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.floor(scale * batch.column("vector").flatten().to_numpy(zero_copy_only=False))
            if len(flat) and np.abs(flat).max() > MOST:
                raise ValueError(f"a component is beyond {MOST} after scaling; squared distances would not fit a long")
            packed = flat.astype("<i4").reshape(-1, components)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in packed], pa.binary())], names=["vec_id", "vector"])

    return whole.mapInArrow(run, f"vec_id {id_type}, vector binary")


def starts(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `seed:vec_id`, in that order; null vec_ids come last, ties by the vector."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(h.alias("h"), "vector").orderBy(F.col("h").asc_nulls_last(), "vector").limit(clusters).collect()
    return np.array([np.frombuffer(r["vector"], "<i4") for r in rows], np.int64)


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, exact."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def own_squares(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    return ((x - centroids[cluster]) ** 2).sum(1)


def assign(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> int:
    """Puts each vector to its nearest centroid (the smaller number of two as near) after these drifted by at most `drift`;
    cluster, upper and lower change in place. Returns how many vectors needed all distances."""
    known = np.flatnonzero(cluster >= 0)
    near = np.zeros(len(centroids))
    if len(known):
        order = np.argsort(drift)
        others = np.where(np.arange(len(drift)) == order[-1], drift[order[-2]] if len(drift) > 1 else 0.0, drift[order[-1]])
        upper[known] = (upper[known] + drift[cluster[known]]) * OUT
        lower[known] = np.maximum(lower[known] - others[cluster[known]], 0) * IN
        apart = np.sqrt(squares(centroids, centroids).astype(np.float64))
        np.fill_diagonal(apart, np.inf)
        near = apart.min(1) / 2 * IN
    bound = np.where(cluster >= 0, np.maximum(lower, near[np.maximum(cluster, 0)]), -1.0)
    open_ = np.flatnonzero(upper >= bound)
    again = open_[cluster[open_] >= 0]
    upper[again] = np.sqrt(own_squares(x[again], centroids, cluster[again]).astype(np.float64)) * OUT
    open_ = open_[upper[open_] >= bound[open_]]
    if len(open_):
        d = squares(x[open_], centroids)
        cluster[open_] = d.argmin(1)
        best = d[np.arange(len(d)), cluster[open_]]
        d[np.arange(len(d)), cluster[open_]] = np.iinfo(np.int64).max
        upper[open_] = np.sqrt(best.astype(np.float64)) * OUT
        lower[open_] = np.sqrt(d.min(1).astype(np.float64)) * IN if len(centroids) > 1 else np.inf
    return len(open_)


def step(state: DataFrame, schema: str, centroids: np.ndarray, drift: np.ndarray, last: bool) -> DataFrame:
    """The state after an assignment; `was` is the cluster before, and in the last one distance is the exact square."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(batch.num_rows, -1).astype(np.int64)
            was = batch.column("cluster").to_numpy()
            cluster, upper, lower = was.copy(), *(batch.column(c).to_numpy().copy() for c in ("upper", "lower"))
            assign(x, cluster, upper, lower, centroids, drift)
            distance = pa.array(own_squares(x, centroids, cluster)) if last else pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(upper), pa.array(lower), distance], names=["vec_id", "vector", "cluster", "was", "upper", "lower", "distance"])

    return state.mapInArrow(run, schema)


def changes(state: DataFrame, clusters: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much the counts and sums of clusters changed, as Python's integers: partial sums of each task, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((clusters, components + 1), np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(batch.num_rows, -1).astype(np.int64)
            x = np.column_stack([x, np.ones(len(x), np.int64)])
            cluster, was = (batch.column(c).to_numpy() for c in ("cluster", "was"))
            np.add.at(sums, cluster, x)
            np.subtract.at(sums, was[was >= 0], x[was >= 0])
        c, k = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(k, pa.int32()), pa.array(sums[c, k])], names=["c", "k", "n"])

    moved = state.where("cluster <> was").select("vector", "cluster", "was")
    out = np.zeros((clusters, components + 1), object)
    for r in moved.mapInArrow(run, "c int, k int, n long").groupBy("c", "k").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():  # at most clusters * (components + 1) rows
        out[r["c"], r["k"]] = int(r["n"])
    return out[:, -1], out[:, :-1]


def cluster_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after so many rounds and one more assignment. Distances are exact squares.

    Vectors with other than `components` components, or a null or non-finite one, are left out. Repeated rows and vec_ids are
    vectors each; a null vec_id is clustered as any other but chosen last as a start. With fewer vectors than clusters each
    is a start; without vectors there are no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    folder = f"{checkpoint_dir(spark)}/clusters-{uuid.uuid4()}"
    kept = integers(vectors, vec_id, vector, components, scale)
    schema = STATE.format(id=kept.schema["vec_id"].dataType.simpleString())
    kept.selectExpr("vec_id", "vector", "-1 AS cluster", "double('Infinity') AS upper", "double(0) AS lower").write.parquet(f"{folder}/0")
    state = spark.read.schema(schema).parquet(f"{folder}/0")
    centroids = starts(state, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema).select("vec_id", "cluster", "distance"), centroids
    k = len(centroids)
    counts, sums, drift = np.zeros(k, object), np.zeros((k, components), object), np.zeros(k)
    for r in range(1, rounds + 2):
        step(state, schema, centroids, drift, r > rounds).write.parquet(f"{folder}/{r}")
        state = spark.read.schema(schema).parquet(f"{folder}/{r}")
        delete(spark, f"{folder}/{r - 1}")
        if r <= rounds:
            more, by = changes(state, k, components)
            counts, sums = counts + more, sums + by
            moved = np.array([[s // n for s in row] if n else list(old) for n, row, old in zip(counts, sums, centroids, strict=True)], np.int64)
            drift = np.sqrt(((moved - centroids) ** 2).sum(1).astype(np.float64)) * OUT
            centroids = moved
    return state.select("vec_id", "cluster", "distance"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """assigned with cluster_inertia, inertia and centroid_sha256, of which there is one row for each cluster."""
    total = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    sums = {r["cluster"]: r["n"] for r in assigned.groupBy("cluster").agg(total.alias("n")).collect()}  # a row for each cluster
    rows = [(c, sums.get(c, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster_vectors(table(spark, sf_dir, "embeddings")))


def _sql(clusters: int, rounds: int, seed: int) -> str:
    """The same by a full search: a pair of expressions for each round."""
    out = [
        f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, CAST(list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS DOUBLE[{COMPONENTS}]) AS x
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, x
  FROM v
  ORDER BY c LIMIT {clusters})"""
    ]
    for r in range(rounds + 1):
        out.append(
            f"""a{r} AS MATERIALIZED (SELECT rid, min({{d: array_inner_product(v.x, v.x) - 2 * array_inner_product(v.x, c{r}.x) + array_inner_product(c{r}.x, c{r}.x), c: c}}) AS best
  FROM v, c{r}
  GROUP BY rid)"""
        )
        if r < rounds:
            out.append(
                f"""m{r} AS (SELECT c, CAST(list(m ORDER BY i) AS DOUBLE[{COMPONENTS}]) AS x
  FROM (SELECT best.c AS c, i, floor(sum(x[i]) / count(*)) AS m
  FROM a{r} JOIN v USING (rid), range(1, {COMPONENTS + 1}) t(i)
  GROUP BY ALL)
  GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.x, c{r}.x) AS x
  FROM c{r} LEFT JOIN m{r} ON m{r}.c = c{r}.c)"""
            )
    return (
        ",\n".join(out)
        + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(list_transform(c{rounds}.x::DOUBLE[], lambda y: y::BIGINT::VARCHAR), ',')) AS centroid_sha256
  FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} ON c{rounds}.c = best.c"""
    )


OP11_SQL = _sql(CLUSTERS, ROUNDS, SEED)
