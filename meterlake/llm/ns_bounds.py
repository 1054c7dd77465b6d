"""Exact k-means with bounds loosened by the norm of a sum of displacements (ns-bounds).

Every vector keeps, for each centroid, a lower bound of its distance and the round that bound was evaluated in, and an upper bound for its own centroid. The history of
all centroids is kept too, so a bound of round T is loosened in round t by ``|c(t) - c(T)|``, one norm of the total displacement, which is never more than the sum of the
moves in between: centroids that swing back cost nothing. A vector whose own upper bound is below all its other lower bounds keeps its cluster without a distance being
computed; the others are evaluated exactly, first against their own centroid, then against those whose bounds are not above that distance. Bounds are rounded outwards and distances
are integers, so clusters, ties included, are those of the plain algorithm.

Each round is one map over the stored vectors, written as a table in the shared folder; vectors never shuffle. Sums of a cluster change by the vectors that moved, added up in the tasks;
``k * dims`` numbers of each round reach the driver, whatever the number of vectors.

Only vectors of exactly ``dims`` components, none null or not finite, take part. A component's integer may be at most LIMIT in size (a distance is a long), else the query fails with a message. Rows of
equal ids are vectors of their own. A null id takes part, as the last one in the draw of the first centroids. Fewer vectors than ``k`` give fewer centroids; an empty table gives no rows. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import table, written

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
LIMIT = 1 << 27
_SMALL = 1 << 20  # up to here 64 products add up exactly as doubles
_OUT = 1e-12  # relative error allowed for a square root
_STATE = "vec_id long, vec array<int>, cluster int, was int, own float, own_round byte, low array<float>, low_round array<byte>, evaluated long, distance long"


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec): the vectors that take part, each component as the integer floor(scale * x)."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform("x", lambda e: F.floor(e * F.lit(float(scale))))
    fits = F.forall("scaled", lambda e: (e >= -LIMIT) & (e <= LIMIT))
    return (
        rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dims) & finite)
        .select("vec_id", scaled.alias("scaled"))
        .select("vec_id", F.when(fits, F.col("scaled")).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT}"))).cast("array<int>").alias("vec"))
    )


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``, as 64-bit integers."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= _SMALL:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] + (cf * cf).sum(1)[None, :] - 2.0 * (xf @ cf.T)).astype(np.int64)
    return np.stack([_squared_to(x, row) for row in c], axis=1)


def _squared_to(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _above(d2: np.ndarray) -> np.ndarray:
    return np.nextafter((np.sqrt(d2.astype(np.float64)) * (1 + _OUT)).astype(np.float32), np.float32(np.inf))


def _below(d2: np.ndarray) -> np.ndarray:
    return np.nextafter((np.sqrt(d2.astype(np.float64)) * (1 - _OUT)).astype(np.float32), np.float32(-np.inf))


def displacements(history: np.ndarray) -> np.ndarray:
    """[T, j]: how far centroid j stands now from where it stood in round T, never too little."""
    moved = history - history[-1]
    return np.sqrt((moved.astype(np.float64) ** 2).sum(2)) * (1 + 1e-9)


def first_round(x: np.ndarray, c: np.ndarray) -> dict[str, np.ndarray]:
    d2 = squared(x, c)
    own = d2.argmin(1)  # the first of equal ones
    n, k = d2.shape
    return {
        "cluster": own.astype(np.int32), "was": np.full(n, -1, np.int32), "own": _above(d2[np.arange(n), own]), "own_round": np.zeros(n, np.int8),
        "low": _below(d2), "low_round": np.zeros((n, k), np.int8), "evaluated": np.full(n, k, np.int64)}


def next_round(x: np.ndarray, s: dict[str, np.ndarray], history: np.ndarray) -> dict[str, np.ndarray]:
    """The state after the newest centroids of ``history``; only rows whose bounds fail are evaluated."""
    now, c, drift = len(history) - 1, history[-1], displacements(history)
    n, k = s["low"].shape
    row, a = np.arange(n), s["cluster"]
    upper = s["own"].astype(np.float64) + drift[s["own_round"], a]
    lower = s["low"].astype(np.float64) - drift[s["low_round"], np.arange(k)[None, :]]
    lower[row, a] = np.inf
    out = {name: value.copy() for name, value in s.items()} | {"was": a}
    failed = np.flatnonzero(lower.min(1, initial=np.inf) <= upper * (1 + 1e-9))
    if len(failed) == 0:
        return out
    own2 = _squared_to(x[failed], c[a[failed]])
    near = lower[failed] <= (np.sqrt(own2.astype(np.float64)) * (1 + 1e-9))[:, None]
    best2, best = own2.copy(), a[failed].copy()
    out["low"][failed, a[failed]], out["low_round"][failed, a[failed]] = _below(own2), now
    out["evaluated"][failed] += 1 + near.sum(1)
    for j in range(k):
        at = np.flatnonzero(near[:, j])
        if len(at):
            d2 = _squared_to(x[failed[at]], c[j])
            out["low"][failed[at], j], out["low_round"][failed[at], j] = _below(d2), now
            better = (d2 < best2[at]) | (d2 == best2[at]) & (j < best[at])
            best2[at[better]], best[at[better]] = d2[better], j
    out["cluster"][failed], out["own"][failed], out["own_round"][failed] = best, _above(best2), now
    return out


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(values.ravel()))


def _assigned(state: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
    """``state`` after one more assignment; the last one also gives every vector's exact distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows == 0:
                continue
            x = _matrix(part.column("vec"), np.int64)
            if len(history) == 1:
                s = first_round(x, history[0])
            else:
                kinds = {"cluster": np.int32, "was": np.int32, "own": np.float32, "own_round": np.int8, "evaluated": np.int64}
                s = {c: part.column(c).to_numpy(zero_copy_only=False).astype(t) for c, t in kinds.items()}
                s = next_round(x, s | {"low": _matrix(part.column("low"), np.float32), "low_round": _matrix(part.column("low_round"), np.int8)}, history)
            distance = pa.array(_squared_to(x, history[-1][s["cluster"]])) if last else pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("vec"), pa.array(s["cluster"]), pa.array(s["was"]), pa.array(s["own"]), pa.array(s["own_round"]), _lists(s["low"]), _lists(s["low_round"]), pa.array(s["evaluated"]), distance],
                names=["vec_id", "vec", "cluster", "was", "own", "own_round", "low", "low_round", "evaluated", "distance"])

    return state.mapInArrow(run, _STATE)


def _moved(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much each cluster's sum and count change in this round: tasks add up their own vectors, Spark the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for part in batches:
            x = _matrix(part.column("vec"), np.int64).reshape(part.num_rows, dims)
            ones = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
            into, out_of = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "was"))
            np.add.at(total, into, ones)
            left = out_of >= 0
            np.subtract.at(total, out_of[left], ones[left])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), _lists(total)], names=["cluster", "total"])

    sums = (
        state.where("cluster != was").select("vec", "cluster", "was").mapInArrow(run, "cluster int, total array<long>")
        .select("cluster", F.posexplode("total").alias("at", "part")).groupBy("cluster", "at").agg(F.sum("part").alias("part"))
    )
    total = np.zeros((k, dims + 1), np.int64)
    for r in sums.collect():  # at most k * (dims + 1) rows
        total[r["cluster"], r["at"]] = r["part"]
    return total[:, :dims], total[:, dims]


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:vec_id`` has the smallest hash, in the order of the hashes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = rows.orderBy(digest.asc_nulls_last(), "vec").limit(k).select("vec").collect()  # k rows
    return np.array([r["vec"] for r in chosen], np.int64)


def clusters(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, vec, cluster, distance, evaluated), final centroids) of the frame that ``vectors`` gives.

    ``evaluated`` is the number of distances computed for the vector in all rounds, of (rounds + 1) * k that the plain algorithm needs.
    """
    start = first_centroids(rows, k, seed)
    if len(start) == 0:
        return rows.select("vec_id", "vec", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("evaluated")).limit(0), start
    k, dims = start.shape
    history, sums, counts = start[None], np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    state = rows
    for at in range(rounds + 1):
        state = written(_assigned(state, history, last=at == rounds), f"clusters-{at}")
        if at < rounds:
            more, n = _moved(state, k, dims)
            sums, counts = sums + more, counts + n
            moved = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], history[-1])
            history = np.concatenate([history, moved[None]])
    return state.select("vec_id", "vec", "cluster", "distance", "evaluated"), history[-1]


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = clusters(vectors(table(spark, sf_dir, "embeddings")))
    of_cluster = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # one row for each cluster
    named = [(j, of_cluster[j], sum(of_cluster.values()), sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j in of_cluster]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # at most CLUSTERS rows


def _sql() -> str:
    """The same by the plain algorithm, round by round."""
    steps = []
    for t in range(ROUNDS + 1):
        steps.append(f"""
a{t} AS (
  SELECT v.row_id, v.vec_id, v.v, min(CAST(v.n + c.n - 2 * list_inner_product(v.f, c.f) AS BIGINT) * {CLUSTERS} + c.k) AS best
  FROM kept v CROSS JOIN c{t} c GROUP BY v.row_id, v.vec_id, v.v)""")
        if t < ROUNDS:
            steps.append(f"""
s{t} AS (
  SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT best % {CLUSTERS} AS k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{t}) GROUP BY k, i),
m{t} AS (SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{t} GROUP BY k),
c{t + 1} AS (SELECT k, v, CAST(v AS DOUBLE[]) AS f, list_inner_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])) AS n FROM (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN m{t} m ON c.k = m.k))""")
    return f"""
WITH raw AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS MATERIALIZED (SELECT *, CAST(v AS DOUBLE[]) AS f, list_inner_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])) AS n FROM raw),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) AS INTEGER) - 1 AS k, v, f, n FROM (
  SELECT *, sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h FROM kept ORDER BY h NULLS LAST, v LIMIT {CLUSTERS})),{",".join(steps)}
SELECT a.vec_id, CAST(a.best % {CLUSTERS} AS INTEGER) AS cluster, a.best // {CLUSTERS} AS distance,
  CAST(sum(a.best // {CLUSTERS}) OVER (PARTITION BY a.best % {CLUSTERS}) AS BIGINT) AS cluster_inertia, CAST(sum(a.best // {CLUSTERS}) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.k = a.best % {CLUSTERS}
"""


OP11_SQL = _sql()
