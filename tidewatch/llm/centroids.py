"""Centroid clustering by PCA-rotated filtering.

Vectors become integers, floor(scale * x), and all distances that decide are
integer distances.  Most of them are never computed:

1. one pass sums the products of all pairs of components (exact, pre-added per
   task); the eigenvectors of the covariance are the rotation, leading axes first;
2. the vectors are written once with their ``lead`` leading rotated coordinates and
   the norm of the rest;
3. for a vector x and a centroid c, with P the leading axes and r the norm of the
   rest, |x - c|^2 >= |Px - Pc|^2 + (r(x) - r(c))^2, since a rotation keeps
   distances and the rests differ by at least their norms' difference.  The
   centroid of least bound is measured first; every centroid whose bound, less an
   allowance for rounding, does not exceed that distance is measured too, in
   integers, and the nearest one (of equal ones the smallest number) wins;
4. each round sums the members' components per task and then per cluster; only
   these k * components numbers reach the driver, which makes the new centroids.

The number of clusters, rounds and components are parameters, so centroids,
rotation and sums have a size that does not grow with the data.

Defined cases: vectors that are null, of another length, or with a null or
non-finite component are left out; null ids are kept and hash as the empty text;
repeated rows count as often as they occur; rows tied in their hash are ordered by
their components; with fewer vectors than clusters there are as many centroids as
vectors; an empty table (or one without a usable vector) gives no rows; extra
columns are ignored.  Components beyond +-2^27 after scaling stop the job with an
error that names the limit, since their distances do not fit a long.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import discard, map_batches, materialise, pick, table

K, ROUNDS, SIZE, SCALE = 16, 3, 64, 64
#: Leading rotated coordinates that are stored.
LEAD = 16
LIMIT = 2 ** 27
STORED = "vec_id long, q binary, lead binary, rest double, norm long"


# --- numpy kernels ------------------------------------------------------------------

def rotate(q: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest, of integer rows."""
    r = q.astype(np.float64) @ axes
    return r[:, :lead], np.sqrt((r[:, lead:] ** 2).sum(1))


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, norm: np.ndarray, centres: np.ndarray,
            axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every row, and the number of distances measured."""
    c_lead, c_rest = rotate(centres, axes, lead.shape[1])
    c_norm = (centres * centres).sum(1)
    bound = (rest[:, None] - c_rest[None]) ** 2
    for j in range(lead.shape[1]):
        bound += (lead[:, j, None] - c_lead[None, :, j]) ** 2
    # coordinates are stored in single precision: relative error 2^-24 each
    bound -= 1e-6 * (norm[:, None] + c_norm[None]) + 1e-3
    first = bound.argmin(1)
    d = q - centres[first]
    best = (d * d).sum(1)
    cluster = first.copy()
    row, col = np.nonzero(bound <= best[:, None])
    other = col != first[row]
    row, col = row[other], col[other]
    d = q[row] - centres[col]
    dist = (d * d).sum(1)
    order = np.lexsort((col, dist, row))  # per row the nearest survivor, of equal ones the smallest number
    row, col, dist = row[order], col[order], dist[order]
    lead_of_row = np.flatnonzero(np.diff(row, prepend=-1))
    r, c, x = row[lead_of_row], col[lead_of_row], dist[lead_of_row]
    better = (x < best[r]) | ((x == best[r]) & (c < cluster[r]))
    cluster[r[better]], best[r[better]] = c[better], x[better]
    return cluster, best, len(q) + len(row)


def _rows(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


# --- Spark ------------------------------------------------------------------------------

def integer_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the components as longs, of the usable vectors."""
    usable = (F.size("v") == size) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.when(F.abs(x) <= LIMIT / scale, F.floor(x * F.lit(float(scale))))
                        .otherwise(F.raise_error(F.lit(f"vector component beyond {LIMIT} after scaling")).cast("long")))
    d = pick(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return d.filter(F.col("v").isNotNull() & usable).select("vec_id", whole.alias("v"))


def first_centroids(ints: DataFrame, k: int = K) -> np.ndarray:
    """Components of the k rows of smallest hash (k rows reach the driver)."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = ints.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: (r["h"], r["v"]))], np.int64)


def _totals(parts: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Sums of (a, b, n, x) rows by (a, b): a table of fixed size."""
    rows = parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    return {(r["a"], r["b"]): (int(r["n"]), int(r["x"])) for r in rows}


def rotation(ints: DataFrame, size: int = SIZE) -> np.ndarray:
    """Principal axes of all vectors as columns, the leading ones first."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, products = 0, np.zeros((size + 1, size + 1))
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)
            v = np.hstack([v, np.ones((len(v), 1))])
            n += len(v)
            products += v.T @ v
        a, b = np.triu_indices(size + 1)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(products[a, b])], ["a", "b", "x"])

    parts = map_batches(ints.select("v"), sums, "a int, b int, x double")
    m = np.zeros((size + 1, size + 1))
    for r in parts.groupBy("a", "b").agg(F.sum("x").alias("x")).collect():
        m[r["a"], r["b"]] = m[r["b"], r["a"]] = r["x"]
    n = max(m[size, size], 1.0)
    mean = m[:size, size] / n
    _, axes = np.linalg.eigh(m[:size, :size] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])  # any orthogonal axes give right results; these give tight bounds


def rotated(ints: DataFrame, axes: np.ndarray, lead: int = LEAD) -> DataFrame:
    """The stored form: integers, leading coordinates (single precision), norm of the rest, squared norm."""
    size = len(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            x, rest = rotate(q, axes, lead)
            x, q32 = x.astype("<f4"), q.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([r.tobytes() for r in q32], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array(rest), pa.array((q * q).sum(1))], [c.split()[0] for c in STORED.split(", ")])

    return map_batches(ints, run, STORED)


def _assign(stored: DataFrame, centres: np.ndarray, axes: np.ndarray, lead: int, with_sums: bool) -> DataFrame:
    """Nearest centroid of every row, or (with_sums) the members' sums per task."""
    size = len(axes)

    def work(b: pa.RecordBatch):
        q = _rows(b.column("q"), "<i4", size).astype(np.int64)
        args = _rows(b.column("lead"), "<f4", lead).astype(np.float64), b.column("rest").to_numpy(), b.column("norm").to_numpy()
        return (q, *nearest(q, *args, centres, axes)[:2])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, cluster, dist = work(b)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(dist)], ["vec_id", "cluster", "distance"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((len(centres), size), np.int64), np.zeros(len(centres), np.int64)
        for b in batches:
            if b.num_rows:
                q, cluster, _ = work(b)
                total += np.stack([q[cluster == k].sum(0) for k in range(len(centres))])
                count += np.bincount(cluster, minlength=len(centres))
        a = np.repeat(np.arange(len(centres), dtype=np.int32), size)
        keep = np.repeat(count > 0, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[keep]), pa.array(np.tile(np.arange(size, dtype=np.int32), len(centres))[keep]),
             pa.array(np.repeat(count, size)[keep]), pa.array(total.ravel()[keep])], ["a", "b", "n", "x"])

    if with_sums:
        return map_batches(stored, sums, "a int, b int, n long, x long")
    return map_batches(stored, rows, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, lead: int = LEAD) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, size, scale)
    centres = first_centroids(ints, k)
    lead = min(lead, size)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centres):
        return spark.createDataFrame([], out)
    axes = rotation(ints, size)
    stored = materialise(rotated(ints, axes, lead), "centroid-vectors")
    for _ in range(rounds):
        centres = centres.copy()
        for (a, b), (n, x) in _totals(_assign(stored, centres, axes, lead, True)).items():
            centres[a, b] = x // n
    done = materialise(_assign(stored, centres, axes, lead, False), "centroid-rows")
    discard(stored)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    # k rows
    per = done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    whole = sum(r["s"] for r in per)
    known = spark.createDataFrame([(r["cluster"], r["s"], whole, shas[r["cluster"]]) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def q_op13(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same iteration in SQL: one CTE per step, distances by component."""
    def assigned(name: str, centres: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT r, vec_id, v, k, d FROM (
    SELECT x.r, x.vec_id, x.v, c.k, list_sum(list_transform(range(1, {SIZE + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::BIGINT AS d
    FROM kept x, {centres} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""

    def moved(name: str, members: str, before: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT b.k, coalesce(m.v, b.v) AS v FROM {before} b LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS v FROM (
      SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT k, unnest(v) AS x, unnest(range(1, {SIZE + 1})) AS i FROM {members}) GROUP BY k, i)
    GROUP BY k) m ON m.k = b.k)"""

    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE})""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept)
  ORDER BY h, v LIMIT {K})"""]
    for n in range(ROUNDS):
        steps += [assigned(f"a{n}", f"c{n}"), moved(f"c{n + 1}", f"a{n}", f"c{n}")]
    steps += [assigned("final", f"c{ROUNDS}")]
    return "WITH " + ",\n".join(steps) + f"""
SELECT f.vec_id, f.k::INT AS cluster, f.d AS distance, sum(f.d) OVER (PARTITION BY f.k)::BIGINT AS cluster_inertia,
  sum(f.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM final f JOIN c{ROUNDS} c ON c.k = f.k"""


ORACLE_OP13 = _oracle()
