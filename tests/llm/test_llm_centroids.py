"""Centroid clustering (op13) against a direct integer version, and the bound itself."""
import hashlib
import math
import random

import numpy as np
import pytest

from tidewatch.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, q string, lead string, k int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x", 1) for i, v in rows], SCHEMA)


def direct(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centres = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centres)):
            members = [v for (_, v), (_, m) in zip(kept, at) if m == n]
            if members:
                centres[n] = [sum(x) // len(members) for x in zip(*members)]
    at = assign()
    inertia = {n: sum(d for d, m in at if m == n) for n in range(len(centres))}
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, at)), key=repr)


def some(seed, n, spread=0.2):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    return [(k, [m + r.gauss(0, spread) for m in middles[k % 12]]) for k in range(n)]


def awkward_vectors():
    rows = some(1, 150)
    rows += [(200, None), (201, []), (202, [0.1] * 63), (203, [0.1] * 65), (204, [0.1] * 63 + [None]), (205, [0.1] * 63 + [float("nan")]),
             (206, [0.1] * 63 + [float("-inf")]), (None, rows[3][1]), (None, rows[4][1]), (5, rows[5][1]), (5, rows[6][1])]
    rows += [(300 + k, rows[0][1]) for k in range(80)]  # a third of all rows are one vector
    rows += [(400 + k, [0.0] * 64) for k in range(5)] + [(500, [-1.0] * 64), (501, [1000.5] * 64), (502, [-1 / 128] * 64)]
    return rows


def test_clusters_equal_the_direct_version(spark):
    rows = awkward_vectors()
    got = C.cluster(vectors(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == direct(rows)


@pytest.mark.parametrize("n", [0, 1, 7])
def test_fewer_vectors_than_clusters(spark, n):
    rows = some(2, n)
    assert sorted(map(tuple, C.cluster(vectors(spark, rows)).collect()), key=repr) == direct(rows)
    assert C.cluster(vectors(spark, [(1, None), (2, [1.0])])).count() == 0


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(k, [float(k % 3)] * 64) for k in range(60)]  # three distinct vectors, sixteen centroids
    got = sorted(map(tuple, C.cluster(vectors(spark, rows)).collect()), key=repr)
    assert got == direct(rows) and len({r[1] for r in got}) == 3


def test_the_bound_never_loses_the_nearest_and_saves_work():
    r = np.random.default_rng(3)
    for scale in (3, 2_000, 2 ** 26):
        middles = r.integers(-scale, scale + 1, (16, 64))
        q = middles[r.integers(0, 16, 2_000)] + r.integers(-scale // 8 - 1, scale // 8 + 2, (2_000, 64))
        _, axes = np.linalg.eigh(np.cov(q.T.astype(float)))
        axes = axes[:, ::-1]
        lead, rest = C.rotate(q, axes, 16)
        centres = middles + r.integers(-1, 2, middles.shape)
        centres[9] = centres[4]  # a tie everywhere
        cluster, dist, measured = C.nearest(q, lead.astype("<f4").astype(float), rest, (q * q).sum(1), centres, axes)
        every = ((q[:, None] - centres[None]) ** 2).sum(2)
        assert (cluster == every.argmin(1)).all() and (dist == every.min(1)).all()
        assert measured < 0.4 * every.size


def test_values_that_do_not_fit_stop_the_job(spark):
    with pytest.raises(Exception, match="beyond 134217728"):
        C.cluster(vectors(spark, [(1, [3e7] * 64)])).collect()
