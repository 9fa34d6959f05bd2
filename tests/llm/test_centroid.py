import hashlib
import math
import random

from tuneforge.llm import centroid, queries

from ..conftest import SF_SMALL


def brute(rows, k, rounds, width, scale, seed):
    kept = [(i, [max(-centroid.BOUND, min(centroid.BOUND, math.floor(scale * x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in order[:k]] or [[0] * width]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for j in range(len(cents)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    inertia = {j: sum(d for d, c in at if c == j) for j in range(len(cents))}
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(repr((i, c, d, fit(inertia[c]), fit(sum(inertia.values())), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()))
                  for (i, _), (d, c) in zip(kept, at))


def result(df):
    return sorted(repr((r[0], r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, 5, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int, _tf_n int")


def test_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(400, None), (401, [1.0] * 5), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, []),
             (None, [0.5] * 6), (None, [-0.5] * 6), rows[7], rows[7], (rows[9][0], [9.0] * 6), (406, [1e9, -1e9, 0.0, 0.0, 0.0, 0.0])]
    for k, rounds, scale in ((4, 10, 1024), (7, 3, 3), (1, 2, 1024), (8, 0, 10)):
        got = centroid.cluster(table(spark, rows).repartition(3), k=k, rounds=rounds, width=6, scale=scale)
        assert result(got) == brute(rows, k, rounds, 6, scale, 3)


def test_ties_few_rows_and_none(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]  # equal centroids: the smaller number wins, the others stay empty
    assert result(centroid.cluster(table(spark, same), k=3, width=2)) == brute(same, 3, 10, 2, 1024, 3)
    two = [(1, [1.0, 2.0]), (2, [-1.0, -2.5])]
    assert result(centroid.cluster(table(spark, two), width=2)) == brute(two, 8, 10, 2, 1024, 3)
    huge = [(i, [(-1.0) ** i * 1e30] * 64) for i in range(40)]  # an inertia beyond a long is null
    assert result(centroid.cluster(table(spark, huge), k=1)) == brute(huge, 1, 10, 64, 1024, 3)
    for none in ([], [(1, None)]):
        assert centroid.cluster(table(spark, none), width=2).collect() == []


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert result(queries.op12_centroids(spark, SF_SMALL)) == brute(rows, 8, 10, 64, 1024, 3)


def test_native(spark):
    plan = queries.op12_centroids(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
