"""Operator 13 against a plain Python version."""

import hashlib
import math
import random

import numpy as np
from kpiwarden.llm import centroids
from kpiwarden.llm.centroids import Centroids, clustered_vectors, largest
from pyspark.sql import functions as F

KIND = "vec_id long, embedding array<float>, label int, packed string, cluster int, of int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "p", 7, 8) for i, v in rows], KIND)


def plainly(rows, k, rounds, width):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    middle = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        member = [nearest(v)[1] for _, v in kept]
        for n in range(len(middle)):
            own = [v for (_, v), m in zip(kept, member) if m == n]
            if own:
                middle[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    out = []
    for i, d, n in found:
        mark = hashlib.sha256(",".join(map(str, middle[n])).encode()).hexdigest()
        out.append((i, n, d, sum(e for _, e, m in found if m == n), sum(e for _, e, _ in found), mark))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_clusters_equal_plain_version(spark):
    rng = random.Random(2)
    near = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in near[i % 3]]) for i in range(300)]
    rows += [(i, [float(round(x)) for x in near[i % 5]]) for i in range(300, 340)]  # ties and repeats
    rows += [(400 + i, [0.0] * 6) for i in range(150)]  # a third are the same
    want = plainly(rows, 8, 4, 6)
    assert rows_of(clustered_vectors(table(spark, rows).repartition(3), rounds=4, width=6)) == want
    assert rows_of(clustered_vectors(table(spark, rows), rounds=4, width=6, k=3)) == plainly(rows, 3, 4, 6)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 0.0]),
            (8, [1.0, 2.0, 3.0]), (9, [-0.3, -7.0])]
    assert rows_of(clustered_vectors(table(spark, rows), width=2)) == plainly(rows, 8, 10, 2)
    assert clustered_vectors(table(spark, rows[1:3]), width=2).collect() == []
    assert clustered_vectors(table(spark, rows).limit(0), width=2).collect() == []


def test_repeated_and_missing_ids_and_too_large_components(spark):
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.0, 0.25]), (None, [3.0, 3.0]), (2, [1e30, 1.0])]
    out = clustered_vectors(table(spark, rows), width=2, k=2).collect()
    assert len(out) == 5
    by = sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in out)
    assert by[0][:2] == ("1", 0) and by[3] == ("2", None, None)
    assert [r["cluster"] for r in out if r["vec_id"] is None] == [0] or by[4][1] in (0, 1)
    assert {r["inertia"] for r in out if r["vec_id"] != 2} == {sum(r["distance"] or 0 for r in out)}


def test_search_rules_out_and_stays_exact(monkeypatch):
    rng = np.random.default_rng(4)
    middle = rng.integers(-900, 900, (40, 16)) + rng.integers(-3000, 3000, (40, 1))
    x = rng.integers(-900, 900, (500, 16)) + rng.integers(-3000, 3000, (500, 1))
    x[:20] = middle[:20]
    far = np.full((2, 16), largest(16))
    x, middle = np.concatenate((x, far, -far)), np.concatenate((middle, far[:1]))
    looked, measure = [], Centroids._measure

    def counted(self, x, rows, c, possible, number, best):
        looked.append(int(possible.sum()))
        measure(self, x, rows, c, possible, number, best)

    monkeypatch.setattr(Centroids, "_measure", counted)
    number, distance = Centroids(middle).nearest(x)
    every = ((x[:, None].astype(object) - middle[None].astype(object)) ** 2).sum(2)
    assert (number == every.astype(float).argmin(1)).all()
    assert (distance == every[np.arange(len(x)), number].astype(np.int64)).all()
    assert sum(looked) < 0.5 * every.size


def test_rounds_give_the_driver_sums_only(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    whole = clustered_vectors(table(spark, rows).repartition(5), width=2, k=3, rounds=1)
    assert whole.agg(F.max("inertia")).first()[0] == sum(r["distance"] for r in whole.collect())
    assert centroids._as_long(1 << 63) is None
