"""Centroid clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.llm import clustering

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, size, scale):
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in seeds] or [[0] * size]

    def best(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [best(v)[1] for _, v in kept]
        groups = [[v for (_, v), a in zip(kept, at, strict=True) if a == n] for n in range(len(centroids))]
        centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)]
    found = [(i, *best(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sum(e for _, e, o in found if o == c), total, names[c]) for i, d, c in found), key=str)


def vectors(seed, n, size):
    rnd = random.Random(seed)
    # few distinct values, so that distances tie; thirds and tens are not exact in binary
    rows = [(i, [rnd.choice([-1.5, -0.1, 0.0, 1 / 3, 0.7, 2.0]) for _ in range(size)]) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, [0.5] * size), (9000, None), (9001, []), (9002, [0.1] * (size + 1))]
    rows += [(9003, [float("nan")] + [0.0] * (size - 1)), (9004, [float("-inf")] * size), (9005, [None] + [1.0] * (size - 1)), (rows[5][0], [2.0] * size)]
    return [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize(("k", "size", "n"), [(5, 4, 120), (40, 3, 20), (1, 2, 30)])
def test_equals_plain_arithmetic(make, k, size, n):
    rows = vectors(k, n, size)
    got = clustering.clustered(make(rows, SCHEMA), k=k, rounds=4, size=size, scale=256)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, k, 4, size, 256)


def test_without_vectors_or_ids(make):
    assert clustering.clustered(make([], SCHEMA), size=2).collect() == []
    got = clustering.clustered(make([(None, [1.0, 2.0])], SCHEMA), k=3, rounds=1, size=2, scale=1).collect()
    assert [tuple(r)[:5] for r in got] == [(None, 0, 0, 0, 0)]


def test_one_cluster_holds_most_rows_and_dealing_does_not_matter(make):
    rows = [(i, [0.25, 0.5]) for i in range(300)] + [(i, [float(i), 1.0]) for i in range(300, 330)]
    got = [sorted(map(tuple, clustering.clustered(make(rows, SCHEMA, parts), k=4, size=2).collect()), key=str) for parts in (1, 7)]
    assert got[0] == got[1] == plain(rows, 4, 5, 2, 256)


def test_components_that_do_not_fit(make):
    with pytest.raises(Exception, match="beyond"):
        clustering.clustered(make([(1, [1e30, 0.0])], SCHEMA), size=2)


def test_no_python_worker_in_the_plan(make):
    v = clustering.integer_vectors(make(vectors(1, 10, 4), SCHEMA), 4, 256)
    plan = v.select(clustering.nearest(F.col("v"), [[1, 2, 3, 4], [0, 0, 0, 0]]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
