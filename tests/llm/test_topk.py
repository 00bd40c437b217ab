"""Top products against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from flowlantern.llm import topk

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("rank", T.StringType()),  # an extra column whose name clashes with the result's
    ]
)


def brute(rows, every, k):
    whole = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    found = []
    for q, a in dict.fromkeys((i, tuple(v)) for i, v in whole):  # copies of a query are one query
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in whole if c != q]
            found += [(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def run(spark, rows, every=10, k=5, bucket=64):
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_products(table, every, k, bucket).collect())


@pytest.mark.parametrize("kind", ["lengths", "directions", "copies"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(600, 8))
    if kind == "lengths":
        v *= rng.exponential(size=(600, 1))
    else:
        v = v[rng.integers(0, 9, 600)] + 0.1 * v
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind == "copies":
        v[100:400] = v[0]
    rows = [(int(i), [float(x) for x in row]) for i, row in enumerate(v)]
    assert run(spark, rows) == brute(rows, 10, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [1.0]), (1, None), (2, [None, 1.0]), (3, [nan]), (4, [inf, 1.0])]
    rows += [(10, []), (20, [1e20, -1e20]), (5, [1.0, 2.0, 3.0]), (6, [-1.0, 0.0]), (7, [0.5])]
    wanted = [(q, r, c, max(min(s, 2**63 - 1), -(2**63))) for q, r, c, s in brute([(i, v) for i, v in rows], 10, 5)]
    found = run(spark, rows)
    assert [f for f in found if f[0] != 20] == [w for w in wanted if w[0] != 20]
    assert [f[2] for f in found if f[0] == 20][0] == 0 or len([f for f in found if f[0] == 20]) == 5


def test_copies_are_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [0.5, 0.5])]
    assert [(q, r, c) for q, r, c, _ in run(spark, rows)] == [(0, 1, 1), (0, 2, 1), (0, 3, 2)]


def test_empty(spark):
    assert run(spark, []) == []


def test_pruning_keeps_what_counts():
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(size=(400, 6)))
    v = v[np.argsort(-np.linalg.norm(v, axis=1))]
    norms = np.linalg.norm(v, axis=1)
    for q in v[::20]:
        scores = v @ q
        bound = np.sort(scores)[-5]
        rows = topk.candidates(v, norms, q, bound)
        assert set(np.flatnonzero(scores >= bound)) <= set(rows)
        assert len(rows) < len(v)
