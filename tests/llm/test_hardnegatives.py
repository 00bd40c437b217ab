"""Hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from flowlantern.llm import hardnegatives

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # extra columns whose names the operator uses itself
        T.StructField("part", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("v", T.StringType()),
    ]
)


def brute(rows, every, positives=5, negatives=10):
    whole = []
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    found = []
    for anchor, label, a in whole:
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i, other == label) for i, other, b in whole if i != anchor]
        for s, positive, _ in sorted(x for x in scores if x[2])[:positives]:
            window = sorted(x for x in scores if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives]
            found += [(anchor, positive, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(window)]
    return sorted(found)


def run(spark, rows, every=10, **settings):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hardnegatives.hard_negatives(table, every, **settings).collect())


@pytest.mark.parametrize("kind", ["lengths", "directions", "copies", "one label", "own labels"])
def test_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hardnegatives, "FRAGMENT", 700)  # several fragments and blocks
    monkeypatch.setattr(hardnegatives, "BLOCK", 100)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 19))
    if kind == "lengths":
        v *= rng.exponential(size=(400, 1))
    elif kind != "own labels":
        v = v[rng.integers(0, 12, 400)] + 0.2 * v
    if kind == "copies":
        v[50:250] = v[0]
    labels = {"one label": np.zeros(400), "own labels": np.arange(400)}.get(kind, rng.integers(0, 4, 400))
    rows = [(i, int(labels[i]), [float(x) for x in row]) for i, row in enumerate(v)]
    wanted = brute(rows, 10)
    assert run(spark, rows) == wanted
    assert wanted or kind in ("one label", "own labels")


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (None, 1, [1.0]), (1, None, [1.0]), (2, 1, None), (3, 1, [None, 1.0]), (4, 1, [nan])]
    rows += [(5, 1, [inf, 1.0]), (6, 1, [1.0, 2.0, 3.0]), (7, 1, []), (8, 1, [0.5]), (9, 2, [0.6, 0.3]), (9, 2, [0.6, 0.3]), (10, 2, [])]
    rows += [(11, 2, [0.9, 1.0]), (20, 3, [-1.0, 0.0]), (21, 3, [2.0, 0.0]), (12, 2, [0.9, 1.0]), (13, 1, [1.0, 1.9])]
    wanted = brute(rows, 10)
    assert len({w[0] for w in wanted}) >= 1 and run(spark, rows) == wanted


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [float(np.float32(x)) for x in 3e5 * rng.normal(size=5)]) for i in range(60)]
    wanted = brute(rows, 10)
    assert wanted and max(w[4] for w in wanted) > 2**53 and run(spark, rows) == wanted


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 1, [1.0])]) == []


def test_the_scan_drops_rows_early(monkeypatch):
    rng = np.random.default_rng(1)
    columns = np.floor(256 * rng.normal(size=(64, 3000)) * np.linspace(3, 0.05, 64)[:, None])
    query = np.floor(256 * rng.normal(size=64) * np.linspace(3, 0.05, 64))
    ends = np.array([columns.min(axis=1), columns.max(axis=1)])
    scores = query @ columns
    top = np.sort(scores)[-1]
    rows, found = hardnegatives.scan(columns, query, ends, np.ones(3000, bool), [(0.3 * top, 0.9 * top)], 10)
    inside = np.flatnonzero((scores >= 0.3 * top) & (scores <= 0.9 * top))
    assert set(inside[np.argsort(-scores[inside])[:10]]) <= set(rows)
    assert (found == scores[rows]).all() and len(rows) < 30
