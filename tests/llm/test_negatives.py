"""Hard negatives against a brute-force version, the bound against true products, and awkward rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockwright.llm import negatives

SHAPE = "vec_id long, embedding array<float>, label int, row long, v string, codes int"


def brute(data, scale=256, anchor=lambda i: i is not None and i % 50 == 0, positives=5, n_best=3):
    rows = {}
    for i, x, label in data:
        if x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(scale * float(np.float32(c))) for c in x]
        if max(map(abs, v), default=0) < 1 << 27:
            rows[i, label, tuple(v)] = v
    out = []
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    for a, v in rows.items():
        if not anchor(a[0]):
            continue
        same = sorted(((dot(v, w), b[0]) for b, w in rows.items() if b != a and b[1] == a[1]), key=order)[:positives]
        rest = [(dot(v, w), b[0]) for b, w in rows.items() if b[1] != a[1]]
        for p, i in same:
            fit = sorted((t for t in rest if 50 * p <= 100 * t[0] <= 95 * p), key=order)[:n_best]
            out += [(a[0], i, k + 1, t[1], p, t[0]) for k, t in enumerate(fit)]
    return sorted(map(str, out))


def run(spark, data):
    df = spark.createDataFrame([(i, x, label, 1, "x", 2) for i, x, label in data], SHAPE)
    return sorted(str(tuple(r)) for r in negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())


def vectors(seed, n, d, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, d))
    x = centres[r.integers(0, 6, n)] + spread * r.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize(("d", "spread"), [(64, 0.5), (64, 3.0), (100, 1.0), (3, 1.0)])
def test_equals_brute_force(spark, d, spread):
    data = [(k, x, k % 4) for k, x in enumerate(vectors(d, 600, d, spread))]
    data += [(1000 + k, data[7][1], 3 if k % 2 else 1) for k in range(120)]  # many equal scores
    assert run(spark, data) == brute(data)


def test_many_cells_equal_one(spark, monkeypatch):
    data = [(k, x, k % 3) for k, x in enumerate(vectors(5, 400, 64, 1.0))]
    monkeypatch.setattr(negatives, "ROW_BYTES", 64 * 8 * 20)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 64 * 8 * 2)
    assert run(spark, data) == brute(data)


def test_odd_rows(spark):
    x = vectors(9, 60, 8, 1.0)
    data = [(50 * k, v, k % 2) for k, v in enumerate(x)]
    data += [(1, None, 1), (2, x[0], None), (3, [*x[0][:7], None], 1), (4, [*x[0][:7], float("nan")], 1), (5, [*x[0][:7], float("inf")], 0), (6, [], 1), (7, x[3][:5], 0), (8, [1e30] * 8, 1)]
    data += [(None, x[4], 0), (None, x[4], 1), (100, x[2], 0), (100, x[2], 0), (150, x[9], 0), (150, x[10], 1), (9, [0.0] * 8, 0), (10, [-0.0] * 8, 1)]
    assert run(spark, data) == brute(data)
    df = spark.createDataFrame([], SHAPE)
    assert negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(1, [1.0], 1, 1, "x", 2)], SHAPE)
    assert negatives.hard_negatives(one, F.col("vec_id") % 50 == 0).count() == 0


def test_intervals_hold_and_filter():
    r = np.random.default_rng(2)
    v = np.floor(256 * np.array(vectors(3, 3000, 64, 2.0))).astype(np.int32)
    v[5] = 0
    codes, alignments = negatives.encode(v)
    n = len(v)
    lists = [pa.array(x.reshape(n, -1).tolist()) for x in (v, codes.view(np.int64), alignments)]
    rows = negatives.Rows(pa.table([pa.array(range(n)), pa.array(range(n)), pa.array([0] * n), *lists], names=["row", "vec_id", "label", "v", "codes", "alignments"]))
    kept, q = 0, negatives.Queries(v)
    for k in [0, 5, *r.integers(0, n, 40)]:
        true = v.astype(np.int64) @ v[k].astype(np.int64)
        low, high = np.array([int(np.quantile(true, 0.5)), -(1 << 62)]), np.array([int(np.quantile(true, 0.9)), 1 << 62])
        at = negatives.survivors(q, k, rows, np.arange(n), low, high, 3)
        for a, b in zip(low, high):
            inside = np.flatnonzero((true >= a) & (true <= b))
            assert set(inside[true[inside] > np.sort(true[inside])[-3]]) <= set(at)
            assert (true[np.intersect1d(at, inside)] == np.sort(true[inside])[-3]).sum() == (true[inside] == np.sort(true[inside])[-3]).sum()
        kept += len(at)
    assert kept < 0.3 * 42 * n
