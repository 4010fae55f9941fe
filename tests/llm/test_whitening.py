"""Whitening against numpy and exact whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from seriesguard.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, weight long, component string"


def by_numpy(rows, d, k):
    """vec_id -> (deviation, whitened up to signs), and the shares, from all rows at once."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    return good, n, deviation, centred @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def vectors(n=400, d=12, seed=2):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, d)) * np.linspace(2, 0.05, d)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a vector that most rows hold
    rows += [(2000 + i, rows[i % 5][1]) for i in range(40)]
    odd = [(3000, None), (3001, [None] * d), (3002, [float("nan")] * d), (3003, [float("inf")] + [0.0] * (d - 1)), (3004, [1.0] * (d + 1)),
           (3005, []), (None, rows[3][1]), (7, rows[7][1]), (7, rows[9][1])]
    return rows + odd


@pytest.mark.parametrize("frequent", [1024, 3])
def test_whitening_equals_numpy(spark, monkeypatch, frequent):
    monkeypatch.setattr(whitening, "FREQUENT", frequent)
    rows, d, k = vectors(), 12, 8
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA).repartition(5)
    found = whitening.whiten(df).collect()
    good, n, deviation, white, share = by_numpy(rows, d, k)
    assert len(found) == n * k and {r["n"] for r in found} == {n}
    signs = {}
    want = sorted(((-1 if i is None else i), deviation[j], *white[j]) for j, (i, _) in enumerate(good))
    by_row = {}
    for r in found:
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
        by_row.setdefault((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"]), []).append((r["component"], r["whitened"]))
    assert sorted((k[0], k[1]) for k, v in by_row.items() for _ in range(len(v) // 8)) == [w[:2] for w in want]
    for w in want:
        own = dict(by_row[w[0], w[1]])
        for c in range(1, k + 1):
            signs.setdefault(c, math.copysign(1, own[c] * w[1 + c]) if abs(w[1 + c]) > 1e-6 else None)
            if signs[c]:
                assert abs(own[c] * signs[c] - w[1 + c]) < 1e-8


def test_fewer_distinct_vectors_than_components(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 1.0, 2.0]) for i in range(10)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).collect()
    assert len(rows) == 30
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in rows)
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 for r in rows if r["component"] == 1)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id int, embedding array<double>")
    rows = whitening.whiten(same).collect()
    assert len(rows) == 8 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in rows)


def test_no_usable_rows(spark):
    for rows in ([], [(1, None), (2, [None]), (3, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_past_doubles():
    """Sums of squares beyond 2^53 keep every digit; those beyond a long are None."""
    x = np.array([[100_000, 3], [100_500, 9_000_000], [99_000, 2]], np.int64)
    sums = [int(c) for c in x.sum(axis=0)]
    for n in (3, 40_000_003):
        want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening._deviations(x, n, sums) == [v if v < 2 ** 63 else None for v in want]
