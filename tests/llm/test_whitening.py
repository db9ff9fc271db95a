import math

import numpy as np
import pytest

from strata.llm import whitening
from strata.llm.registry import op11_whitening
from tests.llm.cases import SF, clashing

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, top=16):
    """(id, n, deviation, whitened, explained) by plain integers and one eigh of the direct covariance."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    centred = [[n * x[d] - sums[d] for d in range(width)] for x in fit]
    cov = np.array([[sum(y[i] * y[j] for y in centred) / n**3 for j in range(width)] for i in range(width)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:top], axes[:, ::-1][:, :top]
    out = []
    for i, x in kept:
        y = [n * x[d] - sums[d] for d in range(width)]
        out.append((i, n, sum(c * c for c in y), (np.array(y) / n) @ axes / np.sqrt(values), values / np.trace(cov)))
    return out


def test_given_table_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = {}
    for r in op11_whitening(spark, SF).collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    expected = brute(rows)
    assert len(found) == len(rows) and all(sorted(parts) == list(range(1, 17)) for parts in found.values())
    sign = np.sign([found[rows[0][0]][k + 1].whitened * expected[0][3][k] for k in range(16)])
    for i, n, deviation, whitened, explained in expected:
        parts = [found[i][k] for k in range(1, 17)]
        assert {(p.n, p.deviation) for p in parts} == {(n, deviation)}
        assert np.allclose([p.whitened for p in parts] * sign, whitened, atol=1e-8)
        assert np.allclose([p.explained for p in parts], explained, rtol=1e-9)
        assert {p.identity_error for p in parts} == {parts[0].identity_error} and parts[0].identity_error < 1e-9


def test_polarisation_equals_products_beyond_64_bits():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**30), 2**30, (300, 5))
    total = {}
    for i, sums in whitening.squares(x):
        total.update({(i, i + k): int(s) for k, s in enumerate(sums)})
    for i in range(5):
        for j in range(i + 1, 5):
            products = sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j]))
            assert total[i, j] - total[i, i] - total[j, j] == 2 * products
    assert total[0, 1] > 2**63


def test_edge_rows(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(c) for c in rng.normal(size=3)]) for k in range(40)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [1.0, float("inf"), 2.0])]
    extra = [(None, good[0][1]), (0, good[0][1]), (7, good[3][1]), (200, [0.5]), (201, [0.25, 0.5, 0.75, 1.0])]
    vectors = spark.createDataFrame(good + odd + extra, SCHEMA)
    model = whitening.fit(clashing(vectors))
    rows = whitening.whiten(clashing(vectors), model).collect()
    assert len(rows) == 45 and model.fits[3].n == 40  # repeats count once in the fit, but stay rows
    assert {len(r.whitened) for r in rows} == {1, 3, 4}
    expected = brute(good)
    by_id = {r.vec_id: r for r in rows if r.vec_id not in (0, 7)}
    for i, n, deviation, whitened, _ in expected:
        if i in by_id:
            assert (by_id[i].n, by_id[i].deviation) == (n, deviation)
            assert np.allclose(np.abs(by_id[i].whitened), np.abs(whitened), atol=1e-9)
    assert np.allclose(by_id[None].whitened, [r for r in rows if r.vec_id == 0][0].whitened)
    assert by_id[200].whitened == [None] and by_id[200].deviation == 0 and by_id[200].explained == [0.0]
    assert by_id[201].whitened == [None] * 4
    assert model.identity_error < 1e-9


def test_fewer_vectors_than_dimensions_and_hot_copies(spark):
    rng = np.random.default_rng(5)
    few = [(k, [float(c) for c in rng.normal(size=30)]) for k in range(6)]
    rows = few + [(1000 + k, few[0][1]) for k in range(500)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(vectors)
    found = whitening.whiten(vectors, model).collect()
    assert len(found) == 506 and model.fits[30].n == 6
    assert all([w is None for w in r.whitened] == [False] * 5 + [True] * 11 for r in found)  # 6 points span 5 directions
    assert model.identity_error < 1e-9


def test_empty_table_and_too_large_values(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = whitening.fit(empty)
    assert whitening.whiten(empty, model).collect() == [] and model.identity_error == 0.0
    huge = spark.createDataFrame([(1, [1e30]), (2, [0.0])], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        whitening.fit(huge)
