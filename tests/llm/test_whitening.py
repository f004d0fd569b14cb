import math
from fractions import Fraction

import numpy as np
import pytest

from georisk.llm import whitening
from georisk.llm.whitening import Params

SCHEMA = "vec_id long, embedding array<float>, n long, component string"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), np.array([5.0] * 6 + [1.0] * 20), np.array([9, 9 - 1e-9, 9 - 2e-9, 9 - 1e-7, 3, 2, 1, 0.5, 0, 0]),
    np.array([1e-3, 0, 0, 0]), np.zeros(5), np.array([4.0, 1.0]), np.array([7.0])])
def test_leading_components(values):
    a = symmetric(values)
    k = min(8, len(values))
    got, vectors = whitening.leading_components(a, k)
    norm = max(np.abs(a).max(), 1e-300)
    assert np.allclose(got, np.sort(values)[::-1][:k], rtol=0, atol=1e-13 * len(a) * max(values.max(), 1e-300))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * max(norm, values.max()) + 1e-290


def test_blocks_and_sturm_counts():
    a = np.diag([3.0, 3.0, 1.0, 2.0])   # already tridiagonal, splits into blocks
    values, vectors = whitening.leading_components(a, 4)
    assert np.allclose(values, [3, 3, 2, 1], atol=1e-15)
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-14
    d, e, _ = whitening.tridiagonal(symmetric(np.arange(10.0)))
    assert whitening.sturm_counts(d, e, np.array([-0.5, 0.5, 4.5, 100])).tolist() == [0, 1, 5, 10]


def brute(rows, k):
    """Exact sums and covariance in fractions, eigenvectors by numpy."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    centred = [[n * r[i] - sums[i] for i in range(dims)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = (np.array(centred, float) / n) @ (vectors / np.sqrt(values))
    return n, [sum(c * c for c in r) for r in centred], white, values / np.trace(cov)


def test_matches_brute_force(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.standard_normal(12) * np.linspace(0.1, 0.6, 12)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[8][1])]   # a repeated row, a null id
    bad = [(900, None), (901, []), (902, [0.1] * 11), (903, [None] + [0.1] * 11), (904, [float("nan")] * 12),
           (905, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows + bad], SCHEMA).repartition(5)
    got = whitening.whiten(df).toPandas()
    n, deviation, white, explained = brute(rows, 8)
    assert len(got) == 8 * n and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    first = {i: at for at, (i, _) in enumerate(rows) if i is not None}
    for c in range(8):
        part = got[got["component"] == c + 1]
        named = part[part["vec_id"].notna()]
        at = named["vec_id"].map(first).to_numpy()
        assert named["deviation"].tolist() == [deviation[i] for i in at]
        sign = np.sign(named["whitened"].to_numpy()[0] * white[at[0], c])
        assert np.abs(named["whitened"].to_numpy() - sign * white[at, c]).max() < 1e-9
        assert np.allclose(part["explained"], explained[c], rtol=1e-10)


def test_small_and_empty_inputs(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, ""), (2, [float("nan")], 1, "")], SCHEMA)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25, 1.0], 1, "")], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(1, c, 1, 0, None, None, None) for c in (1, 2, 3)]
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 1, "") for i in range(4)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat) and flat[0]["identity_error"] < 1e-12


def test_deviation_beyond_a_long(spark):
    fit = whitening.Fit(10 ** 9, np.array([10 ** 14, 0], object), np.ones(2), np.eye(2), 2.0)
    x = np.array([[10 ** 5, 0], [10 ** 5 + 1, 3], [10 ** 5 + 5, 0]])
    assert fit.deviation(x) == [0, None, None]
    with pytest.raises(Exception, match="2\\^40"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], 1, "")], SCHEMA), p=Params()).count()
