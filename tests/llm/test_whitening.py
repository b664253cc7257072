"""Whitening beside a dense eigenvalue decomposition."""

import numpy as np
import pytest

from corpusprep.llm import whitening
from corpusprep.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, x int, component string, n string"


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "a", "b") for k, v in vectors], SCHEMA)


def checked(rows, vectors, components=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)) + 100_000
    n, off = len(x), x - x.mean(axis=0)
    values, turn = np.linalg.eigh(off.T @ off / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    keep = values > 1e-12 * (off**2).sum() / n
    want = off @ turn[:, keep] / np.sqrt(values[keep])
    whole = x.astype(int).sum(axis=0)
    exact = [sum(int(n * int(a) - int(s)) ** 2 for a, s in zip(row, whole)) for row in x]
    assert len(rows) == n * int(keep.sum())
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, []).append(r)
        assert r.n == n and r.deviation == exact[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / (off**2).sum() * n, rel=1e-9)
    got = np.array([[r.whitened for r in sorted(by[k], key=lambda r: r.component)] for k in range(n)])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-8


def test_query(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    rows = QUERIES["op13_whitening"](spark, SF).collect()
    assert [r.vec_id for r in given] == list(range(len(given)))
    checked(rows, [r.embedding for r in given])


def test_wide_vectors_need_the_filter(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(0, 1, (200, 90)) * np.linspace(2, 0.5, 90)).astype(np.float32).tolist()
    checked(whitening.whiten(table(spark, list(enumerate(vectors)))).collect(), vectors)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 0.5], [0.0, -1.0, 0.5], [2.0, 2.0, 0.5], [2.0, 2.0, 0.5]]
    odd = [(9, None), (9, [1.0, None, 0.0]), (9, [nan, 0.0, 0.0]), (9, [0.0, inf, 0.0])]
    got = whitening.whiten(table(spark, [*enumerate(good), *odd])).collect()
    # The third dimension is constant: two components have variance.
    checked(got, good)
    assert {r.component for r in got} == {1, 2}
    for rows in ([], odd, [(1, [])], [(1, [0.5, 1.0])], [(1, [3.0]), (2, [3.0])]):
        assert whitening.whiten(table(spark, rows)).count() == 0
    ids = whitening.whiten(table(spark, [(None, [1.0]), (None, [2.0]), (4, [2.0])])).collect()
    assert sorted(str(r.vec_id) for r in ids) == ["4", "None", "None"]
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@pytest.mark.parametrize("seed", range(6))
def test_leading_pairs_are_certified(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(60, 150))
    values = np.sort(rng.random(d) ** rng.integers(1, 6))[::-1] * 10.0 ** rng.integers(-3, 6)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = (turn * values) @ turn.T
    found, vectors = whitening.leading(lambda q: matrix @ q, d, 8)
    want, exact = np.linalg.eigh((matrix + matrix.T) / 2)
    want, exact = want[::-1][:8], exact[:, ::-1][:, :8]
    assert np.allclose(found, want, rtol=1e-10)
    gaps = np.minimum(want - np.append(want[1:], values[8]), np.append(np.inf, -np.diff(want)))
    off = 1 - np.abs((vectors * exact).sum(axis=0))
    assert (off < 1e-10 + (1e-13 * want[0] / gaps) ** 2 * 100).all()


def test_large_numbers_stay_exact():
    for n, spread in ((40_000, 7), (3_000_000_000, 1)):
        x = np.array([[100_000 + spread, 100_000]], dtype=np.int64)
        sums = np.array([n * 100_000 + 5, n * 100_000 - n // 3], dtype=np.int64)
        want = sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[0], sums))
        if want < 1 << 63:
            assert whitening._deviations(x, n, sums).to_pylist() == [want]
        else:
            with pytest.raises(OverflowError):
                whitening._deviations(x, n, sums)
        got = whitening._centred(x, n, sums)[0]
        assert got.tolist() == [(n * int(v) - int(s)) / n for v, s in zip(x[0], sums)]
