"""Whitening against numpy's eigenvectors, and the counts of spectrum slicing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tierflow.llm import whitening
from tierflow.llm.queries import op11_embedding_whitening

SF = "/root/testdata/sf0.001"


def test_op11_equals_numpy(spark):
    table = pd.read_parquet(f"{SF}/embeddings.parquet").sort_values("vec_id")
    x = np.floor(1024 * np.stack(table.embedding).astype(float)).astype(np.int64) + 100_000
    n, y = len(x), x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = op11_embedding_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    assert got.component.tolist() == list(range(1, 9)) * n and got.vec_id.tolist() == np.repeat(table.vec_id, 8).tolist()
    mine, theirs = got.whitened.to_numpy().reshape(n, 8), y @ axes[:, :8] / np.sqrt(values[:8])
    signs = np.sign((mine * theirs).sum(axis=0))
    assert np.abs(mine * signs - theirs).max() < 1e-6
    assert np.allclose(got.explained.to_numpy().reshape(n, 8), values[:8] / values.sum(), rtol=1e-9)
    assert got.deviation.to_numpy().reshape(n, 8)[:, 0].tolist() == ((n * x - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


@pytest.mark.parametrize("kind", range(6))
def test_spectrum_slicing(kind):
    r = np.random.default_rng(kind)
    a = r.standard_normal((30, 30))
    v = [a @ a.T, a + a.T, np.diag([5.0, 5, 5, 3, 3, 1] + [0.0] * 24), np.ones((30, 30)), np.diag(1 + 1e-9 * np.arange(30.0)), np.kron(np.eye(15), [[0.0, 1], [1, 0]])][kind]
    exact = np.linalg.eigvalsh(v)[::-1]
    for shift in (-1.5, 0.3, 2.0, exact[3] + 1e-6, exact[3] - 1e-6):
        assert whitening.count_above(v, shift) == (exact > shift).sum()
    values, axes, tolerance = whitening.leading_eigen(v, 8)
    assert np.abs(values - exact[:8]).max() <= 4 * tolerance
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() <= 8 * tolerance


def _whiten(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    given = df.select("vec_id", whitening.scaled("embedding").alias("x"), "n")
    return whitening.whiten(given, "x", carry=["vec_id"], **kw).collect()


def test_rows_that_take_no_part_and_rows_without_variance(spark):
    bad = [(90, None, "a"), (91, [1.0, None], "a"), (92, [float("nan"), 1.0], "a"), (93, [float("inf"), 1.0], "a"), (94, [1e300, 0.0], "a"), (95, [1.0], "a"), (96, [], "a")]
    good = [(1, [0.0, 1.0], "a"), (1, [0.0, 1.0], "a"), (None, [2.0, 1.0], "b")]
    out = _whiten(spark, bad + good)
    assert sorted([r.vec_id is None, r.n] for r in out) == [[False, 3], [False, 3], [True, 3]]
    assert all(r.whitened[1] is None and r.whitened[0] is not None and r.identity_error < 1e-9 for r in out), out
    assert all(abs(r.explained[0] - 1) < 1e-12 and r.explained[1] < 1e-12 for r in out), out
    same = _whiten(spark, [(1, [3.0, 4.0], "a")] * 3)
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in same] == [([None, None], [None, None], None, 0)] * 3
    assert _whiten(spark, bad[:5]) == [] and _whiten(spark, [(1, [], "a")]) == []


def test_deviation_is_exact_beyond_64_bits(spark):
    out = _whiten(spark, [(1, [1e12], "a"), (2, [-1e12], "a"), (3, [5e11], "a")])
    x = {1: 1024 * 10**12, 2: -1024 * 10**12, 3: 512 * 10**12}
    total = sum(x.values())
    assert {r.vec_id: int(r.deviation) for r in out} == {i: (3 * v - total) ** 2 for i, v in x.items()}
