"""Whitening against a dense eigenvalue decomposition."""

from __future__ import annotations

import brute
import numpy as np
import pytest

from txnlake.llm import whitening
from txnlake.llm.queries import QUERIES


def check(found, given):
    ids, deviations, n, values, coordinates, trace = brute.whitened(given)
    some = values > 1e-9 * values.max(initial=0) if len(values) else np.zeros(0, bool)
    by_row = {}
    for row in found:
        by_row.setdefault((row["vec_id"], row["deviation"]), []).append(row)
    assert len(found) == len(ids) * int(some.sum())
    assert {row["n"] for row in found} <= {n} and all(abs(row["identity_error"]) < 1e-9 for row in found)
    for vec_id, deviation, own in zip(ids, deviations, coordinates):
        rows = by_row[vec_id, deviation]
        for place in np.flatnonzero(some):
            seen = {round(row["whitened"], 6) for row in rows if row["component"] == place + 1}
            assert any(abs(abs(one) - abs(own[place])) < 1e-5 for one in seen)
    for row in found:
        assert abs(row["explained"] / (values[row["component"] - 1] / trace) - 1) < 1e-9


@pytest.mark.parametrize("name", ["edge", "small"])
def test_query(request, spark, folder, name):
    source = request.getfixturevalue("edge") if name == "edge" else folder
    given = [tuple(row) for row in spark.read.parquet(f"{source}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op13_whitening"](spark, source).collect(), given)


def test_signs_are_the_same_for_all_rows(spark, folder):
    given = [tuple(row) for row in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, _, _, _, coordinates, _ = brute.whitened(given)
    found = {(row["vec_id"], row["component"]): row["whitened"] for row in QUERIES["op13_whitening"](spark, folder).collect()}
    for place in range(8):
        own = np.array([found[one, place + 1] for one in ids])
        assert min(np.abs(own - coordinates[:, place]).max(), np.abs(own + coordinates[:, place]).max()) < 1e-7


def test_degenerate(spark):
    vectors = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string")
    assert whitening.whitened_components(vectors([(1, [1.0, 2.0], "c")])).collect() == []
    assert whitening.whitened_components(vectors([(1, [1.0, 2.0], "c")] * 3)).collect() == []
    line = [(place, [float(place), 2.0 * place, -1.0], "c") for place in range(9)]
    found = whitening.whitened_components(vectors(line)).collect()
    assert {row["component"] for row in found} == {1} and all(abs(row["explained"] - 1) < 1e-12 for row in found)
    check(found, [row[:2] for row in line])


@pytest.mark.parametrize("kind", ["flat", "falling", "groups", "equal"])
def test_solver(kind):
    rng = np.random.default_rng(1)
    width = 120
    x = rng.standard_normal((900, width))
    if kind == "falling":
        x *= 0.8 ** np.arange(width)
    elif kind == "groups":
        x += 3 * rng.standard_normal((5, width))[rng.integers(0, 5, 900)]
    v = np.cov(x.T, bias=True) if kind != "equal" else np.diag([5.0, 5.0, 5.0] + [1.0] * (width - 3))
    values, axes = whitening.jacobi_davidson(lambda y: v @ y, width, 8)
    expected = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.abs(values / expected - 1).max() < 1e-12
    assert np.abs(v @ axes - axes * values).max() < 1e-13 * values[0] * width and np.abs(axes.T @ axes - np.eye(8)).max() < 1e-13


def test_minres():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((12, 12))
    a, right = a + a.T, rng.standard_normal((12, 3))
    right[:, 2] = 0
    assert np.abs(a @ whitening.minres(lambda y: a @ y, right, 14, 1e-14) - right).max() < 1e-8
