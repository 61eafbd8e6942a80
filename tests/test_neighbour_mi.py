"""Nearest-neighbour mutual information against brute force, in one shard and in many."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators.neighbour_mi import digamma, knn_mutual_information
from tidemill.operators.select import top_mutual_information


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute_force(x, y, k=3):
    ok = np.isfinite(x) & np.isfinite(y)
    x, y = x[ok], y[ok]
    n = len(x)
    if n <= k or not x.std() or not y.std():
        return 0.0
    dx, dy = np.abs(x[:, None] / x.std() - x / x.std()), np.abs(y[:, None] / y.std() - y / y.std())
    d = np.maximum(dx, dy)
    np.fill_diagonal(d, np.inf)
    r = np.sort(d, axis=1)[:, k - 1:k]
    nx, ny = (np.where(r == 0, a == 0, a < r).sum(axis=1) for a in (dx, dy))
    return max(0.0, _psi(n) + _psi(k) - float(np.mean([_psi(a) + _psi(b) for a, b in zip(nx, ny)])))


def _data(n=900):
    rng = np.random.default_rng(7)
    y = rng.normal(size=n)
    hot = np.where(rng.random(n) < 0.4, 1.5, rng.normal(size=n))
    cols = {"line": y * 2 + rng.normal(size=n) * 0.3, "noise": rng.normal(size=n), "square": y ** 2 + rng.normal(size=n) * 0.1,
            "hot": hot, "few": np.round(y), "tail": np.exp(4 * rng.normal(size=n)) * np.sign(y), "gaps": np.where(rng.random(n) < 0.3, np.nan, y),
            "one": np.full(n, 2.0), "edge": np.where(np.arange(n) == 5, np.inf, rng.normal(size=n) + y)}
    y[:30] = 40 + rng.normal(size=30)          # far away in y, anywhere in x
    return cols, y


@pytest.mark.parametrize("shard_rows", [16_384, 60])
def test_against_brute_force(spark, shard_rows):
    cols, y = _data()
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in np.column_stack([*cols.values(), y])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*cols, "y"])).repartition(3)
    got = {r.feature: r.mi for r in knn_mutual_information(df, list(cols), "y", shard_rows=shard_rows).collect()}
    want = {c: brute_force(v, y) for c, v in cols.items()}
    assert set(got) == set(want)
    for c in cols:
        assert got[c] == pytest.approx(want[c], abs=2e-9), c
    assert got["line"] > got["square"] > got["noise"] and got["one"] == 0.0


def test_copies_and_small_tables(spark):
    rows = [(1.0, 2.0)] * 300 + [(float(i), float(i % 7)) for i in range(40)]
    x, y = (np.array(v) for v in zip(*rows))
    df = spark.createDataFrame(rows, "x double, y double")
    assert knn_mutual_information(df, ["x"], "y", shard_rows=10).first().mi == pytest.approx(brute_force(x, y), abs=2e-9)
    assert knn_mutual_information(df.limit(3), ["x"], "y").first().mi == 0.0
    assert knn_mutual_information(df.limit(0), ["x"], "y").first().mi == 0.0
    assert knn_mutual_information(df, [], "y").count() == 0


def test_digamma_and_the_selection(spark):
    got = spark.range(1, 60).select("id", digamma(F.col("id").cast("double")).alias("p")).collect()
    assert all(r.p == pytest.approx(_psi(r.id), abs=1e-11) for r in got)
    cols, y = _data(300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([cols["line"], cols["noise"], y])], "line double, noise double, y double")
    assert [r.feature for r in top_mutual_information(df, ["noise", "line"], "y", 1, method="neighbours").collect()] == ["line"]
    with pytest.raises(ValueError):
        top_mutual_information(df, ["line"], "y", method="guess")
    assert math.isfinite(top_mutual_information(df, ["line"], "y").first().mi)
