"""Bracketed order statistics against numpy, at sizes below and above every bound."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import stats

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def _columns(n):
    i = F.col("id")
    u = (F.xxhash64(i, F.lit(1)).bitwiseAND(F.lit(0xFFFFFF)) + 1) / F.lit(1 << 24)
    return {"uniform": u, "tail": F.exp(F.lit(30.0) * u), "few": (u * 3).cast("int").cast("double"), "half_one": F.when(u < 0.5, 1.0).otherwise(u),
            "gaps": F.when(u > 0.3, u), "infinite": F.when(u < 0.2, float("-inf")).when(u > 0.9, float("inf")).when(u > 0.85, float("nan")).otherwise(u),
            "one": F.lit(7.0), "none": F.lit(None).cast("double"), "huge": (u - 0.5) * 1.7e308, "ends": F.when(u < 0.5, float("-inf")).otherwise(float("inf"))}


def _check(spark, n, parts):
    df = spark.range(0, n, 1, parts).select(*[c.alias(k) for k, c in _columns(n).items()]).persist()
    got = stats.quantiles(df, df.columns, QS)
    edges = stats.part_edges(df, ["uniform", "few", "infinite", "none"], 64)
    t = df.toPandas()
    for c in df.columns:
        x = np.sort(t[c].dropna().to_numpy())
        for q in QS:
            if not len(x):
                assert got[c, q] is None
                continue
            p = q * (len(x) - 1)
            lo, hi = x[math.floor(p)], x[math.ceil(p)]
            want = lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi
            assert got[c, q] == want or (math.isnan(got[c, q]) and math.isnan(want)), (c, q, got[c, q], want)
        if c in edges:
            assert edges[c] == sorted({float(x[j * len(x) // 64]) for j in range(1, 64)} if len(x) else set())
    df.unpersist()


def test_small_tables_take_one_pass(spark):
    _check(spark, 3000, 3)
    _check(spark, 1, 1)


def test_large_tables(spark):
    _check(spark, 200_000, 5)


def test_brackets_ranked_by_spark_and_summaries_cut_often(spark, monkeypatch):
    monkeypatch.setattr(stats, "COLLECT_ROWS", 500)
    _check(spark, 60_000, 7)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(stats, "MARGIN", 0.0)
    _check(spark, 30_000, 3)


def test_empty_table_and_repeated_names(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert stats.quantiles(df, ["a", "b", "a"], [0.5]) == {("a", 0.5): None, ("b", 0.5): None}
    assert stats.quantiles(df, [], [0.5]) == {} and stats.part_edges(df, ["a"], 4) == {"a": []}


def test_sketch_stays_bounded_and_close():
    rng = np.random.default_rng(0)
    s = stats._Sketch()
    x = rng.lognormal(size=3_000_000)
    for part in np.array_split(x, 300):
        s.add(part)
    row = s.row(0, 0)
    assert len(row["x"]) <= stats.KEEP and sum(len(a) for a, _ in s.parts) <= 2 * stats.CHUNK
    x.sort()
    up = np.cumsum(row["w"])
    true = np.searchsorted(x, row["x"])
    assert np.abs(up - row["w"] / 2 - true).max() < stats.MARGIN * len(x)
    assert row["n"] == len(x) and row["w"].sum() == pytest.approx(len(x))
