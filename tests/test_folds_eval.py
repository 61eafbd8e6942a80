"""Folds, selection and evaluation edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import evaluate as ev
from tidemill.operators import folds as fo
from tidemill.operators import select as se


def rows(spark, n):
    return spark.createDataFrame([(i,) for i in range(n)], "t long")


def test_eleven_folds(spark):
    spec = fo.FoldSpec(1000, 60, 0)
    assert spec.n_folds(1695) == 11
    ft = fo.fold_table(rows(spark, 1695), ["t"], spec).where("role = 'test'").orderBy("fold").collect()
    assert len(ft) == 11 and (ft[-1]["start_idx"], ft[-1]["end_idx"]) == (1600, 1659)


def test_purge_single_fold(spark):
    spec = fo.FoldSpec(1000, 60, 5)
    h = fo.holdout_split(rows(spark, 1070), ["t"], spec)
    tr = [r[0] for r in h.where("role = 'train'").select("row_idx").collect()]
    te = [r[0] for r in h.where("role = 'test'").select("row_idx").collect()]
    assert (min(tr), max(tr), min(te), max(te)) == (0, 999, 1005, 1064)


def test_no_fold_raises(spark):
    with pytest.raises(ValueError):
        fo.holdout_split(rows(spark, 1059), ["t"], fo.FoldSpec(1000, 60, 0))


def test_membership_properties(spark):
    spec = fo.FoldSpec(100, 10, 3)
    m = fo.fold_membership(rows(spark, 250), ["t"], spec)
    test = m.where("role = 'test'")
    assert test.groupBy("row_idx").count().where("count > 1").count() == 0
    bounds = m.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("row_idx"))).alias("a"),
                                   F.min(F.when(F.col("role") == "test", F.col("row_idx"))).alias("b")).collect()
    assert all(r["a"] + spec.purge < r["b"] for r in bounds)
    assert m.where("role = 'train'").groupBy("fold").count().where(f"count <> {spec.train}").count() == 0


def test_direction_accuracy(spark):
    df = spark.createDataFrame([(1.0, 1.0), (-1.0, 1.0), (0.0, 1.0), (2.0, 0.0)], "y double, p double")
    assert abs(ev.direction_accuracy(df).first()["dir_accuracy"] - 1 / 3) < 1e-12
    conf = {(r[0], r[1]): r[2] for r in ev.direction_confusion(df).collect()}
    assert conf == {(1, 1): 1, (1, -1): 0, (-1, 1): 1, (-1, -1): 0}


def test_regression_metrics_match_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50), rng.normal(size=50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    r = ev.regression_metrics(df).first()
    assert abs(r["rmse"] - np.sqrt(np.mean((y - p) ** 2))) < 1e-12
    assert abs(r["r2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12


def test_correlation_filter_is_not_greedy(spark):
    rng = np.random.default_rng(7)
    x = np.arange(40, dtype=float)
    a = x
    b = x + rng.normal(scale=1.2, size=40)
    c = b + rng.normal(scale=1.2, size=40)
    r = np.corrcoef([a, b, c])
    lo, hi = r[0, 2], min(r[0, 1], r[1, 2])
    assert lo < hi
    thr = (lo + hi) / 2
    df = spark.createDataFrame([(float(i), float(j), float(k)) for i, j, k in zip(a, b, c)], "a double, b double, c double")
    got = {r["feature"]: r["dropped"] for r in se.correlation_filter(df, ["a", "b", "c"], thr).collect()}
    # c is dropped because of b even though b itself is dropped
    assert got == {"a": False, "b": True, "c": True}


def test_mutual_information_orders_dependence(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=500)
    rows_ = [(float(v), float(v + rng.normal(scale=0.1)), float(rng.normal())) for v in y]
    df = spark.createDataFrame(rows_, "y double, dep double, noise double")
    mi = {r["feature"]: r["mi"] for r in se.mutual_information(df, ["dep", "noise"], "y").collect()}
    assert mi["dep"] > 5 * mi["noise"]
