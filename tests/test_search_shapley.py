"""Parzen search on known surfaces, the walk-forward search, and sampled Shapley values."""

import json
import math
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.operators import models as mo
from tidemill.operators import shapley as sh
from tidemill.operators.folds import FoldSpec
from tidemill.operators.search import ParzenSearch
from tidemill.plans.feature_pipeline import FeatureConfig, build_features, feature_columns
from tidemill.sources import fixtures as fx

SPACE = {"n": ("int", 1, 60), "rate": ("log", 1e-4, 1.0), "share": ("float", 0.0, 1.0)}


def _surface(p):
    return ((p["n"] - 41) / 60) ** 2 + (math.log10(p["rate"]) + 2.7) ** 2 / 16 + (p["share"] - 0.2) ** 2


def _run(seed, startup, n=60, batch=1):
    s = ParzenSearch(SPACE, seed, startup)
    for _ in range(0, n, batch):
        for i, p in [s.ask() for _ in range(batch)]:
            s.tell(i, _surface(p))
    return s


def test_parzen_search_beats_random_draws():
    learned = [_run(k, 10).best()[1] for k in range(12)]
    in_batches = [_run(k, 10, batch=10).best()[1] for k in range(12)]
    blind = [_run(k, 10_000).best()[1] for k in range(12)]
    assert sorted(learned)[6] < 0.4 * sorted(blind)[6]
    assert sorted(in_batches)[6] < sorted(blind)[6]


def test_search_bounds_failures_and_seeds():
    s = _run(5, 4)
    assert _run(5, 4).trials == s.trials and _run(6, 4).trials != s.trials
    for p, _ in s.trials:
        assert 1 <= p["n"] <= 60 and isinstance(p["n"], int) and 1e-4 <= p["rate"] <= 1 and 0 <= p["share"] <= 1
    failing = ParzenSearch({"a": ("float", 2, 2)}, 0, 1)
    assert failing.best() is None
    for _ in range(5):
        i, p = failing.ask()
        assert p == {"a": 2}
        failing.tell(i, float("nan"))
    assert failing.best() is None
    for bad in ({"a": ("log", 0, 1)}, {"a": ("int", 3, 2)}, {"a": ("text", 0, 1)}):
        with pytest.raises(ValueError):
            ParzenSearch(bad)


def _matrix(spark):
    m = build_features(fx.daily(spark, SF_SMALL), FeatureConfig())
    return m, feature_columns(m)


def test_tune_learns_and_its_result_trains(spark, monkeypatch):
    for m, space in {"xgboost": {"n_estimators": ("int", 5, 15), "learning_rate": ("log", 0.05, 0.3), "max_depth": ("int", 2, 3)},
                     "random_forest": {"n_estimators": ("int", 3, 6), "max_depth": ("int", 2, 4)}}.items():
        monkeypatch.setitem(mo.SEARCH_SPACE, m, space)
    matrix, feats = _matrix(spark)
    tuned = mo.tune(matrix, feats, ["xgboost", "random_forest"], n_trials=6, spec=FoldSpec(1000, 60, 0), batch=3)
    rows = tuned.collect()
    assert len(rows) == 12 and all(math.isfinite(r.cv_rmse) for r in rows)
    for m in ("xgboost", "random_forest"):
        mine = [r for r in rows if r.model == m]
        assert [r.cv_rmse for r in mine if r.is_best] == [min(r.cv_rmse for r in mine)]
    best = mo.best_params(tuned)
    assert {**mo.BASE_PARAMS["xgboost"], **json.loads(next(r.params for r in rows if r.is_best and r.model == "xgboost"))} == best["xgboost"]
    prices = fx.daily(spark, SF_SMALL).select("date", F.col("adj_close").alias("price"))
    scores, fitted, _ = mo.train_models(matrix, feats, prices, ["xgboost", "random_forest"], best)
    assert set(fitted) == {"xgboost", "random_forest"} and len(fitted["random_forest"].trees) == best["random_forest"]["n_estimators"]
    assert all(math.isfinite(r.rmse) and r.error is None for r in scores.collect())


def test_a_bad_parameter_is_a_row_and_bad_data_raises(spark):
    matrix, feats = _matrix(spark)
    prices = fx.daily(spark, SF_SMALL).select("date", F.col("adj_close").alias("price"))
    scores, fitted, _ = mo.train_models(matrix, feats, prices, ["xgboost", "random_forest"],
                                        {"xgboost": {"wings": 2}, "random_forest": {"n_estimators": 2, "max_depth": 2}})
    got = {r.model: r for r in scores.collect()}
    assert "unknown parameter" in got["xgboost"].error and got["xgboost"].rmse is None
    assert got["random_forest"].error is None and set(fitted) == {"random_forest"}
    with pytest.raises(ValueError, match="null or NaN"):
        mo.train_models(matrix.withColumn(feats[0], F.lit(None).cast("double")), feats, prices, ["random_forest"])


# ---------------------------------------------------------------- Shapley values

X = ["a", "b", "c", "d"]


def _f(a, b, c, d):
    return a * b + max(c, 0.5) * d + 3 * a - (d if b > 1 else 0.0)


def _predict(df):
    return df.withColumn("prediction", F.expr("a * b + greatest(c, 0.5d) * d + 3 * a - if(b > 1, d, 0d)"))


def test_all_orders_equal_brute_force(spark):
    rows = [(1, 2.0, 1.5, -1.0, 4.0), (2, -1.0, 0.5, 2.0, 1.0), (None, 0.0, 3.0, 0.7, -2.0), (4, None, 1.0, 1.0, 1.0)]
    back = [(0.5, 1.0, 0.0, 2.0), (1.5, -1.0, 3.0, 0.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    out = sh.shapley_values(_predict, df, spark.createDataFrame(back, "a double, b double, c double, d double"), X, ["id"], None).collect()
    assert len(out) == 12
    held = back[:2]
    v = lambda x, s: sum(_f(*[x[k] if k in s else b[k] for k in range(4)]) for b in held) / 2
    for r in rows[:3]:
        x = r[1:]
        want = [0.0] * 4
        for order in permutations(range(4)):
            for k, f in enumerate(order):
                want[f] += (v(x, set(order[:k + 1])) - v(x, set(order[:k]))) / 24
        mine = {o.feature: o for o in out if o.id == r[0]}
        assert [mine[c].contribution for c in X] == pytest.approx(want)
        assert [mine[c].value for c in X] == list(x)
        assert mine["a"].base == pytest.approx(v(x, set())) and mine["a"].prediction == pytest.approx(_f(*x))


def test_sampled_orders_add_up(spark):
    matrix, feats = _matrix(spark)
    prices = fx.daily(spark, SF_SMALL).select("date", F.col("adj_close").alias("price"))
    _, fitted, split = mo.train_models(matrix, feats, prices, ["random_forest"], {"random_forest": {"n_estimators": 5, "max_depth": 4}})
    last = split.where("role = 'test'").orderBy(F.col("date").desc()).limit(4)
    back = split.where("role = 'train'").orderBy("date").limit(3)
    out = sh.shapley_values(fitted["random_forest"].transform, last, back, feats, ["date"], 4)
    sums = out.groupBy("date").agg(F.sum("contribution").alias("s"), F.max("base").alias("b"), F.max("prediction").alias("p")).collect()
    assert len(sums) == 4 and all(r.s == pytest.approx(r.p - r.b) for r in sums)
    direct = {r.date: r.prediction for r in fitted["random_forest"].transform(last).collect()}
    assert {r.date: pytest.approx(r.p) for r in sums} == direct
    top = sh.shapley_summary(out, 15).collect()
    assert len(top) == 15 and [r.mean_abs for r in top] == sorted((r.mean_abs for r in top), reverse=True)


def test_orders_and_limits(spark):
    assert len(sh.draw_permutations(4, None)) == 24 == len(sh.draw_permutations(4, 500))
    some = sh.draw_permutations(9, 5)
    assert len(some) == 5 and some[1] == some[0][::-1] and all(sorted(o) == list(range(9)) for o in some)
    with pytest.raises(ValueError):
        sh.draw_permutations(9, None)
    df = spark.createDataFrame([(1, 1.0)], "id int, a double")
    for bad in (df.limit(0), spark.range(1001).select(F.col("id").cast("double").alias("a"))):
        with pytest.raises(ValueError):
            sh.shapley_values(lambda d: d, df, bad, ["a"], ["id"])
