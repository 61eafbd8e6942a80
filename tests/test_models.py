"""Model layer: seeded draws, fitting, scoring, persistence (small settings)."""

import math

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.operators import folds as fo
from tidemill.operators import models as mo
from tidemill.plans.feature_pipeline import FeatureConfig, build_features, feature_columns, run_pipeline
from tidemill.session import scratch_path
from tidemill.sources import fixtures as fx


def test_draws_are_seeded_and_in_range():
    a, b = mo.draw_trials("xgboost", 5), mo.draw_trials("xgboost", 5)
    assert a == b
    for t in a:
        assert 100 <= t["n_estimators"] <= 500 and 0.01 <= t["learning_rate"] <= 0.2


def test_fit_score_roundtrip(spark):
    m = build_features(fx.daily(spark, SF_SMALL), FeatureConfig())
    feats = feature_columns(m)
    split = fo.holdout_split(m, ["date"], fo.FoldSpec(1000, 60, 0))
    train, test = split.where("role = 'train'"), split.where("role = 'test'")
    pm = mo.build_pipeline("random_forest", feats, {"n_estimators": 10, "max_depth": 4}).fit(train)
    pred = mo.score(pm, test)
    assert pred.count() == 60
    rmse = pred.select(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    zero = test.select(F.sqrt(F.avg(F.col("y") ** 2))).first()[0]
    assert math.isfinite(rmse) and rmse < zero * 1.5
    path = mo.save_model(pm, scratch_path(spark, "model"))
    again = mo.score(mo.load_model(path), test)
    assert sorted(r[1] for r in pred.collect()) == sorted(r[1] for r in again.collect())


def test_pipeline_selection_leak_free_option(spark):
    m, feats = run_pipeline(fx.daily(spark, SF_SMALL), FeatureConfig(max_features=5))
    assert 0 < len(feats) <= 5 and set(feats) <= set(m.columns)


def test_params_roundtrip_and_missing_file(spark):
    path = scratch_path(spark, "params")
    mo.save_params({"xgboost": {"n_estimators": 120, "learning_rate": 0.1}}, spark, path)
    assert mo.load_params(spark, path) == {"xgboost": {"learning_rate": 0.1, "n_estimators": 120}}
    assert mo.load_params(spark, scratch_path(spark, "absent")) == {}


def test_best_params_fall_back_when_all_trials_fail(spark):
    rows = [("xgboost", 0, '{"n_estimators": 300}', float("inf"), True),
            ("random_forest", 0, '{"max_depth": 7, "n_estimators": 110}', 0.5, True)]
    tuned = spark.createDataFrame(rows, "model string, trial int, params string, cv_rmse double, is_best boolean")
    best = mo.best_params(tuned)
    assert best["xgboost"] == mo.BASE_PARAMS["xgboost"]
    assert best["random_forest"] == {"max_depth": 7, "n_estimators": 110}


def test_broken_saved_parameters_raise_and_absent_ones_do_not(spark):
    import pytest
    path = scratch_path(spark, "broken")
    spark.createDataFrame([("xgboost", "{not json")], "model string, params string").write.json(path)
    with pytest.raises(ValueError):
        mo.load_params(spark, path)
    assert mo.load_params(spark, scratch_path(spark, "nowhere")) == {}


def test_validation_rows_are_the_latest_of_each_series(spark):
    df = spark.createDataFrame([(k, i) for k, lo in ((None, 0), ("a", 100)) for i in range(lo, lo + 20)],
                               "k string, row_idx long")
    late = mo.mark_validation(df, keys=["k"]).where("__validation").groupBy("k").agg({"row_idx": "min", "*": "count"})
    assert {tuple(r) for r in late.collect()} in ({(None, 16, 4), ("a", 116, 4)}, {(None, 4, 16), ("a", 4, 116)})
