"""Properties from the test strategy: no look-ahead in fitted statistics, invertible
scaling, seed-stable models."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.operators import folds as fo
from tidemill.operators import models as mo
from tidemill.operators import scale as sc
from tidemill.plans.feature_pipeline import FeatureConfig, build_features, feature_columns
from tidemill.sources import fixtures as fx

SPEC = fo.FoldSpec(1000, 60, 0)


def test_scaler_fit_ignores_rows_after_train_end(spark):
    d = fx.daily(spark, SF_SMALL)
    split = fo.holdout_split(d, ["date"], SPEC)
    train = split.where("role = 'train'").drop("row_idx", "role")
    p1 = sc.fit_scaler(train, ["adj_close", "volume"]).first()
    tampered = split.withColumn("adj_close", F.when(F.col("role") == "test", F.col("adj_close") * 100)
                                .otherwise(F.col("adj_close")))
    p2 = sc.fit_scaler(tampered.where("role = 'train'"), ["adj_close", "volume"]).first()
    assert p1 == p2


def test_standard_scaling_is_invertible(spark):
    d = fx.daily(spark, SF_SMALL).select("date", "adj_close")
    params = sc.fit_scaler(d, ["adj_close"]).first()
    mu, sd = params["adj_close__a"], params["adj_close__b"]
    back = sc.scale(d, "standard", ["adj_close"]).withColumnRenamed("adj_close", "z").join(d, "date")
    worst = back.select(F.max(F.abs(F.col("z") * sd + mu - F.col("adj_close")))).first()[0]
    assert worst < 1e-6 * abs(mu)


def test_models_are_seed_stable(spark):
    m = build_features(fx.daily(spark, SF_SMALL), FeatureConfig())
    feats = feature_columns(m)
    split = fo.holdout_split(m, ["date"], SPEC)
    train, test = split.where("role = 'train'"), split.where("role = 'test'")
    params = {"n_estimators": 8, "max_depth": 4}
    a = mo.score(mo.build_pipeline("random_forest", feats, params).fit(train), test)
    b = mo.score(mo.build_pipeline("random_forest", feats, params).fit(train), test)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
