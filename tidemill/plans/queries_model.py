"""Registered queries for folds, forecast evaluation and the model family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog import register
from tidemill.operators import evaluate as ev
from tidemill.operators import folds as fo
from tidemill.operators import models as mo
from tidemill.operators import shapley as sh
from tidemill.operators.features import rolling_mean_expr
from tidemill.operators.series import ordered_columns, row_index
from tidemill.plans.feature_pipeline import DAILY, FeatureConfig, build_features, feature_columns
from tidemill.plans.queries_series import feature_matrix_sql
from tidemill.plans.report import market_report, report_rows, table_report
from tidemill.session import scratch_path
from tidemill.sources import fixtures as fx
from tidemill.sources.fixture_sql import rounded, with_fixtures

SPEC = fo.FoldSpec(train=1000, test=60, purge=0)
T, S, P = SPEC.train, SPEC.test, SPEC.purge


def _fm_sql(body: str) -> str:
    fm, _ = feature_matrix_sql(round_result=False)
    return with_fixtures("SELECT * FROM __body", "daily").replace(
        "\nSELECT * FROM __body", f",\nfm AS (\n{fm}\n)\n{body}")


def _matrix(spark, sf):
    m = build_features(fx.daily(spark, sf), DAILY)
    return m, feature_columns(m, DAILY)


_IDX = f"""i AS (SELECT date, y, row_number() OVER (ORDER BY date) - 1 AS r FROM fm),
k AS (SELECT i.*, CASE WHEN n >= {T + P + S} THEN CAST(floor((n - {T + P}) / {S}) AS BIGINT) ELSE 0 END AS nf
      FROM i, (SELECT COUNT(*) AS n FROM fm))"""


@register("walk_forward_folds", _fm_sql(f"""SELECT * FROM (WITH {_IDX}
SELECT date, r AS row_idx, CAST(f AS BIGINT) AS fold, 'train' AS role FROM (
  SELECT date, r, unnest(generate_series(CAST(greatest(0, ceil((r - {T - 1}) / {S})) AS BIGINT),
                                         CAST(least(nf - 1, floor(r / {S})) AS BIGINT))) AS f FROM k)
UNION ALL
SELECT date, r, CAST(floor((r - {T + P}) / {S}) AS BIGINT), 'test' FROM k WHERE r >= {T + P} AND r < {T + P} + nf * {S})"""))
def q_walk_forward_folds(spark, sf):
    """Walk-forward fold membership (train 1000, test 60, purge 0) of the feature rows."""
    m, _ = _matrix(spark, sf)
    return fo.fold_membership(m.select("date"), ["date"], SPEC)


@register("holdout_split", rounded(_fm_sql(f"""SELECT * FROM (WITH {_IDX}
SELECT date, r AS row_idx, y, CASE WHEN r >= (nf - 1) * {S} + {T + P} THEN 'test' ELSE 'train' END AS role FROM k
WHERE nf > 0 AND ((r >= (nf - 1) * {S} AND r < (nf - 1) * {S} + {T})
      OR (r >= (nf - 1) * {S} + {T + P} AND r < (nf - 1) * {S} + {T + P + S})))"""), ["y"]))
def q_holdout_split(spark, sf):
    """The last fold's train and test rows."""
    m, _ = _matrix(spark, sf)
    h = fo.holdout_split(m.select("date", "y"), ["date"], SPEC)
    return h.select("date", F.col("row_idx").cast("bigint").alias("row_idx"), "y", "role")


@register("fold_summary", _fm_sql(f"""SELECT * FROM (WITH {_IDX},
f AS (SELECT DISTINCT CAST(unnest(generate_series(0, nf - 1)) AS BIGINT) AS fold FROM k),
g AS (SELECT fold, 'train' AS role, fold * {S} AS lo, fold * {S} + {T - 1} AS hi FROM f
      UNION ALL SELECT fold, 'test', fold * {S} + {T + P}, fold * {S} + {T + P + S - 1} FROM f)
SELECT fold, role, lo AS start_idx, hi AS end_idx, hi - lo + 1 AS n_rows, a.date AS start_value, b.date AS end_value
FROM g LEFT JOIN i a ON a.r = g.lo LEFT JOIN i b ON b.r = g.hi)"""))
def q_fold_summary(spark, sf):
    """M6: per fold and role the index range, size and first/last date."""
    m, _ = _matrix(spark, sf)
    return fo.fold_table(m.select("date"), ["date"], SPEC)


@register("regression_metrics", rounded(with_fixtures(
    "SELECT COUNT(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, "
    "1 - SUM((y - p) * (y - p)) / NULLIF(var_pop(y) * COUNT(*), 0) AS r2 FROM predictions", "predictions"),
    ["rmse", "mae", "r2"]))
def q_regression_metrics(spark, sf):
    """RMSE, MAE and R^2 of the naive next-day forecast."""
    return ev.regression_metrics(fx.predictions(spark, sf))


@register("direction_accuracy", rounded(with_fixtures(
    "SELECT COUNT(*) AS n, avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END) AS dir_accuracy "
    "FROM predictions WHERE sign(y) <> 0", "predictions"), ["dir_accuracy"]))
def q_direction_accuracy(spark, sf):
    """Share of correctly predicted directions (true 0 removed, predicted 0 a miss)."""
    return ev.direction_accuracy(fx.predictions(spark, sf))


@register("direction_confusion", with_fixtures(
    "SELECT g.t AS true_sign, g.q AS pred_sign, CAST(COALESCE(c.n, 0) AS BIGINT) AS count FROM "
    "(SELECT * FROM (VALUES (1, 1), (1, -1), (-1, 1), (-1, -1)) AS v(t, q)) g LEFT JOIN "
    "(SELECT CAST(sign(y) AS INTEGER) AS t, CAST(sign(p) AS INTEGER) AS q, COUNT(*) AS n FROM predictions "
    "WHERE sign(y) IN (1, -1) AND sign(p) IN (1, -1) GROUP BY 1, 2) c ON g.t = c.t AND g.q = c.q", "predictions"))
def q_direction_confusion(spark, sf):
    """2 x 2 direction confusion counts over labels (1, -1)."""
    return ev.direction_confusion(fx.predictions(spark, sf))


def _resid_hist_sql(bins: int = 40) -> str:
    from tidemill.plans.queries_eda import _hist_sql
    return rounded(with_fixtures(f"SELECT * FROM ({_hist_sql('(SELECT y - p AS residual FROM predictions)', 'residual', bins)})",
                                 "predictions"), ["lo", "hi", "density"])


@register("residual_histogram", _resid_hist_sql())
def q_residual_histogram(spark, sf):
    """40-bin histogram of forecast residuals."""
    return ev.residual_histogram(fx.predictions(spark, sf), bins=40)


def _resid_kde_sql() -> str:
    from tidemill.plans.queries_eda import _kde_sql
    return rounded(with_fixtures(f"SELECT * FROM ({_kde_sql('(SELECT y - p AS residual FROM predictions)', 'residual')})", "predictions"),
                   ["x", "density"])


@register("residual_kde", _resid_kde_sql())
def q_residual_kde(spark, sf):
    """Kernel density of forecast residuals at 300 grid points."""
    return ev.residual_kde(fx.predictions(spark, sf))


@register("price_reconstruct", rounded(with_fixtures(
    "SELECT p.date, d.adj_close * exp(p.y) AS actual_price, d.adj_close * exp(p.p) AS predicted_price "
    "FROM predictions p JOIN daily d ON p.date = d.date WHERE d.adj_close IS NOT NULL", "daily", "predictions"),
    ["actual_price", "predicted_price"]))
def q_price_reconstruct(spark, sf):
    """SC13/J1/J2: log-return forecasts to prices with the forecast day's price as base."""
    prices = fx.daily(spark, sf).select("date", F.col("adj_close").alias("price"))
    return ev.price_reconstruct(fx.predictions(spark, sf), prices, base_lag=0)


@register("date_intersection", with_fixtures(
    "SELECT date FROM daily INTERSECT SELECT date FROM ohlc", "daily", "ohlc"))
def q_date_intersection(spark, sf):
    """Dates present in both the price table and the candle table (semi join)."""
    d = fx.daily(spark, sf).select("date")
    return d.join(fx.ohlc(spark, sf).select("date"), "date", "left_semi").distinct()


# ---- naive forecasters evaluated walk-forward (deterministic, SQL-checkable) ----

def _naive(spark, sf):
    pr = fx.predictions(spark, sf).select("date", "y", "p")
    pr = ordered_columns(pr, ["date"], [], lambda w: {"mean5": rolling_mean_expr("p", w, 5)}, back=4, fwd=0,
                         mode="single")
    pr = pr.na.drop(subset=["mean5"])
    long = pr.select("date", "y", F.inline(F.array(
        F.struct(F.lit("zero").alias("model"), F.lit(0.0).alias("pred")),
        F.struct(F.lit("persistence").alias("model"), F.col("p").alias("pred")),
        F.struct(F.lit("mean5").alias("model"), F.col("mean5").alias("pred")))))
    return long


_NAIVE_SQL = """WITH b AS (SELECT date, y, p, CASE WHEN count(p) OVER w = 5 THEN avg(p) OVER w END AS mean5 FROM predictions
                WINDOW w AS (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
c AS (SELECT * FROM b WHERE mean5 IS NOT NULL),
lng AS (SELECT date, y, 'zero' AS model, 0.0 AS pred FROM c UNION ALL SELECT date, y, 'persistence', p FROM c
        UNION ALL SELECT date, y, 'mean5', mean5 FROM c),
i AS (SELECT *, dense_rank() OVER (ORDER BY date) - 1 AS r FROM lng),
k AS (SELECT i.*, CASE WHEN n >= {tps} THEN CAST(floor((n - {tp}) / {s}) AS BIGINT) ELSE 0 END AS nf
      FROM i, (SELECT COUNT(*) AS n FROM c))"""


def _naive_with_folds(spark, sf):
    long = _naive(spark, sf)
    dates = long.select("date").distinct()
    idx = row_index(dates, ["date"], mode="single")
    n = dates.count()
    nf = SPEC.n_folds(n)
    start = T + P
    j = long.join(idx, "date")
    return j.withColumn("fold", F.when((F.col("row_idx") >= start) & (F.col("row_idx") < start + nf * S),
                                       F.floor((F.col("row_idx") - start) / S))), nf


@register("cv_scores", rounded(with_fixtures(
    "SELECT * FROM (" + _NAIVE_SQL.format(tps=T + P + S, tp=T + P, s=S) + f"""
SELECT model, COUNT(*) AS n_folds, avg(rmse) AS cv_rmse FROM (
  SELECT model, CAST(floor((r - {T + P}) / {S}) AS BIGINT) AS fold, sqrt(avg((y - pred) * (y - pred))) AS rmse
  FROM k WHERE r >= {T + P} AND r < {T + P} + nf * {S} GROUP BY 1, 2) GROUP BY model)""", "predictions"),
    ["cv_rmse"]))
def q_cv_scores(spark, sf):
    """Mean of per-fold RMSE over walk-forward test windows, per forecaster."""
    j, _ = _naive_with_folds(spark, sf)
    per_fold = (j.where(F.col("fold").isNotNull()).groupBy("model", "fold")
                .agg(F.sqrt(F.avg((F.col("y") - F.col("pred")) ** 2)).alias("rmse")))
    return per_fold.groupBy("model").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("rmse").alias("cv_rmse"))


@register("leaderboard", rounded(with_fixtures(
    "SELECT * FROM (" + _NAIVE_SQL.format(tps=T + P + S, tp=T + P, s=S) + f"""
SELECT *, row_number() OVER (ORDER BY rmse, dir_accuracy DESC, model) AS rank FROM (
  SELECT model, sqrt(avg((y - pred) * (y - pred))) AS rmse,
         1 - SUM((y - pred) * (y - pred)) / NULLIF(var_pop(y) * COUNT(*), 0) AS r2,
         avg(CASE WHEN sign(y) <> 0 THEN CASE WHEN sign(y) = sign(pred) THEN 1.0 ELSE 0.0 END END) AS dir_accuracy
  FROM k WHERE nf > 0 AND r >= (nf - 1) * {S} + {T + P} AND r < (nf - 1) * {S} + {T + P + S} GROUP BY model))""",
    "predictions"), ["rmse", "r2", "dir_accuracy"]))
def q_leaderboard(spark, sf):
    """Forecasters on the hold-out window ranked by RMSE (ties: direction accuracy)."""
    j, nf = _naive_with_folds(spark, sf)
    test = j.where(F.col("fold") == nf - 1)
    met = ev.regression_metrics(test, "y", "pred", by=["model"]).select("model", "rmse", "r2")
    da = ev.direction_accuracy(test, "y", "pred", by=["model"]).select("model", "dir_accuracy")
    scores = met.join(da, "model", "left")
    return mo.leaderboard(scores).withColumn("rank", F.col("rank").cast("bigint"))


@register("pipeline_summary", rounded(_fm_sql(
    "SELECT COUNT(*) AS n_rows, 20 AS n_features, min(y) AS y_min, max(y) AS y_max, "
    "(SELECT arg_max(adj_close, date) FROM daily) AS last_price FROM fm"), ["y_min", "y_max", "last_price"]))
def q_pipeline_summary(spark, sf):
    """Shape of the feature matrix, target range and the last raw price."""
    m, feats = _matrix(spark, sf)
    last = fx.daily(spark, sf).agg(F.max_by("adj_close", "date").alias("last_price"))
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(feats)).alias("n_features"),
                 F.min("y").alias("y_min"), F.max("y").alias("y_max")).join(last, how="inner")


# ---- Spark ML (rows-only checks: fits are seeded but not SQL-expressible) ----

def _prices(spark, sf):
    return fx.daily(spark, sf).select("date", F.col("adj_close").alias("price"))


@register("train_models")
def q_train_models(spark, sf):
    """The four presets fitted on the hold-out train window, price-space scores."""
    m, feats = _matrix(spark, sf)
    scores, _, _ = mo.train_models(m, feats, _prices(spark, sf), spec=SPEC)
    return mo.leaderboard(scores)


PANEL_SPEC = fo.FoldSpec(train=20, test=5, purge=0)


@register("panel_scores")
def q_panel_scores(spark, sf):
    """M10/M11 over many series: one forest for every user's events, fitted on the train rows of each
    user's last fold and scored in price space; the training rows grow with the events."""
    cfg = FeatureConfig(target_col="value", date_col="ts", keys=("user_id",), tie_breakers=("event_id",))
    ticks = fx.ticks(spark, sf)
    m = build_features(ticks, cfg)
    scores, _, _ = mo.train_models(m, feature_columns(m, cfg), ticks.withColumnRenamed("value", "price"),
                                   models=["random_forest"], spec=PANEL_SPEC, order_by="ts", keys=["user_id"],
                                   tie_breakers=["event_id"])
    return scores


def _fitted(spark, sf, model="random_forest"):
    m, feats = _matrix(spark, sf)
    split = fo.holdout_split(m, ["date"], SPEC)
    pm = mo.build_pipeline(model, feats).fit(split.where("role = 'train'"))
    return pm, split.where("role = 'test'"), feats


@register("score")
def q_score(spark, sf):
    """Batch scoring of the hold-out test rows with a fitted pipeline."""
    pm, test, _ = _fitted(spark, sf)
    return mo.score(pm, test)


@register("forecast_table")
def q_forecast_table(spark, sf):
    """Date, actual and predicted next-day price for the last 100 test rows."""
    pm, test, _ = _fitted(spark, sf)
    pred = mo.score(pm, test).withColumnRenamed("prediction", "p")
    px = ev.price_reconstruct(pred, _prices(spark, sf), base_lag=0)
    return px.orderBy(F.col("date").desc()).limit(100)


@register("feature_importance")
def q_feature_importance(spark, sf):
    """Split-gain importances of the fitted forest."""
    pm, _, feats = _fitted(spark, sf)
    return mo.feature_importance(pm, feats)


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    """RMSE increase per permuted feature on the hold-out test rows."""
    pm, test, feats = _fitted(spark, sf)
    return mo.permutation_importance(pm, test.drop("row_idx", "role"), feats)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """Fitted pipeline saved to the shared folder, loaded back, used for scoring."""
    pm, test, _ = _fitted(spark, sf)
    path = mo.save_model(pm, scratch_path(spark, "model"))
    return mo.score(mo.load_model(path), test)


@register("tune_three_trials")
def q_tune(spark, sf):
    """M7/M8/M9: seeded random search scored on the folds before the hold-out: a small search of the
    forest preset, three trials on two folds (the full one is ``models.tune``'s default)."""
    m, feats = _matrix(spark, sf)
    return mo.tune(m, feats, models=["random_forest"], n_trials=3, spec=SPEC, n_cv_folds=2)


@register("tune")
def q_tune_whole(spark, sf):
    """M7/M8/M9: Parzen search of all four presets, 50 trials on the 3 folds before the hold-out fold."""
    m, feats = _matrix(spark, sf)
    return mo.tune(m, feats, spec=SPEC)


_ROW = "adj_close / 1000 AS a, volume / 1000.0 AS b, day(date) + 0.0 AS c, month(date) + 0.0 AS d"


@register("shapley_values", rounded(with_fixtures(f"""SELECT * FROM (WITH r AS (SELECT date, {_ROW} FROM daily WHERE adj_close IS NOT NULL AND volume IS NOT NULL),
x AS (SELECT * FROM r ORDER BY date DESC LIMIT 50),
o AS (SELECT a AS a0, b AS b0, c AS c0, d AS d0 FROM r ORDER BY date LIMIT 1),
j AS (SELECT *, a0 * b0 / 100 + 3 * c0 - d0 * c0 / 10 AS base, a * b / 100 + 3 * c - d * c / 10 AS prediction FROM x, o)
SELECT date, 'a' AS feature, a AS value, (a - a0) * (b + b0) / 200 AS contribution, base, prediction FROM j
UNION ALL SELECT date, 'b', b, (b - b0) * (a + a0) / 200, base, prediction FROM j
UNION ALL SELECT date, 'c', c, 3 * (c - c0) - (c - c0) * (d + d0) / 20, base, prediction FROM j
UNION ALL SELECT date, 'd', d, (d0 - d) * (c + c0) / 20, base, prediction FROM j)""", "daily"),
    ["value", "contribution", "base", "prediction"]))
def q_shapley_values(spark, sf):
    """Exact Shapley values (all orders) of a written formula over the last 50 days, against its closed form."""
    r = fx.daily(spark, sf).where("adj_close is not null and volume is not null").select(
        "date", (F.col("adj_close") / 1000).alias("a"), (F.col("volume") / 1000.0).alias("b"),
        F.dayofmonth("date").cast("double").alias("c"), F.month("date").cast("double").alias("d"))
    return sh.shapley_values(lambda df: df.withColumn("prediction", F.expr("a * b / 100 + 3 * c - d * c / 10")),
                             r.orderBy(F.col("date").desc()).limit(50), r.orderBy("date").limit(1), ["a", "b", "c", "d"], ["date"], None)


@register("shapley_summary")
def q_shapley_summary(spark, sf):
    """The 15 features that move a boosted forecast most over the last 50 hold-out rows, from sampled orders."""
    m, feats = _matrix(spark, sf)
    _, fitted, split = mo.train_models(m, feats, _prices(spark, sf), models=["catboost"], spec=SPEC)
    last = split.where("role = 'test'").orderBy(F.col("date").desc()).limit(50)
    back = split.where("role = 'train'").orderBy(F.xxhash64("date")).limit(20)
    values = sh.shapley_values(fitted["catboost"].transform, last, back, feats, ["date"], 10)
    return sh.shapley_summary(values, 15)


@register("eda_report")
def q_eda_report(spark, sf):
    """Market report and per-column table report, as (part, row) in long form."""
    rep = market_report(fx.assets(spark, sf), fx.ohlc(spark, sf), "adj_close", ["a_price", "n_price", "r_price"])
    rep.update({f"table:{k}": v for k, v in table_report(fx.table(spark, sf, "labels")).items()})
    return report_rows(rep)
