"""Walk-forward modelling with tree ensembles.

Training and search grow histogram ensembles (``boosting``): all presets, trials and folds of a
step share one binned table and one job.  ``build_pipeline`` maps a preset onto Spark ML's
``GBTRegressor`` / ``RandomForestRegressor`` instead, for use in other pipelines.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.boosting import Ensemble, Fit, TreeSpec, bin_table, conditions, fit_all, fit_binned
from tidemill.operators.evaluate import direction_accuracy, price_reconstruct, regression_metrics
from tidemill.operators.folds import FoldSpec, holdout_split
from tidemill.operators.search import ParzenSearch
from tidemill.operators.series import _join_on, row_index

SEED = 42
MODELS = ["xgboost", "lightgbm", "catboost", "random_forest"]

# Base parameters of the four presets (library-neutral names).
BASE_PARAMS = {
    "xgboost": {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 5},
    "lightgbm": {"n_estimators": 200, "learning_rate": 0.05},
    "catboost": {"iterations": 500, "learning_rate": 0.05, "depth": 6},
    "random_forest": {"n_estimators": 100, "max_depth": 10},
}

# Search space per preset -- (kind, low, high); kind int | float | log.
SEARCH_SPACE = {
    "xgboost": {"n_estimators": ("int", 100, 500), "learning_rate": ("log", 0.01, 0.2),
                "max_depth": ("int", 3, 7), "subsample": ("float", 0.6, 0.9),
                "colsample_bytree": ("float", 0.6, 0.9)},
    "catboost": {"iterations": ("int", 200, 800), "learning_rate": ("log", 0.01, 0.2),
                 "depth": ("int", 4, 8), "l2_leaf_reg": ("log", 1, 10)},
    "lightgbm": {"n_estimators": ("int", 100, 500), "learning_rate": ("log", 0.01, 0.2),
                 "num_leaves": ("int", 20, 100), "max_depth": ("int", 3, 10), "min_child_samples": ("int", 10, 50)},
    "random_forest": {"n_estimators": ("int", 100, 134), "max_depth": ("int", 5, 20),
                      "min_samples_split": ("int", 2, 10)},
}


# What the presets leave to their libraries' defaults.
DEFAULTS = {"xgboost": {"l2_leaf_reg": 1.0}, "catboost": {"l2_leaf_reg": 3.0},
            "lightgbm": {"num_leaves": 31, "min_child_samples": 20, "max_depth": 12}, "random_forest": {}}


def tree_spec(name: str, params: dict | None = None, seed: int = SEED) -> TreeSpec:
    """A preset's parameters as a histogram ensemble; an unknown parameter raises."""
    p = {**DEFAULTS[name], **BASE_PARAMS[name], **(params or {})}
    names = {"n_estimators": "rounds", "iterations": "rounds", "learning_rate": "rate", "max_depth": "depth", "depth": "depth",
             "min_child_samples": "min_leaf", "min_samples_split": "min_split", "l2_leaf_reg": "l2", "num_leaves": "leaves",
             "subsample": "rows", "colsample_bytree": "columns"}
    whole = ("rounds", "depth", "leaves")
    unknown = sorted(set(p) - set(names))
    if unknown:
        raise ValueError(f"unknown parameter of {name}: {', '.join(unknown)}")
    kw = {names[k]: int(v) if names[k] in whole else float(v) for k, v in p.items()}
    return TreeSpec(**kw, bagged=name == "random_forest", seed=seed)


def estimator(name: str, params: dict | None = None, label: str = "y", features: str = "features",
              seed: int = SEED):
    """Spark estimator for a preset; parameters without a Spark counterpart are ignored."""
    p = {**BASE_PARAMS[name], **(params or {})}
    if name == "random_forest":
        return RandomForestRegressor(
            labelCol=label, featuresCol=features, seed=seed, numTrees=int(p["n_estimators"]),
            maxDepth=int(p["max_depth"]), minInstancesPerNode=max(1, int(p.get("min_samples_split", 2)) // 2))
    kw = dict(labelCol=label, featuresCol=features, seed=seed,
              maxIter=int(p.get("n_estimators", p.get("iterations", 100))),
              stepSize=float(p.get("learning_rate", 0.1)),
              maxDepth=int(p.get("max_depth", p.get("depth", 5))))
    if "subsample" in p:
        kw["subsamplingRate"] = float(p["subsample"])
    if "colsample_bytree" in p:
        kw["featureSubsetStrategy"] = repr(float(p["colsample_bytree"]))
    if "min_child_samples" in p:
        kw["minInstancesPerNode"] = int(p["min_child_samples"])
    return GBTRegressor(**kw)


VALIDATION_SHARE = 0.2  # latest part of the training rows that decides when boosting stops


def build_pipeline(name: str, feature_cols: Sequence[str], params: dict | None = None, label: str = "y",
                   validation: str | None = None) -> Pipeline:
    """Assemble -> tree ensemble (trees split by order, so features need no scaling).

    ``validation`` names a boolean column: boosting is fitted on the rows where it is false and
    stops when the others no longer improve; bagged trees ignore it."""
    fitter = estimator(name, params, label=label)
    if validation and isinstance(fitter, GBTRegressor):
        fitter = fitter.setParams(validationIndicatorCol=validation)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error"), fitter])


def mark_validation(train: DataFrame, idx_col: str = "row_idx", share: float = VALIDATION_SHARE,
                    keys: Sequence[str] = ()) -> DataFrame:
    """``__validation``: true in the latest ``share`` of the rows' index range (of each series)."""
    if keys:
        ends = train.groupBy(*keys).agg(F.min(idx_col).alias("__lo"), F.max(idx_col).alias("__hi"))
        both = _join_on(train, ends, keys)
        span = F.col("__hi") - F.col("__lo") + 1
        late = F.col(idx_col) > F.col("__hi") - F.lit(share) * span
        return both.withColumn("__validation", (span > 10) & late).drop("__lo", "__hi")
    b = train.agg(F.min(idx_col).alias("lo"), F.max(idx_col).alias("hi")).first()
    if b["lo"] is None or b["hi"] - b["lo"] < 10:
        return train.withColumn("__validation", F.lit(False))
    return train.withColumn("__validation", F.col(idx_col) > b["hi"] - share * (b["hi"] - b["lo"] + 1))


def score(model: PipelineModel | Ensemble, df: DataFrame, keep: Sequence[str] = ("date", "y")) -> DataFrame:
    """Batch scoring: ``keep`` columns plus ``prediction`` (distributed ``transform``)."""
    return model.transform(df).select(*[c for c in keep if c in df.columns], "prediction")


def draw_trials(model: str, n_trials: int, seed: int = SEED) -> list[dict]:
    """Seeded random draws from the preset's search space (parameter dictionaries)."""
    search = ParzenSearch(SEARCH_SPACE[model], f"{model}:{seed}", startup=n_trials + 1)
    return [search.ask()[1] for _ in range(n_trials)]


def _fold_fits(name: str, spec: TreeSpec, folds: FoldSpec, which: Sequence[int]) -> list[Fit]:
    """A fit for each fold; boosting stops by the latest part of the fold's training rows."""
    out = []
    for f in which:
        lo = f * folds.test
        hi, test = lo + folds.train, lo + folds.train + folds.purge
        late = hi if spec.bagged else hi - int(VALIDATION_SHARE * folds.train)
        out.append(Fit(f"{name}/{f}", spec, f"row_idx >= {lo} and row_idx < {late}",
                       None if late == hi else f"row_idx >= {late} and row_idx < {hi}",
                       f"row_idx >= {test} and row_idx < {test + folds.test}"))
    return out


def tune(matrix: DataFrame, feature_cols: Sequence[str], models: Sequence[str] = MODELS, n_trials: int = 50,
         spec: FoldSpec = FoldSpec(), n_cv_folds: int = 3, batch: int = 10, order_by: str = "date",
         seed: int = SEED) -> DataFrame:
    """Parzen search of every preset, scored on the last ``n_cv_folds`` folds *before* the hold-out fold.

    Returns ``(model, trial, params, cv_rmse, is_best)``; the best params are merged over the
    preset's base parameters.  ``batch`` trials of every preset are asked for at a time, and all
    their folds are one job on a table that is binned once; what the last batches showed decides
    the next.  Parameters that no ensemble accepts score +inf; a failure of the job is raised.
    """
    spark = matrix.sparkSession
    indexed = row_index(matrix, [order_by]).persist()
    try:
        nf = spec.n_folds(indexed.count())
        if nf < 2:
            raise ValueError("need at least one fold before the hold-out fold to tune")
        folds = list(range(max(0, nf - 1 - n_cv_folds), nf - 1))
        every = [f for m in models for f in _fold_fits(m, tree_spec(m), spec, folds)]
        table = bin_table(indexed, feature_cols, "y", conditions(every))
    finally:
        indexed.unpersist()
    searches = {m: ParzenSearch(SEARCH_SPACE[m], f"{m}:{seed}") for m in models}
    for done in range(0, n_trials, batch):
        asked = {}
        for m, search in searches.items():
            for _ in range(min(batch, n_trials - done)):
                i, params = search.ask()
                try:
                    asked[m, i] = _fold_fits(f"{m}/{i}", tree_spec(m, params), spec, folds)
                except (TypeError, ValueError):
                    search.tell(i, float("inf"))
        fitted = fit_binned(table, [f for fs in asked.values() for f in fs], keep=False)
        for (m, i), fs in asked.items():
            searches[m].tell(i, sum(fitted[f.name].error for f in fs) / len(fs))
    rows = [(m, i, json.dumps({**BASE_PARAMS[m], **p}, sort_keys=True), s)
            for m, search in searches.items() for i, (p, s) in enumerate(search.trials)]
    res = spark.createDataFrame(rows, "model string, trial int, params string, cv_rmse double")
    best = res.groupBy("model").agg(F.min(F.struct("cv_rmse", "trial")).alias("__best"))
    return (res.join(F.broadcast(best), "model")   # one row a preset
            .withColumn("is_best", F.col("trial") == F.col("__best.trial")).drop("__best"))


def best_params(tuned: DataFrame) -> dict:
    """``model -> params`` of the best trial; a model whose trials all failed keeps its base."""
    out = {m: dict(BASE_PARAMS[m]) for m in MODELS}
    for r in tuned.where("is_best").orderBy("model", "trial").collect():
        if r["cv_rmse"] != float("inf"):
            out[r["model"]] = json.loads(r["params"])
    return out


def train_models(matrix: DataFrame, feature_cols: Sequence[str], prices: DataFrame,
                 models: Sequence[str] = MODELS, params: dict | None = None, spec: FoldSpec = FoldSpec(),
                 base_lag: int = 0, order_by: str = "date", parallelism: int = 4, keys: Sequence[str] = (),
                 tie_breakers: Sequence[str] = ()):
    """Fit every preset on the hold-out train rows and evaluate on its test rows.

    Returns ``(scores, fitted, split)``: ``scores`` has ``model, rmse, r2, dir_accuracy``
    (price space) and ``error``, ``fitted`` maps model -> ``Ensemble``.  Parameters that no ensemble
    accepts are a row of scores with their error; any other failure is raised.  Boosting stops
    early on the latest training rows.  All presets are fitted in one job on one binned table.

    With ``keys`` one panel model per preset is fitted on the hold-out train rows of every series
    together, and scored on all their test rows; ``tie_breakers`` complete ``order_by``.
    """
    rows_by = [*keys, *tie_breakers]
    split = holdout_split(matrix, [order_by, *tie_breakers], spec, keys).persist()
    spark = matrix.sparkSession
    train = mark_validation(split.where("role = 'train'"), keys=keys)
    early, late = "not __validation", "__validation"
    fits, errors = [], {}
    for m in models:
        try:
            shape = tree_spec(m, (params or {}).get(m))
        except (TypeError, ValueError) as e:
            errors[m] = f"{type(e).__name__}: {str(e)[:300]}"
            continue
        stops = not shape.bagged
        fits.append(Fit(m, shape, early if stops else "true", late if stops else None))
    fitted = fit_all(train, feature_cols, "y", fits) if fits else {}
    test = split.where("role = 'test'").select(*dict.fromkeys([*rows_by, order_by, "y", *feature_cols])).persist()
    base = price_reconstruct(test.withColumn("p", F.lit(0.0)), prices, order_by, "y", "p", base_lag=base_lag, keys=rows_by)
    base = base.select(*rows_by, order_by, "actual_price", F.col("predicted_price").alias("__base")).persist()

    def score_one(m):
        pred = score(fitted[m], test, keep=[*rows_by, order_by, "y"])
        both = _join_on(pred, base, [*rows_by, order_by]).withColumn("predicted_price", F.col("__base") * F.exp("prediction"))
        met = regression_metrics(both, "actual_price", "predicted_price").first()
        da = direction_accuracy(pred, "y", "prediction").first()
        return m, met["rmse"], met["r2"], da["dir_accuracy"], None

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(score_one, fitted)) + [(m, None, None, None, e) for m, e in errors.items()]
    base.unpersist()
    test.unpersist()
    scores = spark.createDataFrame(rows, "model string, rmse double, r2 double, dir_accuracy double, error string")
    return scores, fitted, split


def leaderboard(scores: DataFrame) -> DataFrame:
    """Scores ranked by RMSE (ascending), ties by direction accuracy (descending)."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col("rmse").asc_nulls_last(), F.col("dir_accuracy").desc_nulls_last(), "model")
    return scores.withColumn("rank", F.row_number().over(w))


def feature_importance(model: PipelineModel | Ensemble, feature_cols: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` from the fitted ensemble (split-gain based), descending."""
    from pyspark.sql import SparkSession
    imp = model.importance() if isinstance(model, Ensemble) else model.stages[-1].featureImportances.toArray()
    return SparkSession.getActiveSession().createDataFrame([(c, float(v)) for c, v in zip(feature_cols, imp)], "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature")


def permutation_importance(model: PipelineModel | Ensemble, df: DataFrame, feature_cols: Sequence[str], seed: int = SEED,
                           order_by: str = "date") -> DataFrame:
    """RMSE increase when one feature's values are permuted across rows.

    The permutation is a join: rows are numbered in date order and in a seeded hash
    order, and each row gets a donor row.  All features are scored in one ``transform``.
    """
    features = list(feature_cols)
    idx = row_index(df, [order_by], idx_col="__i")
    hashed = idx.withColumn("__h", F.xxhash64(F.col("__i"), F.lit(seed)))
    donors = row_index(hashed.select("__h", "__i", F.struct(*features).alias("__d")), ["__h", "__i"], idx_col="__j")
    both = idx.join(donors.select(F.col("__j").alias("__i"), "__d"), "__i")
    # every row once as it is (-1) and once per feature with that feature's donor value
    wide = both.withColumn("__k", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    swapped = wide.withColumns({c: F.when(F.col("__k") == k, F.col(f"__d.{c}")).otherwise(F.col(c))
                                for k, c in enumerate(features)})
    rmse = regression_metrics(model.transform(swapped), "y", "prediction", by=["__k"]).select("__k", "rmse")
    base = rmse.where("__k = -1").select(F.col("rmse").alias("__base"))
    names = F.element_at(F.array(*map(F.lit, features)), F.col("__k") + 1)
    return (rmse.where("__k >= 0").join(F.broadcast(base))  # one row
            .select(names.alias("feature"), (F.col("rmse") - F.col("__base")).alias("rmse_increase"))
            .orderBy(F.col("rmse_increase").desc(), "feature"))


def save_params(params: dict, spark, path: str) -> str:
    """Tuned parameters as a small JSON table ``(model, params)`` (one file)."""
    rows = [(m, json.dumps(p, sort_keys=True)) for m, p in sorted(params.items())]
    spark.createDataFrame(rows, "model string, params string").coalesce(1).write.mode("overwrite").json(path)
    return path


def load_params(spark, path: str) -> dict:
    """Read tuned parameters back; a missing file gives ``{}`` (base presets), a broken one
    raises."""
    try:
        saved = spark.read.schema("model string, params string").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["model"]: json.loads(r["params"]) for r in saved.collect()}


def save_scores(scores: DataFrame, path: str) -> str:
    """Model scores (``model, rmse, r2, dir_accuracy``) as a small JSON table."""
    scores.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
