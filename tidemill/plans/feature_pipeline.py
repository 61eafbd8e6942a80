"""Feature pipeline: load -> log-return target -> lags/rolling -> next-step target -> X, y -> selection.

All lag and rolling columns share one window specification, so the stage is
one window operator (one sort) regardless of how many features are produced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.features import rolling_mean_expr, rolling_std_expr
from tidemill.operators.series import ordered_columns, plan_series
from tidemill.session import scratch_path

INTERNAL_TARGET = "log_return"
NEXT_TARGET = "target_next"


@dataclass(frozen=True)
class FeatureConfig:
    target_col: str = "adj_close"
    date_col: str = "date"
    keys: tuple[str, ...] = ()
    lags: tuple[int, ...] = (1, 2, 3, 5, 21)
    rolling_windows: tuple[int, ...] = (5, 20)
    max_key_columns: int = 10
    corr_threshold: float = 0.98
    max_features: int = 30
    mi_method: str = "bins"            # or "neighbours"
    selection: bool = True
    mode: str = "auto"
    chunk_rows: int | None = None
    tie_breakers: tuple[str, ...] = field(default_factory=tuple)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# A daily series holds one row per calendar day (about 365 x years rows at any data
# scale), so one partition is an explicit, bounded choice that skips the planning scan.
DAILY = FeatureConfig(mode="single")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def find_date_column(df: DataFrame) -> str | None:
    """Case-insensitive lookup of a column called ``date``."""
    for c in df.columns:
        if c.lower() == "date":
            return c
    return None


def load_series(df: DataFrame, target_col: str) -> DataFrame:
    """Parse the ``date`` column (any case), drop rows with any null."""
    dc = find_date_column(df)
    if dc is not None and isinstance(df.schema[dc].dataType, T.StringType):
        stamp = F.try_to_timestamp(F.col(dc))
        # a text column becomes dates only where no value has a time of day
        intraday = not df.where(stamp != F.date_trunc("day", stamp)).isEmpty()
        df = df.withColumn(dc, stamp if intraday else stamp.cast("date"))
    return df.na.drop("any")


def raw_prices(df: DataFrame, target_col: str) -> DataFrame:
    """``(date, price)`` snapshot taken before the positive-price filter."""
    dc = find_date_column(df)
    return df.select(F.col(dc).alias("date"), F.col(target_col).alias("price"))


def build_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Returns the pre-selection table: keys, date, features (float32) and ``target_next``."""
    order = [cfg.date_col, *cfg.tie_breakers]
    keys = list(cfg.keys)
    base = load_series(df, cfg.target_col).where(F.col(cfg.target_col) > 0)
    plan = plan_series(base, order, keys, cfg.mode, cfg.chunk_rows)  # decided once for all stages
    # 1) internal target (log return) -- one window pass
    with_ret = ordered_columns(
        base, order, keys,
        lambda w: {INTERNAL_TARGET: F.ln(F.col(cfg.target_col) / F.lag(cfg.target_col, 1).over(w))},
        back=1, fwd=0, mode=plan).na.drop("any")
    # 2) lags of the first numeric columns + target, rolling moments of the target -- one window pass
    key_cols = numeric_columns(with_ret, exclude=[*keys, *cfg.tie_breakers, INTERNAL_TARGET])[: cfg.max_key_columns]
    key_cols.append(INTERNAL_TARGET)

    def build(w):
        out = {}
        for c in key_cols:
            for k in cfg.lags:
                out[f"{c}_lag{k}"] = F.lag(F.col(c), k).over(w)
            if c == INTERNAL_TARGET:
                for n in cfg.rolling_windows:
                    out[f"{c}_roll_mean_{n}"] = rolling_mean_expr(c, w, n)
                    out[f"{c}_roll_std_{n}"] = rolling_std_expr(c, w, n)
        return out
    reach = max(max(cfg.lags), max(cfg.rolling_windows) - 1)
    feats = ordered_columns(with_ret, order, keys, build, back=reach, fwd=0, mode=plan).na.drop("any")
    # 3) next-step target -- one window pass, last row per series dropped
    tgt = ordered_columns(feats, order, keys, lambda w: {NEXT_TARGET: F.lead(INTERNAL_TARGET, 1).over(w)},
                          back=0, fwd=1, mode=plan).na.drop(subset=[NEXT_TARGET])
    drop = {NEXT_TARGET, INTERNAL_TARGET, cfg.target_col}
    xcols = [c for c in numeric_columns(tgt, exclude=[*keys, *cfg.tie_breakers]) if c not in drop]
    return tgt.select(*keys, *order, *[F.col(c).cast("float").alias(c) for c in xcols],
                      F.col(NEXT_TARGET).alias("y"))


def feature_columns(matrix: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> list[str]:
    skip = {*cfg.keys, cfg.date_col, *cfg.tie_breakers, "y"}
    return [c for c in matrix.columns if c not in skip]


def sanitized(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]+", "", name)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Strip characters outside ``[A-Za-z0-9_]`` from names; refuse collisions."""
    mapping = {c: sanitized(c) for c in df.columns}
    seen: dict[str, str] = {}
    for old, new in mapping.items():
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both sanitise to {new!r}")
        seen[new] = old
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o != n})


def run_pipeline(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), fit_rows: DataFrame | None = None):
    """Full pipeline.  Returns ``(matrix, selected_feature_names)``.

    Selection statistics are computed on ``fit_rows`` when given (e.g. the train
    part of a fold) and on the whole matrix otherwise.
    """
    from tidemill.operators.select import correlation_filter, top_mutual_information
    matrix = build_features(df, cfg)
    feats = feature_columns(matrix, cfg)
    if cfg.selection:
        # selection reads the matrix several times and the result once more: written, it is built once
        path = scratch_path(df.sparkSession, "features")
        matrix.write.parquet(path)
        matrix = df.sparkSession.read.schema(matrix.schema).parquet(path)
        fit = fit_rows if fit_rows is not None else matrix
        dropped = {r["feature"] for r in correlation_filter(fit, feats, cfg.corr_threshold)
                   .where("dropped").select("feature").collect()}
        feats = [c for c in feats if c not in dropped]
        if len(feats) > cfg.max_features:
            top = top_mutual_information(fit, feats, "y", k=cfg.max_features, method=cfg.mi_method)
            keep = {r["feature"] for r in top.collect()}
            feats = [c for c in feats if c in keep]
    out = matrix.select(*cfg.keys, cfg.date_col, *cfg.tie_breakers, *feats, "y")
    return sanitize_names(out), [sanitized(c) for c in feats]
