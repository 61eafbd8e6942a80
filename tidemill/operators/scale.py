"""Standard / min-max scaling with statistics fitted on a chosen subset (train rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.clean import is_numeric


def fit_scaler(df: DataFrame, cols: Sequence[str] | None = None, method: str = "standard") -> DataFrame:
    """A one-row parameter table: per column ``mean``/``std_pop`` or ``min``/``max``."""
    cols = list(cols) if cols else [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    if method == "standard":
        aggs = [a for c in cols for a in (F.avg(c).alias(f"{c}__a"), F.stddev_pop(c).alias(f"{c}__b"))]
    elif method in ("minmax", "custom"):
        aggs = [a for c in cols for a in (F.min(c).cast("double").alias(f"{c}__a"),
                                          F.max(c).cast("double").alias(f"{c}__b"))]
    else:
        raise ValueError("method must be standard, minmax or custom")
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, params: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    """Scale with fitted parameters (one row, read back as literals).
    Zero spread maps to 0; NULL stays NULL."""
    p = params.first()
    exprs = {}
    for c in cols:
        a, b = p[f"{c}__a"], p[f"{c}__b"]
        if a is None:
            exprs[c] = F.lit(None).cast("double")
            continue
        spread = b if method == "standard" else b - a
        scaled = (F.col(c) - F.lit(float(a))) / F.lit(float(spread)) if spread else F.lit(0.0)
        exprs[c] = F.when(F.col(c).isNotNull(), scaled.cast("double"))
    return df.withColumns(exprs)


def scale(df: DataFrame, method: str = "standard", cols: Sequence[str] | None = None,
          fit_on: DataFrame | None = None) -> DataFrame:
    """Scale numeric ``cols``; statistics from ``fit_on`` (e.g. the train rows) if given."""
    cols = [c for c in (cols or [f.name for f in df.schema.fields if is_numeric(f.dataType)])
            if c in df.columns]
    if not cols:
        return df
    params = fit_scaler(fit_on if fit_on is not None else df, cols, method)
    return apply_scaler(df, params, cols, method)
