"""Positional time-series features, all built on ``operators.series``.

Semantics follow the usual data-frame conventions for ordered rows:
``lag``/``lead`` are positional shifts, rolling statistics need ``w`` non-null
values inside the last ``w`` rows, ``pct_change`` first carries the last known
value forward, and interpolation is by row position (not by time).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.series import known_neighbours, ordered_columns, plan_series


def _frame(w, n: int):
    return w.rowsBetween(-(n - 1), 0)


def rolling_mean_expr(c: str, w, n: int) -> Column:
    f = _frame(w, n)
    return F.when(F.count(F.col(c)).over(f) == n, F.avg(F.col(c)).over(f))


def rolling_std_expr(c: str, w, n: int) -> Column:
    f = _frame(w, n)
    return F.when(F.count(F.col(c)).over(f) == n, F.stddev_samp(F.col(c)).over(f))


def lag_features(df: DataFrame, cols: Sequence[str], lags: Sequence[int], order_by: Sequence[str],
                 keys: Sequence[str] | None = None, mode: str = "auto",
                 chunk_rows: int | None = None) -> DataFrame:
    """``{col}_lag{k}`` for every column and lag, in one window operator."""
    def build(w):
        return {f"{c}_lag{k}": F.lag(F.col(c), k).over(w) for c in cols for k in lags}
    return ordered_columns(df, order_by, keys, build, back=max(lags), fwd=0, mode=mode, chunk_rows=chunk_rows)


def rolling_features(df: DataFrame, cols: Sequence[str], windows: Sequence[int], order_by: Sequence[str],
                     keys: Sequence[str] | None = None, stats: Sequence[str] = ("mean", "std"),
                     mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """``{col}_roll_mean_{w}`` / ``{col}_roll_std_{w}`` (sample std), null until ``w`` values."""
    def build(w):
        out = {}
        for c in cols:
            for n in windows:
                if "mean" in stats:
                    out[f"{c}_roll_mean_{n}"] = rolling_mean_expr(c, w, n)
                if "std" in stats:
                    out[f"{c}_roll_std_{n}"] = rolling_std_expr(c, w, n)
        return out
    return ordered_columns(df, order_by, keys, build, back=max(windows) - 1, fwd=0, mode=mode,
                           chunk_rows=chunk_rows)


def log_return(df: DataFrame, price: str, order_by: Sequence[str], keys: Sequence[str] | None = None,
               out: str = "log_return", mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """Keep rows with a positive price, then ``ln(p / p[-1])`` (null on the first row)."""
    pos = df.where(F.col(price) > 0)
    return ordered_columns(pos, order_by, keys,
                           lambda w: {out: F.ln(F.col(price) / F.lag(F.col(price), 1).over(w))},
                           back=1, fwd=0, mode=mode, chunk_rows=chunk_rows)


def next_step_target(df: DataFrame, col: str, order_by: Sequence[str], keys: Sequence[str] | None = None,
                     out: str = "target_next", mode: str = "auto",
                     chunk_rows: int | None = None) -> DataFrame:
    """``lead(col, 1)``; the last row of each series (no next value) is dropped."""
    res = ordered_columns(df, order_by, keys, lambda w: {out: F.lead(F.col(col), 1).over(w)},
                          back=0, fwd=1, mode=mode, chunk_rows=chunk_rows)
    return res.na.drop(subset=[out])


def forward_fill(df: DataFrame, cols: Sequence[str], order_by: Sequence[str], keys: Sequence[str] | None = None,
                 mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """Carry the last known value forward; leading nulls stay null."""
    nb = known_neighbours(df, order_by, keys, cols, mode=mode, chunk_rows=chunk_rows)
    return nb.withColumns({c: F.col(f"__prev_{c}.val") for c in cols}).drop(
        "__pos", *[f"__prev_{c}" for c in cols], *[f"__next_{c}" for c in cols])


def interpolate(df: DataFrame, cols: Sequence[str], order_by: Sequence[str], keys: Sequence[str] | None = None,
                limit: int | None = None, mode: str = "auto", chunk_rows: int | None = None,
                round_half_even: bool = False) -> DataFrame:
    """Linear interpolation by row position.

    ``limit=None``: interior gaps are filled, trailing nulls take the last known
    value, leading nulls stay null.  ``limit=n``: a missing cell is filled when it
    lies within ``n`` rows of a known value on either side; leading cells take the
    first known value and trailing cells the last one (within ``n``).
    """
    nb = known_neighbours(df, order_by, keys, cols, mode=mode, chunk_rows=chunk_rows)
    p = F.col("__pos")
    exprs = {}
    for c in cols:
        p0, v0 = F.col(f"__prev_{c}.pos"), F.col(f"__prev_{c}.val").cast("double")
        p1, v1 = F.col(f"__next_{c}.pos"), F.col(f"__next_{c}.val").cast("double")
        has0, has1 = F.col(f"__prev_{c}").isNotNull(), F.col(f"__next_{c}").isNotNull()
        inner = v0 + (v1 - v0) * (p - p0) / F.when(p1 != p0, p1 - p0)
        inner = F.when(p1 == p0, v0).otherwise(inner)
        if limit is None:
            val = F.when(has0 & has1, inner).when(has0, v0)
        else:
            near0 = (p - p0) <= limit
            near1 = (p1 - p) <= limit
            val = (F.when(has0 & has1 & (near0 | near1), inner)
                   .when(has0 & ~has1 & near0, v0)
                   .when(~has0 & has1 & near1, v1))
        if round_half_even:
            val = F.bround(val, 0)
        exprs[c] = F.when(F.col(c).isNotNull(), F.col(c).cast("double")).otherwise(val)
    return nb.withColumns(exprs).drop("__pos", *[f"__prev_{c}" for c in cols], *[f"__next_{c}" for c in cols])


def pct_change(df: DataFrame, col: str, order_by: Sequence[str], keys: Sequence[str] | None = None,
               out: str = "pct_change", mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """``x / x[-1] - 1`` after carrying the last known value forward ([1,_,2] -> [_,0,1])."""
    mode = plan_series(df, order_by, keys, mode, chunk_rows)
    ff = forward_fill(df.withColumn("__ff", F.col(col)), ["__ff"], order_by, keys, mode=mode, chunk_rows=chunk_rows)
    res = ordered_columns(ff, order_by, keys,
                          lambda w: {out: F.try_divide(F.col("__ff"), F.lag("__ff", 1).over(w)) - 1},
                          back=1, fwd=0, mode=mode, chunk_rows=chunk_rows)
    return res.drop("__ff")


def volatility(df: DataFrame, price: str, order_by: Sequence[str], keys: Sequence[str] | None = None,
               window: int = 30, periods: int = 252, mode: str = "auto",
               chunk_rows: int | None = None) -> DataFrame:
    """Annualised volatility in percent: ``std_w(pct_change) * sqrt(periods) * 100``."""
    mode = plan_series(df, order_by, keys, mode, chunk_rows)
    r = pct_change(df, price, order_by, keys, out="ret", mode=mode, chunk_rows=chunk_rows)
    return ordered_columns(r, order_by, keys,
                           lambda w: {"volatility": rolling_std_expr("ret", w, window) * math.sqrt(periods) * 100},
                           back=window - 1, fwd=0, mode=mode, chunk_rows=chunk_rows)


def moving_averages(df: DataFrame, price: str, order_by: Sequence[str], keys: Sequence[str] | None = None,
                    windows: Sequence[int] = (50, 200), mode: str = "auto",
                    chunk_rows: int | None = None) -> DataFrame:
    return ordered_columns(df, order_by, keys,
                           lambda w: {f"ma{n}": rolling_mean_expr(price, w, n) for n in windows},
                           back=max(windows) - 1, fwd=0, mode=mode, chunk_rows=chunk_rows)


def rolling_corr(df: DataFrame, target: str, others: Sequence[str], order_by: Sequence[str],
                 keys: Sequence[str] | None = None, window: int = 90, mode: str = "auto",
                 chunk_rows: int | None = None) -> DataFrame:
    """Rolling Pearson r over ``window`` rows after dropping rows with any null in the
    used columns; null until ``window`` rows, and null when a variance is zero."""
    clean = df.na.drop(subset=[target, *others])

    def build(w):
        f = _frame(w, window)
        out = {}
        for o in others:
            cov = F.covar_pop(F.col(target), F.col(o)).over(f)
            den = F.stddev_pop(F.col(target)).over(f) * F.stddev_pop(F.col(o)).over(f)
            out[f"corr_{o}"] = F.when(F.count(F.lit(1)).over(f) == window,
                                      F.try_divide(cov, F.when(den != 0, den)))
        return out
    return ordered_columns(clean, order_by, keys, build, back=window - 1, fwd=0, mode=mode, chunk_rows=chunk_rows)


def tail_n(df: DataFrame, n: int, order_by: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """Last ``n`` rows (per key).  Un-keyed: ``orderBy(desc).limit`` = TakeOrdered, bounded by ``n``."""
    if not keys:
        return df.orderBy(*[F.col(c).desc() for c in order_by]).limit(n)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def order_check(df: DataFrame, ts: str, row_order: Sequence[str], keys: Sequence[str] | None = None,
                mode: str = "auto", chunk_rows: int | None = None) -> DataFrame:
    """Count rows whose ``ts`` is smaller than the previous row's in ``row_order`` (file order)."""
    flagged = ordered_columns(df.select(*(keys or []), *dict.fromkeys([ts, *row_order])), row_order, keys,
                              lambda w: {"__back": (F.col(ts) < F.lag(F.col(ts), 1).over(w)).cast("int")},
                              back=1, fwd=0, mode=mode, chunk_rows=chunk_rows)
    grp = flagged.groupBy(*(keys or []))
    return grp.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.coalesce(F.sum("__back"), F.lit(0)).cast("bigint").alias("n_out_of_order"))
