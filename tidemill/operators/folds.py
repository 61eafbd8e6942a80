"""Walk-forward (rolling-window) folds expressed as data.

Fold *f* (0-based) tests rows ``[T + P + f*S, T + P + (f+1)*S)`` and trains on
``[f*S, f*S + T)`` (T = train window, S = test window, P = purge gap) for as
long as the test window fits; trailing rows are unused.  Membership is pure
arithmetic on ``row_idx``, so no fold table has to be joined row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.series import _join_on, row_index


@dataclass(frozen=True)
class FoldSpec:
    train: int = 1000
    test: int = 60
    purge: int = 0

    def n_folds(self, n: int) -> int:
        start = self.train + self.purge
        return max(0, (n - start) // self.test) if n >= start + self.test else 0


def _n_folds_expr(n: Column, spec: FoldSpec) -> Column:
    start = spec.train + spec.purge
    return F.when(n >= start + spec.test, F.floor((n - start) / spec.test)).otherwise(F.lit(0)).cast("long")


def with_series_counts(indexed: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    keys = list(keys or [])
    if not keys:
        n = indexed.count()
        return indexed.withColumn("__n", F.lit(n).cast("long"))
    counts = indexed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return _join_on(indexed, counts, keys, "inner")  # one row per series; AQE sizes the join


def fold_membership(df: DataFrame, order_by: Sequence[str], spec: FoldSpec = FoldSpec(),
                    keys: Sequence[str] | None = None, idx_col: str = "row_idx") -> DataFrame:
    """``(keys, row_idx, fold, role)``; a row appears once per fold it belongs to."""
    keys = list(keys or [])
    idx = df if idx_col in df.columns else row_index(df, order_by, keys, idx_col=idx_col)
    idx = with_series_counts(idx.select(*keys, *order_by, idx_col), keys)
    r, nf = F.col(idx_col), _n_folds_expr(F.col("__n"), spec)
    start = spec.train + spec.purge
    test_fold = F.when((r >= start) & (r < start + nf * spec.test), F.floor((r - start) / spec.test))
    lo = F.greatest(F.lit(0), F.ceil((r - spec.train + 1) / spec.test))
    hi = F.least(nf - 1, F.floor(r / spec.test))
    train_folds = F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))).otherwise(F.array().cast("array<long>"))
    tests = F.when(test_fold.isNotNull(), F.array(F.struct(test_fold.cast("long").alias("fold"),
                                                             F.lit("test").alias("role")))) \
        .otherwise(F.array().cast("array<struct<fold:bigint,role:string>>"))
    trains = F.transform(train_folds, lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role")))
    out = idx.select(*keys, *order_by, idx_col, F.explode(F.concat(trains, tests)).alias("m"))
    return out.select(*keys, *order_by, F.col(idx_col).cast("long").alias(idx_col),
                      F.col("m.fold").alias("fold"), F.col("m.role").alias("role"))


def fold_table(df: DataFrame, order_by: Sequence[str], spec: FoldSpec = FoldSpec(),
               keys: Sequence[str] | None = None, idx_col: str = "row_idx") -> DataFrame:
    """One row per (keys, fold, role): index range, size and first/last ``order_by[0]`` value.

    Built from the per-series row count (arithmetic), then the boundary rows are
    looked up with an equi-join -- no per-row explosion.
    """
    keys = list(keys or [])
    idx = df if idx_col in df.columns else row_index(df, order_by, keys, idx_col=idx_col)
    if keys:
        counts = idx.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    else:
        counts = idx.agg(F.count(F.lit(1)).alias("__n"))
    nf = _n_folds_expr(F.col("__n"), spec)
    # sequence(0, -1) would count down, so series without a fold go first
    folds = counts.where(nf > 0).select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), nf - 1)).alias("fold"))
    folds = folds.where(F.col("fold") >= 0)
    f = F.col("fold")
    start = spec.train + spec.purge
    roles = F.array(
        F.struct(F.lit("train").alias("role"), (f * spec.test).alias("lo"), (f * spec.test + spec.train - 1).alias("hi")),
        F.struct(F.lit("test").alias("role"), (f * spec.test + start).alias("lo"),
                 (f * spec.test + start + spec.test - 1).alias("hi")))
    ranges = folds.select(*keys, "fold", F.inline(roles))
    ts = order_by[0]
    lo_rows = idx.select(*keys, F.col(idx_col).alias("lo"), F.col(ts).alias("start_value"))
    hi_rows = idx.select(*keys, F.col(idx_col).alias("hi"), F.col(ts).alias("end_value"))
    out = _join_on(_join_on(ranges, lo_rows, [*keys, "lo"], "left"), hi_rows, [*keys, "hi"], "left")
    return out.select(*keys, "fold", "role", F.col("lo").alias("start_idx"), F.col("hi").alias("end_idx"),
                      (F.col("hi") - F.col("lo") + 1).alias("n_rows"), "start_value", "end_value")


def holdout_split(df: DataFrame, order_by: Sequence[str], spec: FoldSpec = FoldSpec(),
                  keys: Sequence[str] | None = None, idx_col: str = "row_idx") -> DataFrame:
    """Rows of the last fold with ``role`` train/test; raises when no fold fits."""
    keys = list(keys or [])
    idx = df if idx_col in df.columns else row_index(df, order_by, keys, idx_col=idx_col)
    idx = with_series_counts(idx, keys)
    if not keys:
        n = idx.select("__n").first()
        if n is None or spec.n_folds(int(n[0])) == 0:
            raise ValueError(f"too few rows ({0 if n is None else n[0]}) for train window {spec.train} "
                             f"+ purge {spec.purge} + test window {spec.test}")
    nf = _n_folds_expr(F.col("__n"), spec)
    last = nf - 1
    start = spec.train + spec.purge
    r = F.col(idx_col)
    test_lo = last * spec.test + start
    role = (F.when((r >= test_lo) & (r < test_lo + spec.test), F.lit("test"))
            .when((r >= last * spec.test) & (r < last * spec.test + spec.train), F.lit("train")))
    return idx.where(nf > 0).withColumn("role", role).where(F.col("role").isNotNull()).drop("__n")
