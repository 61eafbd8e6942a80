"""Correlation family: pairwise-complete Pearson matrix (long form), top correlates,
safe pair correlation, cross-lag correlation.

A whole matrix is one pass.  Rows that lack the same columns are taken together: their centred
Gramian gives the moments of every pair they hold, and the moments (count, means, co-moments
over the rows where *both* values are present) are merged per pair by the parallel update, so
neither a far-off mean nor rows a pair does not use cost it digits.  Zero variance yields NULL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair_corr_expr(a: str, b: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    xa, xb = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    den = F.stddev_pop(xa) * F.stddev_pop(xb)
    return F.try_divide(F.covar_pop(xa, xb), F.when(den != 0, den))


def _entries(cols, upper_only, include_diagonal):
    out = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            out.append((i, j))
            if not upper_only:
                out.append((j, i))
    if include_diagonal:
        out += [(i, i) for i in range(len(cols))]
    return out


def corr_long(df: DataFrame, cols: Sequence[str], include_diagonal: bool = True,
              upper_only: bool = False) -> DataFrame:
    """``(col_a, col_b, i, j, r)`` for every ordered pair (or ``i < j`` with ``upper_only``).

    Pairwise complete, in one pass for any number of columns; NaN counts as missing.  Zero
    variance gives NULL.
    """
    cols = list(cols)
    spark = df.sparkSession
    entries = _entries(cols, upper_only, include_diagonal)
    pairs = spark.createDataFrame([(cols[i], cols[j], i, j, min(i, j), max(i, j)) for i, j in entries],
                                  "col_a string, col_b string, i int, j int, a int, b int")
    if not cols:
        return pairs.select("col_a", "col_b", "i", "j", F.lit(None).cast("double").alias("r"))
    return (pairs.join(_pair_moments(df, cols), ["a", "b"], "left")
            .select("col_a", "col_b", "i", "j", "r"))


class _Moments:
    """Of every pair of columns over the rows that hold both: count, mean and second moment of the
    first one, co-moment.  Entry [i, j] speaks of column i within the pair (i, j)."""

    def __init__(self, c: int):
        self.n, self.mean, self.square, self.co = (np.zeros((c, c)) for _ in range(4))

    def add(self, v: np.ndarray) -> None:
        """Rows in which missing values are NaN."""
        held = ~np.isnan(v)
        patterns, which = np.unique(np.packbits(held, axis=1), axis=0, return_inverse=True)
        which = which.ravel()
        by = np.argsort(which, kind="stable")
        for rows in np.split(by, np.cumsum(np.bincount(which, minlength=len(patterns)))[:-1]):
            at = np.flatnonzero(held[rows[0]])
            if not len(at):
                continue
            block = v[np.ix_(rows, at)]
            off = block - block[0]           # a constant column is exactly zero
            mean = off.mean(axis=0)
            off -= mean
            self.merge(np.ix_(at, at), len(rows), block[0] + mean, off.T @ off)

    def merge(self, at, m: int, mean: np.ndarray, co: np.ndarray) -> None:
        n, total = self.n[at], self.n[at] + m
        d = np.where(n > 0, mean[:, None] - self.mean[at], 0.0)
        f = n * m / total
        self.co[at] += co + d * d.T * f
        self.square[at] += np.diag(co)[:, None] + d * d * f
        self.mean[at] = np.where(n > 0, self.mean[at] + d * (m / total), mean[:, None])
        self.n[at] = total


def _pair_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(a, b, r)`` for ``a <= b`` over the rows that hold both; one row per pair and partition
    is all that moves."""
    c = len(cols)
    x = df.select(*[F.col(n).cast("double").alias(f"x{k}") for k, n in enumerate(cols)])
    up = np.triu_indices(c)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Moments(c)
        for batch in batches:
            if batch.num_rows:
                total.add(np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(c)]).astype(float))
        some = total.n[up] > 0
        a, b = up[0][some], up[1][some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
             *(pa.array(v) for v in (total.n[a, b], total.mean[a, b], total.mean[b, a], total.square[a, b], total.square[b, a], total.co[a, b]))],
            names=["a", "b", "n", "ma", "mb", "saa", "sbb", "sab"])

    parts = x.mapInArrow(moments, "a int, b int, n double, ma double, mb double, saa double, sbb double, sab double")
    # the parts' means about the first of them, then their moments about the common mean
    pair = Window.partitionBy("a", "b")
    parts = parts.withColumns({m: F.col(m) - F.min(m).over(pair) for m in ("ma", "mb")})
    parts = parts.withColumns({f"d{m}": F.col(m) - F.sum(F.col("n") * F.col(m)).over(pair) / F.sum("n").over(pair) for m in ("ma", "mb")})
    s = parts.groupBy("a", "b").agg(F.sum(F.col("saa") + F.col("n") * F.col("dma") * F.col("dma")).alias("saa"),
                                    F.sum(F.col("sbb") + F.col("n") * F.col("dmb") * F.col("dmb")).alias("sbb"),
                                    F.sum(F.col("sab") + F.col("n") * F.col("dma") * F.col("dmb")).alias("sab"))
    den = F.sqrt(F.col("saa")) * F.sqrt(F.col("sbb"))
    r = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.least(F.greatest(F.col("sab") / den, F.lit(-1.0)), F.lit(1.0)))
    return s.select("a", "b", F.when((den > 0) & ~F.isnan(den) & ~F.isnan("sab"), r).alias("r"))


def top_correlates(df: DataFrame, target: str, cols: Sequence[str] | None = None, top_n: int = 15) -> DataFrame:
    """Columns ranked by ``|corr(col, target)|`` (target itself included, r = 1), top ``n``."""
    cols = list(cols) if cols is not None else [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint")]
    one = df.agg(*[pair_corr_expr(c, target).alias(f"__c{k}") for k, c in enumerate(cols)])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__c{k}").alias("r"))
                                          for k, c in enumerate(cols)])))
    return (long.withColumn("abs_r", F.abs("r")).where(F.col("abs_r").isNotNull())
            .orderBy(F.col("abs_r").desc(), F.col("column")).limit(top_n))


def top_matrix(df: DataFrame, target: str, cols: Sequence[str] | None = None, top_n: int = 15) -> DataFrame:
    """``corr_long`` among the ``top_n`` correlates of the target, strongest first."""
    return corr_long(df, [r["column"] for r in top_correlates(df, target, cols, top_n).collect()])


def corr_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """Safe correlation: a missing column or no complete pair gives 0.0."""
    if a not in df.columns or b not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0.0).alias("r"), F.lit(0).cast("bigint").alias("n"))
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.agg(F.coalesce(pair_corr_expr(a, b), F.lit(0.0)).alias("r"),
                  F.count(F.when(both, F.lit(1))).alias("n"))


def cross_lag_corr(df: DataFrame, target: str, assets: Sequence[str], order_by: Sequence[str],
                   max_lag: int = 7, keys: Sequence[str] | None = None, mode: str = "auto") -> DataFrame:
    """``corr(target[t], asset[t-k])`` for k = 1..max_lag as ``(asset, lag, r)``; empty -> 0."""
    from tidemill.operators.series import ordered_columns
    lagged = ordered_columns(
        df, order_by, keys,
        lambda w: {f"__{a}__l{k}": F.lag(F.col(a), k).over(w) for a in assets for k in range(1, max_lag + 1)},
        back=max_lag, fwd=0, mode=mode)
    one = lagged.agg(*[F.coalesce(pair_corr_expr(target, f"__{a}__l{k}"), F.lit(0.0)).alias(f"__{a}__l{k}")
                       for a in assets for k in range(1, max_lag + 1)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("asset"), F.lit(k).alias("lag"),
                                                  F.col(f"__{a}__l{k}").alias("r"))
                                         for a in assets for k in range(1, max_lag + 1)])))
