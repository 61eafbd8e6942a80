"""Outlier masks (IQR, z-score, isolation forest) and repair (mask -> null -> median)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.clean import is_numeric
from tidemill.operators.impute import fill_missing
from tidemill.operators.stats import column_stats, quantiles


def _numeric(df: DataFrame, cols):
    return list(cols) if cols else [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def iqr_flags(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``{c}_outlier``: outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` (null -> false)."""
    cols = _numeric(df, cols)
    st = column_stats(df, cols, ["q1", "q3"])
    out = {}
    for c in cols:
        q1, q3 = st[(c, "q1")], st[(c, "q3")]
        if q1 is None:
            out[f"{c}_outlier"] = F.lit(False)
            continue
        iqr = q3 - q1
        out[f"{c}_outlier"] = F.coalesce((F.col(c) < q1 - 1.5 * iqr) | (F.col(c) > q3 + 1.5 * iqr), F.lit(False))
    return df.withColumns(out)


def zscore_flags(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """``{c}_outlier``: ``|x - mean| / std_pop > threshold``; zero spread -> no outliers."""
    cols = _numeric(df, cols)
    st = column_stats(df, cols, ["mean", "std_pop"])
    out = {}
    for c in cols:
        mu, sd = st[(c, "mean")], st[(c, "std_pop")]
        if mu is None or not sd:
            out[f"{c}_outlier"] = F.lit(False)
        else:
            out[f"{c}_outlier"] = F.coalesce(F.abs((F.col(c) - F.lit(mu)) / F.lit(sd)) > threshold, F.lit(False))
    return df.withColumns(out)


# ---- isolation forest (trees grown from bounded samples, scored in Arrow batches) ----

def _grow(x: np.ndarray, depth: int, max_depth: int, rng: np.random.Generator):
    if depth >= max_depth or len(x) <= 1 or x.min() == x.max():
        return ("leaf", len(x))
    split = rng.uniform(x.min(), x.max())
    return ("node", split, _grow(x[x < split], depth + 1, max_depth, rng),
            _grow(x[x >= split], depth + 1, max_depth, rng))


def _c(n: float) -> float:
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _path(tree, v: np.ndarray, depth: int = 0) -> np.ndarray:
    if tree[0] == "leaf":
        return np.full(len(v), depth + _c(tree[1]), dtype=float)
    out = np.empty(len(v))
    left = v < tree[1]
    if left.any():
        out[left] = _path(tree[2], v[left], depth + 1)
    if (~left).any():
        out[~left] = _path(tree[3], v[~left], depth + 1)
    return out


def _draw(df: DataFrame, cols: list[str], want: int, seed: int) -> dict[int, np.ndarray]:
    """``want`` values of each column drawn by row, without replacement; all if there are fewer.

    Every row has a number in [0, 1) and the smallest are drawn.  Of a value's ``m`` copies only
    the smallest number is made from the value's hash, as the least of ``m`` uniform ones; given
    it, the others are uniform above it and are made for drawn values only.
    """
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    n = df.agg(*[F.count(v).alias(f"n{k}") for k, v in enumerate(x)]).first()
    # about twice the rows wanted fall below a column's share
    share = [min(1.0, 2.0 * want / max(1, n[f"n{k}"])) for k in range(len(cols))]
    v01 = F.shiftrightunsigned(F.xxhash64(F.lit(seed) + F.col("k"), "v"), 11) * F.lit(2.0 ** -53)
    first = (df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in enumerate(x)])).alias("d"))
             .select("d.*").where("v is not null").groupBy("k", "v").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("u", -F.expm1(F.log1p(-v01) / F.col("m")))
             .where(F.col("u") <= F.array(*map(F.lit, share))[F.col("k")]))
    # a value beyond the ``want`` smallest has no drawn copy
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("u", "v"))).where(F.col("r") <= want)
    rows = first.select("k", "v", "m", "u").toPandas().sort_values(["k", "u", "v"])
    out = {}
    for k, p in rows.groupby("k"):
        u, m, v = p["u"].to_numpy(), p["m"].to_numpy(), p["v"].to_numpy()
        rng = np.random.default_rng([seed, k])
        more = rng.binomial(m - 1, (share[k] - u) / (1.0 - u))
        low = np.repeat(u, more)
        at = np.concatenate([u, low + (share[k] - low) * rng.random(len(low))])
        out[int(k)] = np.concatenate([v, np.repeat(v, more)])[np.argsort(at, kind="stable")[:want]]
    return out


def iforest_flags(df: DataFrame, cols: Sequence[str] | None = None, contamination: float = 0.01,
                  n_trees: int = 100, sample_size: int = 256, seed: int = 42) -> DataFrame:
    """``{c}_outlier`` per column from a one-dimensional isolation forest.

    Trees are grown from the algorithm's own sub-samples: one pass counts the columns, one
    counts each column's distinct values and draws ``n_trees * sample_size`` rows of it, each
    copy of a value for itself (a bounded sample of the whole column, never a prefix), one
    scores all columns in Arrow batches; a column is cut at the exact ``1 - contamination``
    quantile of its scores.
    """
    cols = _numeric(df, cols)
    if not cols:
        return df
    forests = {}
    for k, x in _draw(df, cols, n_trees * sample_size, seed).items():
        rng = np.random.default_rng(seed)
        psi = min(sample_size, len(x))
        depth = int(np.ceil(np.log2(max(psi, 2))))
        forests[k] = [_grow(rng.choice(x, psi, replace=False), 0, depth, rng) for _ in range(n_trees)], _c(psi)
    shared = df.sparkSession.sparkContext.broadcast(forests)  # columns x n_trees trees of bounded depth

    def scorer(k: int):
        @F.pandas_udf(T.DoubleType())
        def score(s: pd.Series) -> pd.Series:
            v = s.astype(float).to_numpy()
            res = np.full(len(v), np.nan)
            ok = ~np.isnan(v)
            if ok.any():
                trees, norm = shared.value[k]
                values, back = np.unique(v[ok], return_inverse=True)
                res[ok] = (2.0 ** (-np.mean([_path(t, values) for t in trees], axis=0) / norm))[back] if norm else 0.5
            return pd.Series(res)
        return score

    scored = df.withColumns({f"__score_{c}": scorer(k)(F.col(c).cast("double")) for k, c in enumerate(cols) if k in forests})
    named = {c: f"__score_{c}" for k, c in enumerate(cols) if k in forests}
    cut = quantiles(scored, list(named.values()), [1 - contamination])
    flags = {f"{c}_outlier": F.coalesce(F.nanvl(F.col(named[c]), F.lit(None).cast("double")) > F.lit(cut[named[c], 1 - contamination]), F.lit(False))
             if c in named else F.lit(False) for c in cols}
    return scored.withColumns(flags).drop(*named.values())


def repair_outliers(df: DataFrame, method: str = "iqr", cols: Sequence[str] | None = None) -> DataFrame:
    """Outliers -> null in numeric columns, then every column with nulls is median-filled
    (non-numeric columns with the mode)."""
    num = _numeric(df, cols)
    if method == "iqr":
        flagged = iqr_flags(df, num)
    elif method == "zscore":
        flagged = zscore_flags(df, num)
    elif method == "isolation_forest":
        flagged = iforest_flags(df, num)
    else:
        raise ValueError("method must be iqr, zscore or isolation_forest")
    masked = flagged.withColumns({c: F.when(~F.col(f"{c}_outlier"), F.col(c)) for c in num}) \
        .drop(*[f"{c}_outlier" for c in num])
    return fill_missing(masked, "median")
