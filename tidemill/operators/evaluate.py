"""Forecast evaluation: error metrics, direction accuracy and confusion, residuals,
price reconstruction from log returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.profile import histogram, kde
from tidemill.operators.series import _join_on, ordered_columns


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """``n, rmse, mae, r2`` (R^2 = 1 - SSE / SST, SST with the population variance)."""
    e = F.col(y) - F.col(p)
    g = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*by)
    sse = F.sum(e * e)
    sst = F.var_pop(F.col(y)) * F.count(F.lit(1))
    return g.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                 (F.lit(1.0) - F.try_divide(sse, F.when(sst != 0, sst))).alias("r2"))


def direction_accuracy(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with ``sign(p) == sign(y)`` among rows where ``y != 0`` (predicted 0 is a miss)."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & (F.signum(y) != 0))
    return d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              F.avg((F.signum(y) == F.signum(p)).cast("double")).alias("dir_accuracy"))


def direction_confusion(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """2 x 2 counts over labels (1, -1): true 0 and predicted 0 fall outside and are ignored."""
    s = df.select(F.signum(y).cast("int").alias("true_sign"), F.signum(p).cast("int").alias("pred_sign"))
    counts = (s.where(F.col("true_sign").isin(1, -1) & F.col("pred_sign").isin(1, -1))
              .groupBy("true_sign", "pred_sign").agg(F.count(F.lit(1)).alias("count")))
    grid = df.sparkSession.createDataFrame([(t, q) for t in (1, -1) for q in (1, -1)], "true_sign int, pred_sign int")
    return grid.join(F.broadcast(counts), ["true_sign", "pred_sign"], "left").select(
        "true_sign", "pred_sign", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def residual_histogram(df: DataFrame, y: str = "y", p: str = "p", bins: int = 40) -> DataFrame:
    return histogram(df.select((F.col(y) - F.col(p)).alias("residual")), "residual", bins, density=True)


def residual_kde(df: DataFrame, y: str = "y", p: str = "p", points: int = 300) -> DataFrame:
    """Kernel density of the forecast residuals: ``(point, x, density)``."""
    return kde(df.select((F.col(y) - F.col(p)).alias("residual")), "residual", points)


def price_reconstruct(preds: DataFrame, prices: DataFrame, date: str = "date", y: str = "y", p: str = "p",
                      price: str = "price", base_lag: int = 0, keys: Sequence[str] | None = None,
                      price_rows: int | None = None) -> DataFrame:
    """Turn log-return forecasts into prices: ``P_base * exp(r)`` with the base price of the
    forecast day (``base_lag=0``) or the day before (``base_lag=1``).  The base price is
    looked up by date (inner join: dates missing from the price table drop out); the
    price table is broadcast only when its size is known to be small."""
    keys = list(keys or [])
    base = prices.select(*keys, date, price)
    if base_lag:
        base = ordered_columns(base, [date], keys, lambda w: {"__b": F.lag(price, base_lag).over(w)},
                               back=base_lag, fwd=0)
    else:
        base = base.withColumn("__b", F.col(price))
    base = base.select(*keys, date, "__b")
    if price_rows is None:
        price_rows = base.count()
    j = _join_on(preds.select(*keys, date, y, p), base, [*keys, date], "inner", price_rows) \
        .where(F.col("__b").isNotNull())
    return j.select(*keys, date, (F.col("__b") * F.exp(y)).alias("actual_price"),
                    (F.col("__b") * F.exp(p)).alias("predicted_price"))
