"""Composite reports: the market report and the per-column table report (data only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators import correlation as co
from tidemill.operators import eda
from tidemill.operators import features as fe
from tidemill.operators import profile as pr


def market_report(prices: DataFrame, ohlc: DataFrame | None = None, target: str = "adj_close",
                  assets: Sequence[str] = (), date: str = "date",
                  asset_prefixes: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Trend with moving averages, segments, volatility, seasonal table, asset correlations,
    cross-lag correlations, rolling correlation and candles -- one DataFrame each.

    ``prices`` is one row per day (bounded by the calendar), so it is persisted once
    instead of being re-aggregated by every part."""
    if asset_prefixes:
        # one price column per asset group, picked by name (see ``eda.resolve_column``)
        picked = [eda.resolve_column(prices.columns, p) for p in asset_prefixes.values()]
        assets = [*assets, *[c for c in picked if c and c != target]]
    prices = prices.persist()
    out = {
        "trend": fe.moving_averages(prices.select(date, target), target, [date], mode="single"),
        "segments": eda.trend_segments(prices, target, date),
        "volatility": fe.volatility(prices.select(date, target), target, [date], mode="single"),
        "seasonal": eda.seasonal_pivot(eda.monthly_returns(prices, target, date)),
    }
    assets = [a for a in assets if a in prices.columns]
    if assets:
        out["pair_corr"] = eda.rebased_correlations(prices, target, assets)
        for a in assets:
            out[f"pair:{a}"] = prices.select(date, target, a).na.drop()
        out["rebased"] = eda.rebased_series(prices, target, assets, date)
        out["top_matrix"] = co.top_matrix(prices, target, [target, *assets])
        out["top_correlates"] = co.top_correlates(prices, target, [target, *assets])
        out["cross_lag"] = co.cross_lag_corr(prices, target, assets, [date], mode="single")
        if len(assets) >= 2:
            out["rolling_corr"] = fe.rolling_corr(prices, target, assets[:2], [date], mode="single")
    if ohlc is not None:
        out["candles"] = eda.candlestick(ohlc, 60, date)
    return out


def table_report(df: DataFrame) -> dict[str, DataFrame]:
    """Chart choice for every column plus the data each chart needs."""
    cols = df.columns
    kinds = {r["column"]: r["kind"] for r in pr.chart_kind(df, cols).collect()}
    out: dict[str, DataFrame] = {"chart_kind": pr.chart_kind(df, cols)}
    numeric = [c for c, k in kinds.items() if k == "hist_box"]
    for c, k in kinds.items():
        if k == "hist_box":
            out[f"hist:{c}"] = pr.histogram(df, c)
            out[f"box:{c}"] = pr.box_stats(df, c)
        elif k == "date_counts":
            out[f"dates:{c}"] = pr.value_counts(df, c)
        else:
            out[f"bar:{c}"] = pr.value_counts(df, c)
    if len(numeric) >= 2:
        out["correlation"] = co.corr_long(df, numeric)
    return out


def report_rows(report: dict[str, DataFrame]) -> DataFrame:
    """``(part, row)``: every part's rows in long form, a row as JSON."""
    parts = [df.select(F.lit(name).alias("part"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
             for name, df in report.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_sizes(report: dict[str, DataFrame]) -> DataFrame:
    """``(part, n_rows)`` -- one small count job per part, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("part"), "n_rows")
             for name, df in report.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
