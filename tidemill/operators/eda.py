"""Exploratory-analysis tables (the data behind each chart; drawing is left to the caller)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.correlation import corr_pair
from tidemill.operators.series import ordered_columns

# Column-name priority used to pick an asset's price column.
PRICE_KEYWORDS = ["Adj Close", "Ajclose", "Close", "Price"]


def resolve_column(columns: Sequence[str], prefixes: Sequence[str]) -> str | None:
    """Pick a column among those starting with one of ``prefixes``: the first whose name
    contains a price keyword (in keyword priority), else the first candidate."""
    words = [k.lower() for k in PRICE_KEYWORDS]
    found = (c for p in prefixes for c in columns if c.startswith(p))
    ranked = [(min((i for i, w in enumerate(words) if w in c.lower()), default=len(words)), place, c) for place, c in enumerate(found)]
    return min(ranked)[2] if ranked else None


def monthly_returns(df: DataFrame, price: str, date: str = "date", keys: Sequence[str] | None = None) -> DataFrame:
    """Last known price per (year, month), then percent change over consecutive present
    months x 100: ``(year, month, last_price, monthly_return)``."""
    keys = list(keys or [])
    last = (df.where(F.col(price).isNotNull())
            .groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month"))
            .agg(F.max_by(F.col(price), F.col(date)).alias("last_price")))
    return ordered_columns(last, ["year", "month"], keys,
                           lambda w: {"monthly_return": (F.try_divide(F.col("last_price"),
                                                                       F.lag("last_price", 1).over(w)) - 1) * 100},
                           back=1, fwd=0, mode="plain" if not keys else "auto")


def seasonal_pivot(monthly: DataFrame, value: str = "monthly_return", keys: Sequence[str] | None = None) -> DataFrame:
    """Year rows x month columns ``m01..m12`` (a fixed, listed pivot; missing -> null)."""
    keys = list(keys or [])
    p = monthly.groupBy(*keys, "year").pivot("month", list(range(1, 13))).agg(F.first(value))
    return p.select(*keys, "year", *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)])


def trend_segments(df: DataFrame, price: str, date: str = "date", window_years: int = 2) -> DataFrame:
    """Peak and trough per multi-year segment: segment *i* starts at the (i*w)-th distinct
    year and covers ``[start, min(start + w, last + 1))``; ties -> earliest date."""
    years = df.select(F.year(date).alias("year")).distinct()
    # the distinct-year table is tiny (one row per calendar year)
    ranked = years.withColumn("k", F.row_number().over(Window.orderBy("year")) - 1) \
        .withColumn("last", F.max("year").over(Window.partitionBy()))
    starts = (ranked.where(F.col("k") % window_years == 0)
              .select((F.col("k") / window_years).cast("int").alias("segment"), F.col("year").alias("y_start"),
                      F.least(F.col("year") + window_years, F.col("last") + 1).alias("y_end")))
    yrs = df.select(date, price, F.year(date).alias("year")).where(F.col(price).isNotNull())
    # a year belongs to every segment whose range covers it (ranges follow the year list)
    seg_years = (starts.select("segment", "y_start", "y_end",
                               F.explode(F.sequence(F.col("y_start"), F.col("y_end") - 1)).alias("year")))
    j = yrs.join(F.broadcast(seg_years), "year")
    day = F.unix_date(F.col(date))
    return j.groupBy("segment", "y_start", "y_end").agg(
        F.max(price).alias("max_price"), F.max_by(F.col(date), F.struct(F.col(price), -day)).alias("max_date"),
        F.min(price).alias("min_price"), F.min_by(F.col(date), F.struct(F.col(price), day)).alias("min_date"))


def candlestick(df: DataFrame, days: int = 60, date: str = "date", open_col: str | None = "open",
                high: str = "high", low: str = "low", close: str = "close") -> DataFrame:
    """Last ``days`` rows with ``up = close >= open``.  Without an open column the open is the
    previous close inside the slice, the first row falling back to its own close."""
    tail = df.orderBy(F.col(date).desc()).limit(days)
    if open_col and open_col in df.columns:
        o = F.col(open_col)
        out = tail.select(date, o.alias("open"), F.col(high).alias("high"), F.col(low).alias("low"),
                          F.col(close).alias("close"))
    else:
        w = Window.orderBy(date)  # bounded: at most ``days`` rows
        out = tail.select(date, F.coalesce(F.lag(close, 1).over(w), F.col(close)).alias("open"),
                          F.col(high).alias("high"), F.col(low).alias("low"), F.col(close).alias("close"))
    return out.withColumn("up", F.col("close") >= F.col("open"))


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """2-D equal-width binning of ``(x, y)`` pairs: ``(bx, by, count)`` -- the bounded form of a
    scatter plot for any number of rows."""
    st = df.agg(F.min(x).alias("xl"), F.max(x).alias("xh"), F.min(y).alias("yl"), F.max(y).alias("yh")).first()
    if st["xl"] is None:
        return df.sparkSession.createDataFrame([], "bx int, by int, count bigint")

    def b(c, lo, hi):
        w = (float(hi) - float(lo)) / bins
        if w == 0:
            return F.lit(0)
        return F.least(F.floor((F.col(c) - F.lit(float(lo))) / F.lit(w)), F.lit(bins - 1)).cast("int")
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(b(x, st["xl"], st["xh"]).alias("bx"), b(y, st["yl"], st["yh"]).alias("by")).agg(
        F.count(F.lit(1)).alias("count"))


def rebased_series(df: DataFrame, target: str, cols: Sequence[str], date: str = "date") -> DataFrame:
    """Min-max rebasing to [0, 1] over rows where the target and all ``cols`` are present
    (constant column -> null, as a 0/0 rebase)."""
    use = [target, *[c for c in cols if c in df.columns]]
    sub = df.select(date, *use).na.drop(subset=use)
    st = sub.agg(*[F.min(c).alias(f"lo_{k}") for k, c in enumerate(use)],
                 *[F.max(c).alias(f"hi_{k}") for k, c in enumerate(use)]).first()
    exprs = []
    for k, c in enumerate(use):
        lo, hi = st[f"lo_{k}"], st[f"hi_{k}"]
        if lo is None or hi == lo:
            exprs.append(F.lit(None).cast("double").alias(c))
        else:
            exprs.append(((F.col(c) - F.lit(float(lo))) / F.lit(float(hi) - float(lo))).alias(c))
    return sub.select(date, *exprs)


def rebased_correlations(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """``(asset, r)``: safe correlation of each asset with the target."""
    parts = [corr_pair(df, target, c).select(F.lit(c).alias("asset"), "r") for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
