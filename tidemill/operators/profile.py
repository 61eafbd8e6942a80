"""Profiling: missing counts, describe (numeric / categorical), value counts,
histogram, kernel density, box statistics, binary-domain test and chart choice."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.clean import is_numeric
from tidemill.operators.stats import quantiles


def profile_missing(df: DataFrame) -> DataFrame:
    """``(column, n_missing)`` for columns with at least one missing value."""
    one = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"m{k}") for k, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{k}").alias("n_missing"))
                     for k, c in enumerate(df.columns)])
    return one.select(F.inline(rows)).where(F.col("n_missing") > 0)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, count, mean, std, min, p25, p50, p75, max)``; quartiles are exact at any size."""
    cols = list(cols) if cols else [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    quarts = quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for k, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{k}"), F.avg(x).alias(f"a{k}"), F.stddev_samp(x).alias(f"s{k}"),
                 F.min(x).alias(f"lo{k}"), F.max(x).alias(f"hi{k}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{k}").alias("count"), F.col(f"a{k}").alias("mean"),
                     F.col(f"s{k}").alias("std"), F.col(f"lo{k}").alias("min"),
                     *[F.lit(quarts[c, q]).cast("double").alias(f"p{round(q * 100)}") for q in (0.25, 0.5, 0.75)],
                     F.col(f"hi{k}").alias("max")) for k, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, count)`` over non-null values, sorted by value."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("value"))


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, count, unique, top, freq)``; ``top`` is the most frequent value,
    smallest on ties.  All columns are unpivoted to ``(column, value)`` and counted in
    one grouped aggregation (map-side combined), never collected."""
    cols = list(cols) if cols else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                           for c in cols])).alias("p")).select("p.*")
    counts = pairs.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.col("value"), F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))).alias("top"),
        F.max("n").alias("freq"))


def _bin_expr(x, lo: float, width: float, bins: int):
    if width == 0:
        return F.lit(0)
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 30, density: bool = True) -> DataFrame:
    """Equal-width bins over ``[min, max]`` (last bin closed): ``(bin, lo, hi, count, density)``.
    Empty bins are present (a ``range(bins)`` table, left-joined).  The one-row range
    statistics come back to the driver as literals."""
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n")).first()
    spark = df.sparkSession
    if mm["n"] == 0:
        return spark.createDataFrame([], "bin int, lo double, hi double, count bigint, density double")
    lo, hi, n = float(mm["lo"]), float(mm["hi"]), int(mm["n"])
    w = (hi - lo) / bins
    counts = (df.where(x.isNotNull()).select(_bin_expr(x, lo, w, bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
    dens = F.try_divide(F.col("count"), F.lit(n * w)) if (density and w) else F.lit(None).cast("double")
    return out.select("bin", "lo", "hi", "count", dens.alias("density"))


_KDE_TERMS, _KDE_REACH = 26, 39


def kde(df: DataFrame, col: str, points: int = 300, prebin: int | None = None) -> DataFrame:
    """Gaussian kernel density at ``points`` grid values over ``[min, max]`` with Scott's
    bandwidth ``n^(-1/5) * std`` (sample std).

    A fast Gauss sum: values are grouped into cells an eighth of the bandwidth wide, one pass sums
    each cell's moments, and a cell adds to every grid point within reach a series in its
    moments.  ``exp(-(z-u)^2/2) = exp(-z^2/2) exp(-u^2/2) sum (zu)^k / k!`` with ``|u| <= 1/16``
    and ``|z| <= 39`` (a kernel beyond is zero in double precision): cut after ``_KDE_TERMS``
    terms the series is off by less than 1e-13 of the cell's own contribution.  With ``prebin``,
    an approximation the caller asks for, the data is first reduced to at most so many
    equal-width bins (kernel mass at bin centres).
    """
    x = F.col(col).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"),
                F.stddev_samp(x).alias("sd")).first()
    spark = df.sparkSession
    if not st["n"] or not st["sd"]:
        return spark.createDataFrame([], "point int, x double, density double")
    lo, hi, n, sd = float(st["lo"]), float(st["hi"]), int(st["n"]), float(st["sd"])
    h = n ** (-0.2) * sd
    step = (hi - lo) / (points - 1)
    vals = df.select(x.alias("v"), F.lit(1).alias("w")).where(F.col("v").isNotNull())
    if prebin:
        bw = (hi - lo) / prebin
        vals = (vals.select((F.lit(lo) + (_bin_expr(F.col("v"), lo, bw, prebin) + 0.5) * F.lit(bw)).alias("v"))
                .groupBy("v").agg(F.count(F.lit(1)).alias("w")))
    width = h / 8
    at = vals.withColumn("cell", F.floor((F.col("v") - F.lit(lo)) / F.lit(width)).cast("bigint"))
    mid = F.lit(lo) + (F.col("cell") + 0.5) * F.lit(width)
    at = at.withColumn("u", (F.col("v") - mid) / F.lit(h)).withColumn("m", F.col("w") * F.exp(-0.5 * F.col("u") * F.col("u")))
    moments = at.groupBy("cell").agg(*[F.sum(F.col("m") * F.pow("u", F.lit(k))).alias(f"m{k}") for k in range(_KDE_TERMS)])
    # highest term first, each over its factorial, for Horner's rule in z
    series = F.array(*[F.col(f"m{k}") / F.lit(float(math.factorial(k))) for k in reversed(range(_KDE_TERMS))])
    reach, place = _KDE_REACH * h / step, (mid - F.lit(lo)) / F.lit(step)
    first = F.greatest(F.ceil(place - F.lit(reach)), F.lit(0)).cast("int")
    last = F.least(F.floor(place + F.lit(reach)), F.lit(points - 1)).cast("int")
    cells = moments.select(series.alias("s"), mid.alias("mid"), first.alias("a"), last.alias("b")).where("a <= b")
    contrib = cells.select("s", "mid", F.explode(F.sequence("a", "b")).alias("point")).withColumn(
        "z", (F.lit(lo) + F.col("point") * F.lit(step) - F.col("mid")) / F.lit(h))
    value = F.aggregate("s", F.lit(0.0), lambda acc, m: acc * F.col("z") + m) * F.exp(-0.5 * F.col("z") * F.col("z"))
    dens = spark.range(points).select(F.col("id").cast("int").alias("point")).join(
        F.broadcast(contrib.groupBy("point").agg(F.sum(value).alias("k"))), "point", "left")    # at most a row a point
    norm = n * h * (2 * math.pi) ** 0.5
    return dens.select("point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"),
                       (F.coalesce("k", F.lit(0.0)) / F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, col: str) -> DataFrame:
    """``(q1, median, q3, lower_whisker, upper_whisker, n_outliers)``; whiskers are the most
    extreme data within 1.5 IQR of the box."""
    x = F.col(col).cast("double")
    q = quantiles(df, [col], [0.25, 0.5, 0.75])
    if q[col, 0.5] is None:
        return df.sparkSession.createDataFrame(
            [], "q1 double, median double, q3 double, lower_whisker double, upper_whisker double, n_outliers bigint")
    q1, med, q3 = (q[col, p] for p in (0.25, 0.5, 0.75))
    lo_f, hi_f = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = (x >= F.lit(lo_f)) & (x <= F.lit(hi_f))
    return df.where(x.isNotNull()).agg(
        F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
        F.min(F.when(inside, x)).alias("lower_whisker"), F.max(F.when(inside, x)).alias("upper_whisker"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))


def binary_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, is_binary)``: all non-null values are 0 or 1 (and at least one value)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.coalesce(F.bool_and(F.when(F.col(c).isNotNull(), F.col(c).cast("string").isin("0", "1"))),
                              F.lit(False)).alias(f"b{k}") for k, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"b{k}").alias("is_binary"))
                                         for k, c in enumerate(cols)])))


def chart_kind(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, kind)``: date -> ``date_counts``; binary -> ``bar``; numeric -> ``hist_box``;
    anything else -> ``bar``."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    b = binary_columns(df, cols)
    kinds = {c: ("date_counts" if isinstance(types[c], (T.DateType, T.TimestampType, T.TimestampNTZType))
                 else "numeric" if is_numeric(types[c]) else "other") for c in cols}
    m = df.sparkSession.createDataFrame(list(kinds.items()), "column string, base string")
    return b.join(F.broadcast(m), "column").select(
        "column", F.when(F.col("base") == "date_counts", "date_counts")
        .when(F.col("is_binary"), "bar").when(F.col("base") == "numeric", "hist_box").otherwise("bar").alias("kind"))
