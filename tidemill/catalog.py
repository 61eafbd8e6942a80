"""Registry of named queries: a Spark DataFrame builder and its DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and reads the benchmark tables (or tables
Spark derives from them).  Floating columns are rounded to 30 significant bits on both
sides so that engines that sum in a different order still agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import make_importable

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
BITS = 30  # significant bits kept in compared floating results


def sig_round(c, bits: int = BITS):
    """Round to ``bits`` significant *bits* with exact power-of-two scaling and
    round-half-away.  Decimal data never sits exactly on a binary midpoint, so two
    engines whose doubles differ in the last ulps agree after rounding."""
    x = c.cast("double")
    a = F.abs(x)
    e0 = F.floor(F.log2(a))
    e = (F.when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1)
         .when(F.pow(F.lit(2.0), e0) > a, e0 - 1).otherwise(e0))
    scale = F.pow(F.lit(2.0), F.lit(bits - 1) - e)
    special = x.isNull() | (a < 1e-200) | F.isnan(x) | (a == float("inf"))
    return F.when(special, x).otherwise(F.round(x * scale, 0) / scale) + F.lit(0.0)


def round_doubles(df: DataFrame, bits: int = BITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(sig_round(F.col(f.name), bits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None, rounding: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        # re-registration (a module reload) replaces the entry

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            make_importable(spark)
            df = fn(spark, sf_dir)
            return round_doubles(df) if rounding else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tidemill.plans import queries_clean, queries_eda, queries_model, queries_series  # noqa: F401
