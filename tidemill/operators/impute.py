"""Missing-value imputation.  Numeric columns use the requested statistic; other
types use the mode (smallest value on ties); ``ffill``/``interpolate`` are ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.clean import is_numeric
from tidemill.operators.features import forward_fill, interpolate
from tidemill.operators.stats import column_stats, mode_value, text_modes


def _missing_columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    cols = list(cols or df.columns)
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"m{k}") for k, c in enumerate(cols)]).first()
    return [c for k, c in enumerate(cols) if row[f"m{k}"] > 0]


def fill_missing(df: DataFrame, strategy: str = "median", value=None, cols: Sequence[str] | None = None,
                 order_by: Sequence[str] | None = None, keys: Sequence[str] | None = None,
                 limit: int | None = None, mode: str = "auto") -> DataFrame:
    """Fill nulls per column: ``mean`` | ``median`` | ``mode`` | ``custom`` | ``ffill`` | ``interpolate``.

    Whole-column statistics come from one aggregation and are applied with
    ``coalesce``; ``ffill``/``interpolate`` need ``order_by`` (file or time order).
    """
    todo = _missing_columns(df, cols)
    if not todo:
        return df
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if strategy == "custom":
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(types[c])) for c in todo})
    if strategy in ("ffill", "interpolate"):
        if not order_by:
            raise ValueError(f"strategy {strategy!r} needs order_by")
        if strategy == "ffill":
            return forward_fill(df, todo, order_by, keys, mode=mode)
        num = [c for c in todo if is_numeric(types[c])]
        other = [c for c in todo if c not in num]
        # interpolated values are fractional, so numeric columns come back as double (an
        # integer column with gaps becomes a floating column, never truncated)
        # dates run through their day (or microsecond) number; other columns take the mode
        dated = [c for c in other if _number_of(types[c])]
        out = df.withColumns({c: _number_of(types[c])(c) for c in dated})
        if num or dated:
            out = interpolate(out, [*num, *dated], order_by, keys, limit=limit, mode=mode)
        out = out.withColumns({c: _from_number(types[c], F.col(c)) for c in dated})
        return out.withColumns(_mode_fills(df, [c for c in other if c not in dated], types))
    if strategy not in ("mean", "median", "mode"):
        raise ValueError(f"unknown strategy {strategy!r}")
    num = [c for c in todo if is_numeric(types[c])] if strategy != "mode" else []
    # a median date is the median of the day (or microsecond) numbers, whole ones
    dated = [c for c in todo if _number_of(types[c])] if strategy == "median" else []
    fills = {}
    if dated:
        days = df.select(*[_number_of(types[c])(c).alias(c) for c in dated])
        st = column_stats(days, dated, ["median"])
        for c in dated:
            v = st[(c, "median")]
            fills[c] = F.col(c) if v is None else F.coalesce(F.col(c), _from_number(types[c], F.lit(v)))
    if num:
        st = column_stats(df, num, ["mean" if strategy == "mean" else "median"])
        for c in num:
            v = st[(c, "mean" if strategy == "mean" else "median")]
            # a mean/median is fractional: integer columns become double rather than truncate
            target = "double" if not isinstance(types[c], (T.FloatType, T.DecimalType)) else types[c]
            fills[c] = F.coalesce(F.col(c).cast(target), F.lit(v).cast(target))
    fills |= _mode_fills(df, [c for c in todo if c not in fills], types)
    return df.withColumns(fills)


_DAY = 86_400_000_000


def _number_of(t: T.DataType):
    """How a date or time column becomes a number, or None for other types."""
    if isinstance(t, T.DateType):
        return F.unix_date
    if isinstance(t, T.TimestampType):
        return F.unix_micros
    if isinstance(t, T.TimestampNTZType):  # by its own clock, whatever the session's time zone
        return lambda c: (F.unix_date(F.col(c).cast("date")).cast("bigint") * _DAY + F.hour(c) * 3_600_000_000
                          + F.minute(c) * 60_000_000 + (F.extract(F.lit("SECOND"), F.col(c)) * 1_000_000).cast("bigint"))
    return None


def _from_number(t: T.DataType, c):
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(F.floor(c).cast("int"))
    whole = F.floor(c).cast("bigint")
    if isinstance(t, T.TimestampNTZType):
        day = F.floor(whole / _DAY).cast("bigint")
        rest = ((whole - day * _DAY) / 1_000_000).cast("decimal(18,6)")
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"), F.lit(0), F.lit(0), rest)
    return F.timestamp_micros(whole)


def _mode_fills(df: DataFrame, cols: Sequence[str], types: dict) -> dict:
    """Mode fills: text columns from one unpivoted count, other types one by one."""
    texts = [c for c in cols if isinstance(types[c], T.StringType)]
    modes = text_modes(df, texts) | {c: mode_value(df, c) for c in cols if c not in texts}
    return {c: F.coalesce(F.col(c), F.lit(modes[c]).cast(types[c])) for c in cols}
