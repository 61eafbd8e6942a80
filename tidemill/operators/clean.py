"""Table cleaning: date repair, sparse rows/columns, duplicates, decimal commas,
type inference and conversion.

Data-dependent *schema* decisions (which columns to drop or convert) need one
small aggregate on the driver -- a row of per-column counters, never row data.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.dates import STRICT_FORMAT, normalize_date, normalize_timestamp, parse_date, time_of_day
from tidemill.functions.scalar import to_numeric
from tidemill.operators.features import interpolate

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


# Fixed value: proleptic Gregorian ordinal of 1970-01-01 (0001-01-01 is day 1).
ORDINAL_OFFSET = 719163


def clean_date(df: DataFrame, column: str, file_order: Sequence[str], fmt: str = STRICT_FORMAT,
               mode: str = "auto", sort: bool = True) -> DataFrame:
    """Parse ``column`` (bad -> null), fill missing dates by linear interpolation of day
    numbers in file order (half-even rounding; leading gaps stay null), keep the first
    row per date in file order (null dates count as one date), sort by date (nulls last)
    unless ``sort`` is off, which saves the global sort where a later step orders anyway.

    Keep-first is an aggregation (``min_by`` of the row on its file position), so a
    date holding a large share of the rows is combined map-side, not in one task.
    """
    others = [c for c in df.columns if c != column]
    # day numbers count from 0001-01-01 (day 1) so half-even rounding sees the same parity
    day = F.unix_date(parse_date(F.col(column), fmt)) + ORDINAL_OFFSET
    parsed = df.withColumn("__day", day.cast("double"))
    filled = interpolate(parsed, ["__day"], file_order, limit=None, mode=mode, round_half_even=True)
    dated = filled.withColumn(column, F.date_from_unix_date((F.col("__day") - ORDINAL_OFFSET).cast("int"))) \
        .drop("__day")
    rank = F.struct(*[F.col(c) for c in file_order])
    first = dated.groupBy(column).agg(F.min_by(F.struct(*[F.col(c) for c in others]), rank).alias("__row"))
    out = first.select(column, "__row.*").select(*df.columns)
    return out.orderBy(F.col(column).asc_nulls_last()) if sort else out


def sparse_column_report(df: DataFrame, ratio: float = 2 / 3) -> DataFrame:
    """``(column, n_valid, n_rows, dropped)``: dropped when valid cells < rows * ratio."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(f"__v{k}")
                                                   for k, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__v{k}").alias("n_valid"))
                     for k, c in enumerate(df.columns)])
    return (one.select(F.col("__n").alias("n_rows"), F.inline(rows))
            .select("column", "n_valid", "n_rows", (F.col("n_valid") < F.col("n_rows") * ratio).alias("dropped")))


def drop_sparse_columns(df: DataFrame, ratio: float = 2 / 3) -> DataFrame:
    dropped = [r["column"] for r in sparse_column_report(df, ratio).where("dropped").select("column").collect()]
    return df.drop(*dropped)


def valid_cells(cols: Sequence[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))


def drop_sparse_rows(df: DataFrame, ratio: float = 2 / 3, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose non-null cells are at least ``len(cols) * ratio``."""
    cols = list(cols or df.columns)
    return df.where(valid_cells(cols) >= F.lit(len(cols) * ratio))


def drop_sparse(df: DataFrame, ratio: float = 2 / 3) -> DataFrame:
    """Columns first, then rows against the remaining column count."""
    return drop_sparse_rows(drop_sparse_columns(df, ratio), ratio)


def duplicate_report(df: DataFrame) -> DataFrame:
    """``n_duplicate_members`` (all rows of duplicate groups) and ``n_removed``."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_duplicate_members"),
                      F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("n_removed"),
                      F.count(F.lit(1)).alias("n_groups"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def decimal_comma_report(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Per string column: non-null cells, cells with a comma, cells that parse after
    ``,`` -> ``.``.  One aggregation."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    aggs = []
    for k, c in enumerate(cols):
        fixed = to_numeric(F.regexp_replace(F.col(c), ",", "."))
        aggs += [F.count(F.col(c)).alias(f"n{k}"), F.count(F.when(F.col(c).contains(","), 1)).alias(f"m{k}"),
                 F.count(fixed).alias(f"p{k}")]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, n_valid long, n_comma long, n_parsed long")
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{k}").alias("n_valid"),
                                                   F.col(f"m{k}").alias("n_comma"), F.col(f"p{k}").alias("n_parsed"))
                                         for k, c in enumerate(cols)])))


def fix_decimal_comma(df: DataFrame, date_col: str | None = "date", min_parsed: float = 1.0) -> DataFrame:
    """Convert text columns holding numbers (decimal comma or point) to double.

    A column converts when at least ``min_parsed`` of its non-null cells parse
    after replacing ``,`` by ``.``; genuine text columns are left untouched.
    """
    rep = decimal_comma_report(df, exclude=[date_col] if date_col else []).collect()
    convert = [r["column"] for r in rep if r["n_valid"] and r["n_parsed"] >= r["n_valid"] * min_parsed]
    return df.withColumns({c: to_numeric(F.regexp_replace(F.col(c), ",", ".")) for c in convert})


# The boolean words and date separators of the inference rules.
BOOL_WORDS = ["true", "false", "0", "1"]
DATE_CHARS = r"[-/:.]"


def _current_kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.BooleanType):
        return "bool"
    return "str"


def infer_types(df: DataFrame, category_ratio: float = 0.05) -> DataFrame:
    """``(column, current, suggested)``: one aggregation for the numeric columns, one unpivoted
    count of (column, value) for the text columns, whose rules run on distinct values.

    numeric -> int when every value is whole, else float; text -> datetime when more
    than 30 % of values contain a date separator and more than 80 % parse; bool when
    every value is one of true/false/0/1; category when distinct / count < 5 %;
    otherwise str.  An all-null text column is reported as str.
    """
    kinds = [(k, f.name, _current_kind(f.dataType)) for k, f in enumerate(df.schema.fields)]
    texts = [(k, c) for k, c, kind in kinds if kind == "str"]
    whole = [F.bool_and(F.when(F.col(c).isNotNull(), F.col(c).cast("double") % 1 == 0)).alias(f"w{k}")
             for k, c, kind in kinds if kind in ("int", "float")]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *whole)
    facts: dict[int, object] = {}
    if texts:
        pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in texts])
        values = (df.select(F.explode(pairs).alias("p")).where("p.v is not null")
                  .groupBy("p.k", "p.v").agg(F.count(F.lit(1)).alias("n")))
        v = F.col("v")
        for r in values.groupBy("k").agg(
                F.sum("n").alias("n"), F.sum(F.when(v.rlike(DATE_CHARS), F.col("n")).otherwise(0)).alias("dated"),
                F.sum(F.when(normalize_date(v).isNotNull(), F.col("n")).otherwise(0)).alias("parsed"),
                F.sum(F.when(F.lower(v).isin(*BOOL_WORDS), F.col("n")).otherwise(0)).alias("bools"),
                F.count(F.lit(1)).alias("distinct")).collect():  # one row per text column
            facts[r["k"]] = r
    rows = []
    for k, name, kind in kinds:
        if kind in ("int", "float"):
            sug = F.when(F.coalesce(F.col(f"w{k}"), F.lit(True)), F.lit("int")).otherwise(F.lit("float"))
        elif kind == "str":
            sug = F.lit(_text_kind(facts.get(k), category_ratio))
        else:
            sug = F.lit(kind)
        rows.append(F.struct(F.lit(name).alias("column"), F.lit(kind).alias("current"), sug.alias("suggested")))
    return one.select(F.inline(F.array(*rows)))


def _text_kind(f, category_ratio: float) -> str:
    if f is None:
        return "str"
    if f["dated"] > f["n"] * 0.3 and f["parsed"] > f["n"] * 0.8:
        return "datetime"
    if f["bools"] == f["n"]:
        return "bool"
    return "category" if f["distinct"] < f["n"] * category_ratio else "str"


def convert_column(c: Column, dtype: str | Callable, errors: str = "raise",
                   return_type: str = "string", fmt: str | None = None, timed: bool = False) -> Column:
    """One column to ``int``/``float``/``str``/``bool``/``datetime``/``category`` (kept as
    string), or through a vectorised user function.  ``errors='coerce'`` turns bad
    values into NULL; ``'raise'`` fails the job on the first bad value.  ``fmt``: the Spark
    pattern of a date column; ``timed``: timestamps instead of dates."""
    if callable(dtype):
        from pyspark.sql.functions import pandas_udf

        @pandas_udf(return_type)
        def user_fn(s):
            return s.map(dtype)
        return user_fn(c)
    coerce = errors == "coerce"
    s = c.cast("string")
    if dtype in ("int", "integer"):
        num = to_numeric(s) if coerce else s.cast("double")
        whole = F.when(num % 1 == 0, num.cast("bigint"))
        return whole if coerce else F.when(num.isNull() | (num % 1 == 0), num.cast("bigint")).otherwise(
            F.raise_error(F.lit("fractional value in int conversion")))
    if dtype == "float":
        return to_numeric(s) if coerce else s.cast("double")
    if dtype in ("str", "category"):
        return s
    if dtype == "bool":
        return F.lower(F.trim(s)).try_cast("boolean") if coerce else F.lower(F.trim(s)).cast("boolean")
    if dtype in ("datetime", "date", "time"):
        d = (normalize_timestamp if timed else normalize_date)(c, fmt)
        return d if coerce else F.when(c.isNull() | d.isNotNull(), d).otherwise(
            F.raise_error(F.lit("unparseable date")))
    raise ValueError(f"unknown dtype {dtype!r}")


def convert_types(df: DataFrame, mapping: Mapping[str, str | Callable] | tuple, errors: str = "raise",
                  formats: Mapping[str, str] | None = None) -> DataFrame:
    """Bulk conversion in one ``select``: ``{col: dtype}`` or ``([cols], dtype)``; a dtype may be
    ``(callable, return_type)`` for a vectorised user function.

    For ``datetime``, typed dates and timestamps stay as they are, and a text column becomes
    timestamps (in UTC, as written without an offset) where any value has a time of day, else
    dates; one pass looks at all such columns.  ``formats`` gives a column's Spark pattern instead.
    A column that does not exist raises."""
    if isinstance(mapping, tuple):
        cols, dtype = mapping
        mapping = {c: dtype for c in cols}
    unknown = [c for c in [*mapping, *(formats or {})] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    formats, types = formats or {}, (T.DateType, T.TimestampType, T.TimestampNTZType)
    dated = {c for c, t in mapping.items() if t in ("datetime", "date", "time") and not isinstance(df.schema[c].dataType, types)}
    free = sorted(dated - set(formats))
    timed = {c for c, f in formats.items() if any(x in re.sub("'[^']*'", "", f) for x in "HhKkmsSaXxVzOZ")}
    if free:
        seen = df.agg(*[F.bool_or(time_of_day(F.col(c)) > 0).alias(f"t{k}") for k, c in enumerate(free)]).first()
        timed |= {c for k, c in enumerate(free) if seen[f"t{k}"]}
    exprs = {}
    for c, t in mapping.items():
        if c in dated:
            exprs[c] = convert_column(F.col(c), t, errors, fmt=formats.get(c), timed=c in timed)
        elif isinstance(df.schema[c].dataType, types) and t in ("datetime", "date", "time"):
            continue
        elif isinstance(t, tuple):  # (callable, declared return type)
            exprs[c] = convert_column(F.col(c), t[0], errors, return_type=t[1])
        else:
            exprs[c] = convert_column(F.col(c), t, errors)
    return df.withColumns(exprs)


def auto_convert(df: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Apply ``infer_types`` where the suggestion differs; returns the change list too."""
    changes = [(r["column"], r["current"], r["suggested"]) for r in infer_types(df).collect()
               if r["current"] != r["suggested"]]
    return convert_types(df, {c: new for c, _, new in changes}, errors="coerce"), changes
