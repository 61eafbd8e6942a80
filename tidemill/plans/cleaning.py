"""The cleaning script as one call: dates, sparse parts, copies, decimal commas, gaps, types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemill.operators import clean as cl
from tidemill.operators.impute import fill_missing


def clean_table(df: DataFrame, date_col: str, file_order: Sequence[str], ratio: float = 2 / 3,
                neighbors: int = 10, mode: str = "auto") -> DataFrame:
    """Clean a raw table in the order of the cleaning script:

    1. repair ``date_col`` and keep the first row of every date in ``file_order``,
    2. drop columns, then rows, with too few valid cells (``ratio``),
    3. drop whole-row copies,
    4. turn text columns of decimal-comma numbers into doubles,
    5. interpolate gaps over at most ``neighbors`` rows in date order (text takes its mode;
       a row without a date stays and comes first),
    6. convert every column to its inferred type.

    Raises if the date column itself is too sparse to be kept: the rows would have no order.
    The result is unordered; export or sort it as needed.
    """
    out = cl.clean_date(df, date_col, file_order, mode=mode, sort=False)
    out = cl.drop_duplicates(cl.drop_sparse(out, ratio))
    if date_col not in out.columns:
        raise ValueError(f"date column {date_col!r} has too few valid cells to order the table")
    out = cl.fix_decimal_comma(out, date_col)
    gaps = [c for c in out.columns if c != date_col]
    if gaps:
        out = fill_missing(out, "interpolate", cols=gaps, order_by=[date_col], limit=neighbors, mode=mode)
    return cl.auto_convert(out)[0]
