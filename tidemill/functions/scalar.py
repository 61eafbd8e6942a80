"""Scalar expressions: numeric coercion, text code sums, price reconstruction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a plain decimal number (optional sign, digits with an
# optional fraction, or a leading-dot fraction, optional exponent).  Hex, digit
# separators, type suffixes and the words nan/inf are rejected.
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def to_numeric(c: Column) -> Column:
    """Text -> double; anything that is not a plain decimal number becomes NULL."""
    s = c.cast("string")
    return F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))


def text_code_sum(c: Column) -> Column:
    """Sum of the Unicode code points of a whole text (NULL stays NULL)."""
    chars = F.split(c, "")
    return F.when(c.isNotNull(), F.aggregate(chars, F.lit(0).cast("bigint"),
                                             lambda acc, ch: acc + F.ascii(ch).cast("bigint")))


def reconstruct_price(base_price: Column, log_return: Column) -> Column:
    """Price implied by a log return: ``P_base * exp(r)``."""
    return base_price * F.exp(log_return)


def sign(c: Column) -> Column:
    return F.signum(c)
