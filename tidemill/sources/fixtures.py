"""Analysis tables derived from the benchmark parquet tables (see FIXTURES.md).

Every builder is a lazy DataFrame over the given tables, so its work grows with
them.  Money sums are taken in integer cents so any engine gets the same double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.io import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", fmt="parquet")


def cents(c) -> F.Column:
    return F.round(F.col(c) * 100).cast("bigint") if isinstance(c, str) else F.round(c * 100).cast("bigint")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ship day: mean line price (``adj_close``) and quantity (``volume``)."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice", "l_quantity")
    return (li.groupBy(F.to_date("l_shipdate").alias("date"))
            .agg((F.sum(cents("l_extendedprice")) / 100 / F.count(F.lit(1))).alias("adj_close"),
                 F.sum("l_quantity").alias("volume")))


def ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily open/high/low/close of order prices, open/close by order key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return (o.groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).alias("volume")))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean price overall and per return flag (A, N, R) as three asset columns.

    Conditional aggregation in one pass instead of a pivot: the flag set is fixed.
    """
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_extendedprice", "l_returnflag")
    aggs = [(F.sum(cents("l_extendedprice")) / 100 / F.count(F.lit(1))).alias("adj_close")]
    for flag in ("A", "N", "R"):
        hit = F.col("l_returnflag") == flag
        aggs.append(F.try_divide(F.sum(F.when(hit, cents("l_extendedprice"))) / 100,
                                 F.count(F.when(hit, F.lit(1)))).alias(f"{flag.lower()}_price"))
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(*aggs)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user event values; one series per ``user_id`` ordered by ``(ts, event_id)``."""
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")


LONG_ORDER = ["ts", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as one un-keyed series; the order list above is unique."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber", "l_partkey",
                     "l_suppkey", "l_extendedprice", F.col("l_quantity").alias("value"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A noisy raw table derived from orders (bad/missing dates, decimal commas, gaps, copies)."""
    o = table(spark, sf_dir, "orders")
    pos = F.col("o_orderkey")
    dec_txt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    base = o.select(
        pos.alias("pos"),
        F.when(pos % 11 == 0, F.lit(None).cast("string"))
         .when(pos % 13 == 0, F.lit("bad"))
         .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("date_s"),
        F.when(pos % 5 == 0, F.regexp_replace(dec_txt, r"\.", ",")).otherwise(dec_txt).alias("price_s"),
        F.when((pos % 7).isin(0, 1) | (pos % 97 < 25), F.lit(None).cast("double"))
         .otherwise((F.col("o_custkey") % 100).cast("double")).alias("qty"),
        F.when(F.col("o_orderstatus") == "F", F.lit("true")).otherwise(F.lit("false")).alias("flag_s"),
        F.when(pos % 4 == 0, F.col("o_orderpriority")).alias("note"),
    )
    return base.unionByName(base.where(F.col("pos") % 10 == 0))


def categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer market segments with every ninth value missing."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("p_brand"))


def log_returns(prices: DataFrame, price: str = "adj_close", order: str = "date") -> DataFrame:
    """Helper used by several fixtures: keep positive prices, add ``r = ln(p / p[-1])``."""
    from tidemill.operators.series import ordered_columns
    pos = prices.where(F.col(price) > 0)
    # one row per day: a bounded series, so the single-partition window is chosen explicitly
    return ordered_columns(pos, [order], [], lambda w: {"r": F.ln(F.col(price) / F.lag(price, 1).over(w))},
                           back=1, fwd=0, mode="single")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive forecast table: ``y`` next-day log return, ``p`` today's log return (no ML)."""
    from tidemill.operators.series import ordered_columns
    r = log_returns(daily(spark, sf_dir))
    out = ordered_columns(r, ["date"], [], lambda w: {"y": F.lead("r", 1).over(w)}, back=0, fwd=1, mode="single")
    return out.select("date", "y", F.col("r").alias("p"), F.col("adj_close").alias("price")).na.drop(
        subset=["y", "p"])
