"""Categorical encoders and the text code-sum encoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalar import text_code_sum
from tidemill.operators.series import BROADCAST_MAX_ROWS
from tidemill.session import scratch_path

MAX_ONEHOT_CATEGORIES = 1000


RANK_PARTITION_ROWS = 1_000_000


def value_codes(df: DataFrame, col: str, out: str) -> tuple[DataFrame, int]:
    """``(value, code)`` with codes ``0..k-1`` in ascending value order, and ``k``.

    Up to the broadcast limit the distinct values are ranked in one window.  Above
    it the ranking is distributed: values are range-partitioned, checkpointed into
    the shared checkpoint folder (so partition contents are stable on recompute),
    counted per partition, and each partition adds the prefix sum of the counts
    before it to a local ``row_number``.
    """
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    n = values.count()
    if n <= BROADCAST_MAX_ROWS:
        return values.withColumn(out, (F.row_number().over(Window.orderBy(col)) - 1).cast("bigint")), n
    parts = -(-n // RANK_PARTITION_ROWS)
    ranged = values.repartitionByRange(parts, col).checkpoint()
    tagged = ranged.withColumn("__p", F.spark_partition_id())
    counts = tagged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select("__p", F.coalesce(F.sum("__n").over(
        Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    codes = tagged.join(F.broadcast(offs), "__p").withColumn(
        out, (F.col("__off") + F.row_number().over(Window.partitionBy("__p").orderBy(col)) - 1).cast("bigint"))
    return codes.select(col, out), n


BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class CodeTable:
    """A fitted encoder: the values of a training column and their codes ``0..size-1`` in ascending
    order.  It applies to any table with a column of that name, is saved and loaded."""
    col: str
    codes: DataFrame     # (value, code)
    size: int
    value_bytes: int

    def encode(self, df: DataFrame, out: str | None = None, unseen: str = "null") -> DataFrame:
        """``df`` with the code of ``col``; NULL stays NULL.  A value the training column did not have
        gets NULL, the code ``size`` (``unseen='last'``) or fails the job (``'raise'``)."""
        if unseen not in ("null", "last", "raise"):
            raise ValueError(f"unseen must be null, last or raise, not {unseen!r}")
        out = out or f"{self.col}_code"
        side = self.codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        if self.value_bytes + 16 * self.size <= BROADCAST_BYTES:
            side = F.broadcast(side)   # its bytes were counted
        j = df.join(side, df[self.col] == side["__value"], "left")
        code = F.col("__code")
        if unseen != "null":
            other = F.lit(self.size) if unseen == "last" else F.raise_error(F.lit(f"a value of {self.col} is not in the code table"))
            code = F.when(df[self.col].isNull() | code.isNotNull(), code).otherwise(other.cast("bigint"))
        return j.withColumn("__code", code).select(*[df[c] for c in df.columns if c != out], F.col("__code").alias(out))

    def vectors(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """``df`` with a sparse 0/1 vector of length ``size`` in place of one column per category, for any
        number of categories; all zeros for NULL and unseen values."""
        from pyspark.ml.feature import OneHotEncoder
        spark, out = df.sparkSession, out or f"{self.col}_vec"
        # the last category is dropped: it stands for NULL and unseen values
        last = spark.createDataFrame([(float(self.size),)], "__at double")
        model = OneHotEncoder(inputCols=["__at"], outputCols=[out], dropLast=True).fit(last)
        coded = self.encode(df, "__at")
        return model.transform(coded.withColumn("__at", F.coalesce(F.col("__at"), F.lit(self.size)).cast("double"))).drop("__at")

    def save(self, path: str) -> str:
        self.codes.write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark, col: str, path: str) -> CodeTable:
        return _table(col, spark.read.parquet(path))


def _table(col: str, codes: DataFrame) -> CodeTable:
    row = codes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("value").cast("string"))).alias("b")).first()
    return CodeTable(col, codes, row["n"], row["b"] or 0)


def fit_codes(df: DataFrame, col: str) -> CodeTable:
    """Fit a code table on ``df`` and write it to the shared folder."""
    codes, _ = value_codes(df, col, "__code")
    path = scratch_path(df.sparkSession, "codes")
    codes.select(F.col(col).alias("value"), F.col("__code").alias("code")).write.parquet(path)
    return _table(col, df.sparkSession.read.parquet(path))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Codes ``0..k-1`` in ascending value order; NULL stays NULL.  The code table is
    broadcast only when its bytes are within the limit."""
    return fit_codes(df, col).encode(df, out)


def onehot_encode(df: DataFrame, col: str, max_categories: int = MAX_ONEHOT_CATEGORIES) -> DataFrame:
    """Replace ``col`` by ``{col}_{value}`` 0/1 double columns, categories sorted.
    NULL rows are all zeros.  Cardinality is checked before any column is built; for more
    categories than columns can hold use ``fit_codes(df, col).vectors(df)``."""
    cats = df.select(col).where(F.col(col).isNotNull()).distinct()
    n = cats.count()
    if n > max_categories:
        raise ValueError(f"{col} has {n} categories (> {max_categories}); use fit_codes(df, col).vectors(df)")
    values = sorted(r[0] for r in cats.collect())
    new = {f"{col}_{v}": F.when(F.col(col) == F.lit(v), 1.0).otherwise(0.0) for v in values}
    return df.withColumns(new).drop(col)


def text_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Replace text by the sum of its code points (whole text)."""
    return df.withColumn(out or col, text_code_sum(F.col(col)))
