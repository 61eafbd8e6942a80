"""Shared helpers: table access, tables written in the shared folder, ASCII lower case."""

from __future__ import annotations

import os
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import scratch_path


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package from where the driver found it, if it is there
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), _ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, compression: str | None = None, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it again.

    Cuts the lineage at a table that outlives any executor, and gives joins plain scans on
    both sides, so that adaptive execution can split a skewed key.  The table is one of the
    session's scratch tables: deleted at the program's end, or by ``drop_scratch`` before."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
