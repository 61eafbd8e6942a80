"""Table sources and sinks (CSV / JSON / parquet) with NaN normalisation."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map floating NaN to SQL NULL so that every aggregate treats both as missing."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def detect_format(path: str) -> str:
    stem = path.rstrip("/")
    ext = os.path.splitext(stem)[1].lower()
    if ext not in _FORMATS:
        raise ValueError(f"unsupported table format {ext!r} for {path}; use .csv, .json or .parquet")
    return _FORMATS[ext]


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None, header: bool = True,
               multiline: bool = False) -> DataFrame:
    """Read a table by extension.  Unknown formats raise instead of returning nothing.

    CSV without a schema is read as all-string columns (type inference is a separate,
    single aggregation pass, see ``operators.clean.infer_types``).  JSON is read as
    JSON lines (splittable); ``multiline=True`` reads each file as one document.
    """
    fmt = fmt or detect_format(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", header).option("mode", "PERMISSIVE").csv(path)
    elif fmt == "json":
        df = reader.option("multiLine", multiline).json(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unsupported table format {fmt!r}")
    return nan_to_null(df)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV sink with a header row and no index column; distributed write."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON-lines sink, one file per partition (small result tables coalesce to one)."""
    df.write.mode("overwrite").json(path)
    return path


def basic_info(df: DataFrame) -> dict:
    """Row / column counts and column types; missing counts come from ``profile_missing``."""
    return {"rows": df.count(), "columns": len(df.columns), "dtypes": dict(df.dtypes)}


FILE_ORDER = ["__file", "__block", "__row"]


def with_file_order(df: DataFrame) -> DataFrame:
    """Add a deterministic *file order* for "first occurrence wins" operators on raw files.

    ``(__file, __block, __row)`` = index of the file in path order, start offset of the
    split inside the file, and ``monotonically_increasing_id()`` (increasing within a
    split).  Together they order rows as they appear in the files, whatever the scan's
    partition layout; pass ``FILE_ORDER`` as ``order_by`` / ``file_order``.  The file list
    comes from the scan's own metadata (one entry per file); Spark picks the join by its size.  Call it
    directly on a file scan.
    """
    strip = r"^[a-zA-Z][\w+.-]*:(//[^/]*)?"  # scheme and authority are spelled differently by the two APIs
    files = sorted(re.sub(strip, "", f) for f in df.inputFiles())
    index = df.sparkSession.createDataFrame(list(zip(files, range(len(files)))), "__path string, __file long")
    scanned = df.select("*", F.regexp_replace(F.col("_metadata.file_path"), strip, "").alias("__path"),
                        F.col("_metadata.file_block_start").alias("__block"),
                        F.monotonically_increasing_id().alias("__row"))
    return scanned.join(index, "__path").drop("__path")
