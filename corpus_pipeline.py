"""Corpus pipeline: quality classifier, SimHash near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the stage
before kept, written as Parquet and read again.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import mixing, packing, quality, simhash, substring
from tidemill.llm._common import staged, table
from tidemill.llm.queries import default_tokenizer
from tidemill.session import drop_scratch, scratch_mark


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.simhash_dedup(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; n_chars follows the text."""
    out = substring.dedup_substrings(docs)
    if "n_chars" in docs.columns:
        cut = F.col("substring_spans").isNotNull()
        out = out.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate asks for."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    return packing.pack_documents(docs, default_tokenizer())


STAGES = [
    ("quality_classifier", keep_good_documents),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The classifier, SimHash and the tokenizer are beyond SQL.  Tests hold SimHash to brute force, substring
# dedup to planted passages and the classifier to held-out labels; no test compares the run's rows stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  Once a stage is written, what it and the stages before it
    wrote on the way is deleted, so the disk holds the work of one stage at a time."""
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(spark, since=mark, keep_last=1)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
