"""Mixing sources to target weights.

Sizes are summed per source; a source's target is its share of the whole by weight, stopped at
``max_repeat`` times its size, the excess shared again by weight until none is above.  The
repetition rate is target / size: each document is emitted floor(rate) times, plus one copy
drawn by a hash of its id with probability equal to the fraction.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Runs of characters other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """``sizes`` (source, source_size) -> with weight, target, rate.  One row per source.

    Sources in code-point order, null last, take the weights in turn.  A source is capped when
    its cap is at most its fair share of what the sources capped before it leave; sources are
    met by cap / weight, so the capped ones come first and one pass settles all.
    """
    lcm = math.lcm(*weights)
    dec = "decimal(38,0)"
    # one row per source: a few columns of the source list, not of the documents
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (sizes.withColumn("rn", F.row_number().over(order))
         .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                            ((F.col("rn") - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", (F.col("source_size") * max_repeat).cast(dec))
         .withColumn("met", F.col("cap") * (F.lit(lcm) / F.col("weight")).cast("int"))
         .withColumn("total", F.sum("source_size").over(everything).cast(dec))
         .withColumn("all_weight", F.sum("weight").over(everything)))
    before = Window.orderBy("met", "rn").rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(dec))
         .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("capped", F.col("cap") * (F.col("all_weight") - F.col("weight_before"))
                     <= F.col("weight") * (F.col("total") - F.col("cap_before")))
         .withColumn("left", F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap"))
                                                    .otherwise(0)).over(everything))
         .withColumn("open_weight", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("left").cast("double") * F.col("weight") / F.col("open_weight"))
    return (t.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"),
                                                                        F.lit(float(max_repeat)))).otherwise(0.0))
            .select("source", "source_size", "weight", "target", "rate"))


def _draw(doc_id, seed: int):
    """Uniform in [0, 1) from the id alone, so a rerun agrees."""
    word = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 8)
    return F.conv(word, 16, 10).cast("double") / F.lit(4294967296.0)


def mix_plan(df: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeat: int = 3, seed: int = 17,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` with ``mix_size mix_source_size mix_target mix_copies`` beside their columns.

    A null text has size 0, a null source is a source of its own (last in order), rows with
    null or equal ids are drawn alike, repeated rows count each time.  A source of size 0 has
    target 0 and no copies.  An empty table gives an empty result.
    """
    sizes = df.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    targets = staged(source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")),
                                    weights, max_repeat), "mix-targets")
    t = targets.select(F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
                       F.col("target").alias("mix_target"), F.col("rate").alias("mix_rate"))
    whole = F.floor("mix_rate")
    extra = (_draw(df[id_col], seed) < F.col("mix_rate") - whole).cast("long")
    return (df.withColumn("mix_size", word_count(df[text_col]))
            .join(t, df[source_col].eqNullSafe(t["mix_source"]), "left")
            .withColumn("mix_copies", whole + extra)
            .drop("mix_source", "mix_rate"))


def mix_documents(df: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, in the columns of ``df``."""
    plan = mix_plan(df, **options)
    return (plan.withColumn("mix_copy", F.explode(F.expr("array_repeat(0, cast(mix_copies as int))")))
            .select(*[plan[c] for c in df.columns]))
