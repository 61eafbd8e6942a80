"""Sampled Shapley values of any row-wise model.

Every row to be explained is exploded into coalitions: for each permutation of the features and
each of its prefixes, the prefix's features keep the row's values and the others take those of
the background rows.  One ``transform`` of the model predicts all of them; the mean over the
background, differenced along each permutation, is the contribution of the feature added.
Along one permutation the differences add up to the row's prediction minus the base exactly,
whatever the sample.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from itertools import permutations as all_orders
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
MAX_BACKGROUND = 1000


def draw_permutations(n: int, count: int | None, seed: int = SEED) -> list[list[int]]:
    """``count`` orders of ``n`` features, every second one the reverse of the one before (which
    cancels much of the sampling error); all of them if there are no more, or with None."""
    if count is None or (n < 13 and factorial(n) <= count):
        if n > 8:
            raise ValueError(f"{n} features have too many orders; give a number of them")
        return [list(p) for p in all_orders(range(n))]
    rng, out = random.Random(seed), []
    for _ in range(-(-count // 2)):
        order = rng.sample(range(n), n)
        out += [order, order[::-1]]
    return out[:count]


def shapley_values(predict: Callable[[DataFrame], DataFrame], rows: DataFrame, background: DataFrame, feature_cols: Sequence[str],
                   id_cols: Sequence[str], n_permutations: int | None = 20, seed: int = SEED,
                   prediction: str = "prediction") -> DataFrame:
    """``(id_cols, feature, value, contribution, base, prediction)``, one row per explained row and feature.

    ``predict`` adds a column ``prediction`` to a frame of features; ``id_cols`` tell the explained
    rows apart.  ``background``: the rows that stand for an absent feature, at most MAX_BACKGROUND;
    rows x permutations x (features + 1) x background rows are predicted.  ``n_permutations=None``
    takes all orders (up to 8 features), which is exact for that background.  Rows to explain with
    a null feature are left out, and so are such background rows; without any there is no result.
    """
    features, ids = list(feature_cols), list(id_cols)
    whole = F.greatest(*[F.col(c).isNull().cast("int") for c in features], F.lit(0)) == 0
    held = background.where(whole).select(*[F.col(c).cast("double") for c in features]).limit(MAX_BACKGROUND + 1).collect()
    if not held:
        raise ValueError("no background row without a null")
    if len(held) > MAX_BACKGROUND:
        raise ValueError(f"more than {MAX_BACKGROUND} background rows; sample them")
    orders = draw_permutations(len(features), n_permutations, seed)
    # where each feature stands in each order, and the background, are literals: no join
    places = _literal([[o.index(k) for k in range(len(features))] for o in orders], str)
    others = _literal(held, lambda v: f"double('{float(v)!r}')")
    own = rows.where(whole).select(*ids, *[F.col(c).cast("double").alias(f"__x{k}") for k, c in enumerate(features)])
    wide = (own.select("*", F.posexplode(places).alias("__order", "__place"))
            .withColumn("__prefix", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
            .withColumn("__other", F.explode(others)))
    filled = wide.select(*ids, "__order", "__prefix", *[f"__x{k}" for k in range(len(features))], *[
        F.when(F.col("__place")[k] < F.col("__prefix"), F.col(f"__x{k}")).otherwise(F.col("__other")[k]).alias(c)
        for k, c in enumerate(features)])
    keys = [*ids, "__order", "__prefix"]
    mean = predict(filled).groupBy(*keys).agg(F.avg(prediction).alias("__v"), *[F.first(f"__x{k}").alias(f"__x{k}") for k in range(len(features))])
    along = Window.partitionBy(*ids, "__order").orderBy("__prefix")
    steps = mean.withColumn("__gain", F.col("__v") - F.lag("__v").over(along))
    added = _literal(orders, str)
    added = F.when(F.col("__prefix") > 0, F.element_at(F.element_at(added, F.col("__order") + 1), F.col("__prefix")))
    ends = steps.groupBy(*ids).agg(F.avg(F.when(F.col("__prefix") == 0, F.col("__v"))).alias("base"),
                                   F.avg(F.when(F.col("__prefix") == len(features), F.col("__v"))).alias("prediction"))
    value = F.element_at(F.array(*[F.col(f"__x{k}") for k in range(len(features))]), F.col("__k") + 1)
    parts = (steps.withColumn("__k", added).where("__prefix > 0").withColumn("__value", value)
             .groupBy(*ids, "__k").agg(F.first("__value").alias("value"), F.avg("__gain").alias("contribution")))
    j = parts.alias("p").join(ends.alias("e"), [F.col(f"p.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ids])
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("__k") + 1)
    return j.select(*[F.col(f"p.{c}").alias(c) for c in ids], name.alias("feature"), "value", "contribution", "base", "prediction")


def _literal(rows: Sequence[Sequence], text: Callable[[object], str]):
    """An array of arrays as one parsed expression."""
    return F.expr("array(" + ", ".join("array(" + ", ".join(map(text, r)) + ")" for r in rows) + ")")


def shapley_summary(values: DataFrame, top_n: int = 15) -> DataFrame:
    """``(feature, mean_abs, mean, n)`` of the ``top_n`` features with the largest mean absolute contribution."""
    return (values.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean"),
                                          F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("mean_abs").desc(), "feature").limit(top_n))
