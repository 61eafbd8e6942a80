"""Feature selection: correlation filter and mutual information."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.correlation import corr_long
from tidemill.operators.neighbour_mi import knn_mutual_information
from tidemill.operators.stats import part_edges


def correlation_filter(df: DataFrame, cols: Sequence[str], threshold: float = 0.98) -> DataFrame:
    """``(feature, position, dropped)``: a column is dropped when ``|r|`` exceeds the threshold
    against *any* earlier column -- also one that is itself dropped (not greedy)."""
    cols = list(cols)
    long = corr_long(df, cols, include_diagonal=False, upper_only=True)
    hits = (long.where(F.abs("r") > threshold).groupBy(F.col("col_b").alias("feature"))
            .agg(F.lit(True).alias("dropped")))
    names = df.sparkSession.createDataFrame([(c, k) for k, c in enumerate(cols)], "feature string, position int")
    return (names.join(F.broadcast(hits), "feature", "left")
            .select("feature", "position", F.coalesce("dropped", F.lit(False)).alias("dropped")))


def _bin(x, edges: Sequence[float]):
    """Number of edges at or below the value."""
    return sum(((x >= F.lit(e)).cast("int") for e in edges), F.lit(0))


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Binned mutual information ``sum p(x,y) ln(p(x,y) / (p(x) p(y)))`` per feature (nats).

    Quantile bins: each column is cut at exact order statistics, so heavy tails do not empty
    the bins; equal values share one.  Rows with a null in the pair are ignored for that
    feature.  Map-side partial aggregation reduces the exploded ``(feature, bx, by)`` triples
    to ``features x bins^2`` rows before the shuffle.  The input is computed once and held for the
    passes over it; the result, one row a feature, is computed at once.
    """
    features = list(features)
    held = df.select(*dict.fromkeys([*features, target])).persist()
    try:
        rows = _binned_information(held, features, target, bins).collect() if features else []   # a row a feature
    finally:
        held.unpersist()
    return df.sparkSession.createDataFrame(rows, "feature string, mi double")


def _binned_information(df: DataFrame, features: list[str], target: str, bins: int) -> DataFrame:
    edges = part_edges(df, [*features, target], bins)
    by = _bin(F.col(target), edges[target])
    cells = [F.when(F.col(c).isNotNull() & F.col(target).isNotNull(),
                    F.struct(F.lit(c).alias("feature"), _bin(F.col(c), edges[c]).alias("bx"), by.alias("by")))
             for c in features]
    trip = df.select(F.explode(F.filter(F.array(*cells), lambda s: s.isNotNull())).alias("t")).select("t.*")
    joint = trip.groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("nxy"))
    wf = Window.partitionBy("feature")
    prob = (joint.withColumn("n", F.sum("nxy").over(wf))
            .withColumn("nx", F.sum("nxy").over(wf.partitionBy("feature", "bx")))
            .withColumn("ny", F.sum("nxy").over(wf.partitionBy("feature", "by"))))
    nxy, n = F.col("nxy").cast("double"), F.col("n").cast("double")
    term = (nxy / n) * F.ln(nxy * n / (F.col("nx").cast("double") * F.col("ny").cast("double")))
    return prob.groupBy("feature").agg(F.sum(term).alias("mi"))


def top_mutual_information(df: DataFrame, features: Sequence[str], target: str, k: int = 30,
                           bins: int = 10, method: str = "bins", neighbours: int = 3) -> DataFrame:
    """Top ``k`` features by mutual information (ties by name) -- a bounded top-k.  ``method``: quantile
    ``bins``, or the nearest-``neighbours`` estimator."""
    if method not in ("bins", "neighbours"):
        raise ValueError(f"method must be bins or neighbours, not {method!r}")
    mi = (mutual_information(df, features, target, bins) if method == "bins"
          else knn_mutual_information(df, features, target, neighbours))
    return mi.orderBy(F.col("mi").desc(), F.col("feature")).limit(k)
