"""Mutual information by nearest neighbours, for tables of any size.

For every row the distance r to its k-th neighbour in the (x, y) plane (larger of the two axis
distances, both scaled to unit deviation) is found, then the rows closer than r along x alone
and along y alone are counted:  ``psi(n) + psi(k) - mean(psi(n_x) + psi(n_y))``.

Rows are range-partitioned by (feature, x, y) into shards of bounded size.  A shard gives each of
its rows an upper bound of r; only rows whose square of that size reaches into the box of
another shard are sent there.  The counts along an axis are differences of two ranks among the
axis's distinct values, again in shards, with the weight of the shards before.  Equal rows are
one row with a weight throughout, so no value is too frequent for a shard.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import scratch_path

SHARD_ROWS = 16_384
_CELLS = 1 << 22           # distances held at a time


def digamma(x: Column) -> Column:
    """psi of a positive number, to about 1e-13."""
    z, shift = x + 8, sum((1 / (x + i) for i in range(8)), F.lit(0.0))
    w = 1 / (z * z)
    return (F.ln(z) - 1 / (2 * z) - w * (F.lit(1 / 12) - w * (F.lit(1 / 120) - w * (F.lit(1 / 252) - w * (F.lit(1 / 240) - w * F.lit(1 / 132)))))) - shift


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sharded(rows: DataFrame, key: str, order: Sequence[str], shard_rows: int) -> DataFrame:
    """``rows`` in ranges of ``order`` with the number of their part; a part may hold several keys,
    so a shard is (key, part)."""
    n = rows.count()
    parts = max(1, -(-n // shard_rows))
    return _written(rows.repartitionByRange(parts, key, *order).withColumn("part", F.spark_partition_id()), "mi-shards")


def _nearest(qx: np.ndarray, qy: np.ndarray, x: np.ndarray, y: np.ndarray, m: np.ndarray, own: np.ndarray | None, k: int) -> np.ndarray:
    """The k smallest distances from each query to the weighted points (inf: fewer); ``own``: the
    query's own place among them, which counts one copy less."""
    out = np.full((len(qx), k), np.inf)
    step = max(1, _CELLS // max(1, len(x)))
    take = min(k, len(x))
    for lo in range(0, len(qx), step):
        s = slice(lo, lo + step)
        d = np.maximum(np.abs(qx[s, None] - x), np.abs(qy[s, None] - y))
        w = np.broadcast_to(m, d.shape)
        if own is not None:
            w = w.copy()
            w[np.arange(len(d)), own[s]] -= 1
            d = np.where(w > 0, d, np.inf)
        near = np.argpartition(d, take - 1, axis=1)[:, :take]
        d, w = np.take_along_axis(d, near, 1), np.take_along_axis(w, near, 1)
        by = np.argsort(d, axis=1)
        d, up = np.take_along_axis(d, by, 1), np.cumsum(np.take_along_axis(w, by, 1), axis=1)
        # copies fill more than one place
        at = (up[:, None, :] <= np.arange(k)[:, None]).sum(axis=2)
        out[s] = np.where(at < take, np.take_along_axis(d, np.minimum(at, take - 1), 1), np.inf)
    return out


def _rows(names: Sequence[str], *columns) -> pa.Table:
    return pa.table(dict(zip(names, columns)))


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32)), pa.array(a.ravel()))


def _numpy(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def _kth_distances(points: DataFrame, k: int, shard_rows: int) -> DataFrame:
    """``(f, x, y, m, r)``: r is the distance to the k-th neighbour."""
    shards = _sharded(points, "f", ["x", "y"], shard_rows)
    boxes = shards.groupBy("f", "part").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
                                            F.max("y").alias("y1")).orderBy("f", "part").toArrow()   # a row a shard
    box = {c: boxes.column(c).to_numpy() for c in boxes.column_names}

    def inside(key, t):
        f, part = key[0].as_py(), key[1].as_py()
        x, y, m = _numpy(t, "x", "y", "m")
        d = _nearest(x, y, x, y, m, np.arange(len(x)), k)
        r = d[:, -1]
        others = np.flatnonzero((box["f"] == f) & (box["part"] != part))
        x0, x1, y0, y1 = (box[c][others] for c in ("x0", "x1", "y0", "y1"))
        reach, step = [], max(1, _CELLS // max(1, len(others)))
        for lo in range(0, len(x), step):
            a, b, c = x[lo:lo + step, None], y[lo:lo + step, None], r[lo:lo + step, None]
            hit = (x0 < a + c) & (x1 > a - c) & (y0 < b + c) & (y1 > b - c)
            reach += [box["part"][others[h]] for h in hit]
        sizes = np.cumsum([0, *map(len, reach)])
        targets = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *reach]).astype(np.int32)))
        return _rows(["f", "x", "y", "m", "d", "targets"], pa.array(np.full(len(x), f, np.int32)), x, y, m, _lists(d), targets)

    own = _written(shards.groupBy("f", "part").applyInArrow(inside, "f int, x double, y double, m bigint, d array<double>, targets array<int>"), "mi-own")
    asked = own.select("f", F.explode("targets").alias("part"), "x", "y")

    def elsewhere(key, queries, t):
        qx, qy = _numpy(queries, "x", "y")
        x, y, m = _numpy(t, "x", "y", "m")
        d = _nearest(qx, qy, x, y, m, None, k) if len(x) else np.full((len(qx), k), np.inf)
        return _rows(["f", "x", "y", "d"], pa.array(np.full(len(qx), key[0].as_py(), np.int32)), qx, qy, _lists(d))

    far = (asked.groupBy("f", "part").cogroup(shards.groupBy("f", "part"))
           .applyInArrow(elsewhere, "f int, x double, y double, d array<double>").groupBy("f", "x", "y")
           .agg(F.flatten(F.collect_list("d")).alias("more")))          # k numbers for each shard in reach
    near = F.array_sort(F.concat("d", F.coalesce("more", F.array().cast("array<double>"))))
    return own.join(far, ["f", "x", "y"], "left").select("f", "x", "y", "m", near[k - 1].alias("r"))


def _side(v: np.ndarray, x: np.ndarray, r: np.ndarray, sign: int) -> np.ndarray:
    """How many of the sorted values lie below the interval's end: those with ``v - x < r`` (sign 1),
    or with ``x - v >= r`` (sign -1); at r = 0 the equal value is inside.  Differences are compared,
    not sums, so that the k-th neighbour itself is told apart exactly."""
    def below(at):
        d = v[at] - x
        return np.where(r == 0, d <= 0, d < r) if sign > 0 else np.where(r == 0, d < 0, -d >= r)

    at = np.searchsorted(v, x + sign * r, "left" if sign > 0 else "right")
    for _ in range(3):
        at = at + ((at < len(v)) & below(np.minimum(at, len(v) - 1)))
        at = at - ((at > 0) & ~below(np.maximum(at - 1, 0)))
    return at


def _axis_counts(points: DataFrame, shard_rows: int) -> DataFrame:
    """``(g, m, n)``: for each row with its r the weight of rows closer than r along one axis, itself
    included; g is twice the feature, plus one for the y axis."""
    axes = points.select("m", "r", F.posexplode(F.array("x", "y")).alias("axis", "v"), "f")
    axes = axes.select((F.col("f") * 2 + F.col("axis")).alias("g"), "v", "m", "r")
    values = _sharded(axes.groupBy("g", "v").agg(F.sum("m").alias("w")), "g", ["v"], shard_rows)
    t = values.groupBy("g", "part").agg(F.min("v").alias("first"), F.sum("w").alias("w")).orderBy("g", "first").toArrow()   # a row a shard
    g, part, first, w = _numpy(t, "g", "part", "first", "w")
    start = {int(a): (int(np.searchsorted(g, a)), int(np.searchsorted(g, a, "right"))) for a in np.unique(g)}
    before = np.cumsum(w) - w

    def ends(batches):
        """The shard that each end of an interval falls into; one row for both if they share it."""
        for b in batches:
            gs, v, m, r = (b.column(i).to_numpy() for i in range(4))
            lo, hi = np.empty(len(v), np.int64), np.empty(len(v), np.int64)
            for a in np.unique(gs):
                at, (s, e) = gs == a, start[int(a)]
                hi[at] = s + np.maximum(_side(first[s:e], v[at], r[at], 1) - 1, 0)
                lo[at] = s + np.maximum(_side(first[s:e], v[at], r[at], -1) - 1, 0)
            same = lo == hi
            for rows, shard, low, high in ((same, hi, True, True), (~same, hi, False, True), (~same, lo, True, False)):
                n = int(rows.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gs[rows]), pa.array(part[shard[rows]]), pa.array(v[rows]), pa.array(m[rows]), pa.array(r[rows]),
                     pa.array(np.full(n, low)), pa.array(np.full(n, high))], names=["g", "part", "v", "m", "r", "low", "high"])

    offset = {(int(a), int(p)): int(c - before[start[int(a)][0]]) for a, p, c in zip(g, part, before)}

    def count(key, queries, held):
        x, r, m = _numpy(queries, "v", "r", "m")
        low, high = (queries.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("low", "high"))
        v, w = _numpy(held, "v", "w")
        by = np.argsort(v)
        v, up = v[by], np.r_[0, np.cumsum(w[by])] + offset[key[0].as_py(), key[1].as_py()]
        n = np.where(high, up[_side(v, x, r, 1)], 0) - np.where(low, up[_side(v, x, r, -1)], 0)
        return _rows(["g", "v", "r", "m", "n", "both"], pa.array(np.full(len(x), key[0].as_py(), np.int32)), x, r, m, n, low & high)

    asked = axes.mapInArrow(ends, "g int, part int, v double, m bigint, r double, low boolean, high boolean")
    got = (asked.groupBy("g", "part").cogroup(values.groupBy("g", "part"))
           .applyInArrow(count, "g int, v double, r double, m bigint, n bigint, both boolean"))
    got = _written(got, "mi-counts")
    # intervals over several shards: their two ends meet again; equal ones are one
    split = got.where("not both").groupBy("g", "v", "r").agg((F.sum(F.when(F.col("n") > 0, F.col("m"))).alias("m")),
                                                             F.max("n").alias("up"), F.min("n").alias("down"))
    return got.where("both").select("g", "m", "n").unionByName(
        split.select("g", "m", (F.col("up") + F.col("down")).alias("n")))


def knn_mutual_information(df: DataFrame, features: Sequence[str], target: str, k: int = 3,
                           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(feature, mi)`` in nats, not below 0, by the k-nearest-neighbour estimator.

    Rows with a null, NaN or infinite value in a pair are left out for that feature.  A constant
    column, or k rows or fewer, gives 0.  Equal rows are neighbours at distance 0, and rows count
    themselves along the axes.
    """
    features = list(features)
    spark = df.sparkSession
    if k < 1:
        raise ValueError("k must be at least 1")
    if not features:
        return spark.createDataFrame([], "feature string, mi double")

    def finite(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)

    used = df.select(*[finite(c).alias(f"x{i}") for i, c in enumerate(features)], finite(target).alias("y"))
    both = {i: F.col(f"x{i}").isNotNull() & F.col("y").isNotNull() for i in range(len(features))}
    row = used.agg(*[a for i, ok in both.items() for a in (
        F.count(F.when(ok, 1)).alias(f"n{i}"), F.stddev_pop(F.when(ok, F.col(f"x{i}"))).alias(f"s{i}"),
        F.stddev_pop(F.when(ok, F.col("y"))).alias(f"t{i}"))]).first()
    able = [i for i in both if row[f"n{i}"] > k and row[f"s{i}"] and row[f"t{i}"]]
    names = spark.createDataFrame(list(enumerate(features)), "f int, feature string")
    if not able:
        return names.select("feature", F.lit(0.0).alias("mi"))
    cells = [F.when(both[i], F.struct(F.lit(i).alias("f"), (F.col(f"x{i}") / F.lit(row[f"s{i}"]) + F.lit(0.0)).alias("x"),
                                      (F.col("y") / F.lit(row[f"t{i}"]) + F.lit(0.0)).alias("y"))) for i in able]
    points = (used.select(F.explode(F.array(*cells)).alias("p")).where("p is not null").select("p.*")
              .groupBy("f", "x", "y").agg(F.count(F.lit(1)).alias("m")))
    counts = _axis_counts(_written(_kth_distances(_written(points, "mi-points"), k, shard_rows), "mi-radii"), shard_rows)
    sums = counts.groupBy(F.floor(F.col("g") / 2).cast("int").alias("f")).agg(
        F.sum(F.col("m") * digamma(F.col("n").cast("double"))).alias("s"), (F.sum("m") / 2).alias("n"))
    mi = F.greatest(digamma(F.col("n")) + digamma(F.lit(float(k))) - F.col("s") / F.col("n"), F.lit(0.0))
    return names.join(F.broadcast(sums), "f", "left").select("feature", F.coalesce(mi, F.lit(0.0)).alias("mi"))   # a row a feature
