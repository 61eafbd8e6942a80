"""Column statistics shared by imputation, outliers, scaling and profiling."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import scratch_path


POINTS, KEEP = 1024, 4096   # a summary of more than KEEP values is cut down to POINTS
CHUNK = 1 << 16             # values of a column that a task holds before it summarises them
SHARDS = 32                 # tasks' summaries are merged in so many groups, then together
MARGIN = 3.0 / POINTS       # share of the values by which a summary's rank may be off, each side
COLLECT_ROWS = 400_000      # bracketed values that the driver picks from; more are ranked by Spark


def _summary(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and weights; of more than KEEP, the middles of POINTS runs of equal weight."""
    by = np.argsort(x, kind="stable")
    x, w = x[by], w[by]
    if len(x) <= KEEP:
        return x, w
    up = np.cumsum(w)
    at = np.searchsorted(up, (np.arange(POINTS) + 0.5) * (up[-1] / POINTS))
    return x[np.minimum(at, len(x) - 1)], np.full(POINTS, up[-1] / POINTS)


class _Sketch:
    """Summary of a stream of values, in bounded memory."""

    def __init__(self):
        self.n = self.low = self.high = 0      # finite values, and the infinities beside them
        self.least, self.most = np.inf, -np.inf
        self.raw, self.held = [], 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray) -> None:
        x = x[~np.isnan(x)]
        finite = np.isfinite(x)
        self.low += int((x == -np.inf).sum())
        self.high += int((x == np.inf).sum())
        x = x[finite]
        if len(x):
            self.n += len(x)
            self.least, self.most = min(self.least, x.min()), max(self.most, x.max())
            self.raw.append(x)
            self.held += len(x)
        if self.held >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if self.held:
            x = np.concatenate(self.raw)
            self.parts.append(_summary(x, np.ones(len(x))))
            self.raw, self.held = [], 0
        if sum(len(x) for x, _ in self.parts) > CHUNK:
            self.parts = [_merged(self.parts)]

    def row(self, k: int, shard: int) -> dict:
        self.flush()
        x, w = _merged(self.parts)
        return {"k": k, "shard": shard, "n": self.n, "low": self.low, "high": self.high, "least": float(self.least),
                "most": float(self.most), "x": x, "w": w}


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summary(*(np.concatenate([p[i] for p in parts] or [np.empty(0)]) for i in (0, 1)))


_SKETCH_DDL = "k int, shard int, n bigint, low bigint, high bigint, least double, most double, x array<double>, w array<double>"
_SKETCH = pa.schema([("k", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
                     ("least", pa.float64()), ("most", pa.float64()), ("x", pa.list_(pa.float64())), ("w", pa.list_(pa.float64()))])


def _merge_rows(t: pa.Table) -> pa.Table:
    """One row from the sketches of one column."""
    g = {c: t.column(c).to_pylist() for c in ("k", "shard", "n", "low", "high", "least", "most")}
    x, w = _merged([(np.array(a.values), np.array(b.values)) for a, b in zip(t.column("x"), t.column("w"))])
    return pa.Table.from_pylist([{"k": g["k"][0], "shard": g["shard"][0], "n": sum(g["n"]), "low": sum(g["low"]), "high": sum(g["high"]),
                                  "least": min(g["least"]), "most": max(g["most"]), "x": x, "w": w}], schema=_SKETCH)


def _sketches(values: DataFrame) -> dict[int, dict]:
    """A summary of every column (by position), in one pass."""
    width = len(values.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [_Sketch() for _ in range(width)]
        for b in batches:
            for k, s in enumerate(made):
                s.add(b.column(k).to_numpy(zero_copy_only=False))
        shard = TaskContext.get().partitionId() % SHARDS
        yield pa.RecordBatch.from_pylist([s.row(k, shard) for k, s in enumerate(made) if s.n or s.low or s.high], schema=_SKETCH)

    parts = values.mapInArrow(run, _SKETCH_DDL).groupBy("k", "shard").applyInArrow(_merge_rows, _SKETCH_DDL)
    whole = parts.groupBy("k").applyInArrow(_merge_rows, _SKETCH_DDL).toArrow()    # a row a column
    return {k: {c: whole.column(c)[i].as_py() for c in ("n", "low", "high", "least", "most")}
            | {c: np.array(whole.column(c)[i].values) for c in ("x", "w")}
            for i, k in enumerate(whole.column("k").to_pylist())}


def _bracket(s: dict, rank: int, margin: float) -> tuple[float, float]:
    """Values that should hold the rank between them."""
    up = np.cumsum(s["w"])
    lo, hi = np.searchsorted(up, [rank - margin * s["n"], rank + 1 + margin * s["n"]])
    return (s["least"] if lo == 0 else float(s["x"][lo - 1])), (s["most"] if hi >= len(up) else float(s["x"][hi]))


def _ranked(df: DataFrame, cols: Sequence[str], wanted: Callable[[int], set[int]]) -> tuple[dict[int, dict], dict[tuple[int, int], float]]:
    """Each column's summary, and its values at the 0-based ranks ``wanted(count)``; nulls and NaN
    left out, infinities at the ends.

    One pass summarises every column; a second counts what lies below each rank's bracket and
    brings the values inside.  The summaries only place the brackets: a rank that lies outside
    its bracket after all, as the counts show, is looked for again in a wider one.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    sketches = _sketches(values)
    done: dict[tuple[int, int], float] = {}
    todo: dict[int, set[int]] = {}
    for k, s in sketches.items():
        whole = len(s["x"]) == s["n"]       # nothing was cut
        for r in wanted(s["low"] + s["n"] + s["high"]):
            at = r - s["low"]
            if at < 0 or at >= s["n"]:
                done[k, r] = -math.inf if at < 0 else math.inf
            elif whole:
                done[k, r] = float(s["x"][at])
            else:
                todo.setdefault(k, set()).add(r)
    margin = MARGIN
    while todo:
        spans = []
        for k, rs in todo.items():
            s = sketches[k]
            for lo, hi in sorted(_bracket(s, r - s["low"], margin) for r in rs):
                if spans and spans[-1][0] == k and lo <= spans[-1][2]:
                    spans[-1] = (k, spans[-1][1], max(hi, spans[-1][2]))
                else:
                    spans.append((k, lo, hi))
        places: dict[int, list[tuple[int, int]]] = {}      # span -> (rank, rank in the span)
        below, inside, pick = _inside(values, spans, sum(2 * margin * sketches[k]["n"] * len(rs) for k, rs in todo.items()))
        left: dict[int, set[int]] = {}
        for k, rs in todo.items():
            for r in rs:
                at = r - sketches[k]["low"]
                j = next((j for j, (c, _, _) in enumerate(spans) if c == k and below[j] <= at < below[j] + inside[j]), None)
                if j is None:
                    left.setdefault(k, set()).add(r)
                else:
                    places.setdefault(j, []).append((r, at - below[j]))
        for j, got in pick({j: sorted({p for _, p in rs}) for j, rs in places.items()}).items():
            done |= {(spans[j][0], r): got[p] for r, p in places[j]}
        if left and margin >= 1:
            raise RuntimeError("the rows changed between two passes")
        todo, margin = left, 1.0 if margin > 0.1 else max(margin, 1e-3) * 8
    return sketches, done


def _inside(values: DataFrame, spans: list[tuple[int, float, float]], about: float):
    """Per span the number of finite values below and inside it, and a function that picks the values
    at places inside spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.zeros(len(spans), dtype=np.int64)
        for b in batches:
            js, xs, ns = [], [], []
            col = {k: b.column(k).to_numpy(zero_copy_only=False) for k in {k for k, _, _ in spans}}
            for j, (k, lo, hi) in enumerate(spans):
                x = col[k]
                low[j] += ((x < lo) & (x > -np.inf)).sum()
                v, n = np.unique(x[(x >= lo) & (x <= hi)], return_counts=True)
                js.append(np.full(len(v), j, np.int32))
                xs.append(v)
                ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (js, xs, ns)], names=["j", "x", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(spans), dtype=np.int32)), pa.nulls(len(spans), pa.float64()), pa.array(low)],
                                         names=["j", "x", "n"])

    found = values.mapInArrow(run, "j int, x double, n bigint").groupBy("j", "x").agg(F.sum("n").alias("n"))
    below, inside = np.zeros(len(spans), dtype=np.int64), np.zeros(len(spans), dtype=np.int64)
    if about <= COLLECT_ROWS:
        got = found.toArrow()
        j, x, n = got.column("j").to_numpy(), got.column("x").to_numpy(), got.column("n").to_numpy()
        null = np.asarray(got.column("x").is_null())
        below[j[null]] = n[null]
        j, x, n = j[~null], x[~null], n[~null]
        by = np.lexsort((x, j))
        j, x, n = j[by], x[by], n[by]
        np.add.at(inside, j, n)
        start = np.searchsorted(j, np.arange(len(spans) + 1))

        def pick(places):
            out = {}
            for s, ps in places.items():
                up = np.cumsum(n[start[s]:start[s + 1]])
                out[s] = {p: float(x[start[s] + np.searchsorted(up, p, "right")]) for p in ps}
            return out
        return below, inside, pick

    path = scratch_path(values.sparkSession, "bracketed")
    found.write.parquet(path)
    kept = values.sparkSession.read.parquet(path)
    for r in kept.groupBy("j", F.col("x").isNull().alias("low")).agg(F.sum("n").alias("n")).collect():   # two rows a span
        (below if r["low"] else inside)[r["j"]] = r["n"]

    def pick_by_sort(places):
        """Values in sorted parts of bounded size; a place's part is known from the parts' counts."""
        rows = kept.where("x is not null")
        ranged = scratch_path(values.sparkSession, "ranked")
        n_parts = max(1, int(about // COLLECT_ROWS))
        rows.repartitionByRange(n_parts, "j", "x").withColumn("part", F.spark_partition_id()).write.parquet(ranged)
        parts = values.sparkSession.read.parquet(ranged)
        up = Window.partitionBy("j").orderBy("part")
        sums = (parts.groupBy("j", "part").agg(F.sum("n").alias("m"))
                .select("j", "part", "m", (F.sum("m").over(up) - F.col("m")).alias("before")))
        spark = values.sparkSession
        asked = spark.createDataFrame([(int(j), int(p)) for j, ps in places.items() for p in ps], "j int, p bigint")
        at = sums.join(F.broadcast(asked), "j").where("before <= p and p < before + m")
        each = Window.partitionBy("j", "part").orderBy("x")
        placed = parts.join(F.broadcast(at.select("j", "part", "before").distinct()), ["j", "part"]).select(
            "j", "x", (F.sum("n").over(each) + F.col("before") - F.col("n")).alias("from"), (F.sum("n").over(each) + F.col("before")).alias("to"))
        out: dict[int, dict[int, float]] = {}
        for r in placed.join(F.broadcast(asked), "j").where("`from` <= p and p < `to`").select("j", "p", "x").collect():   # a row a rank
            out.setdefault(r["j"], {})[r["p"]] = r["x"]
        return out
    return below, inside, pick_by_sort


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles ``{(column, q): value}``, the same at any size; None
    for a column without values.  Between an infinity and another value lies that infinity."""
    cols = list(dict.fromkeys(cols))
    out: dict[tuple[str, float], float | None] = {(c, q): None for c in cols for q in qs}
    if not cols:
        return out
    sketches, found = _ranked(df, cols, lambda n: {f(q * (n - 1)) for q in qs for f in (math.floor, math.ceil)})
    for k, s in sketches.items():
        n = s["low"] + s["n"] + s["high"]
        for q in qs:
            p = q * (n - 1)
            lo, hi = found[k, math.floor(p)], found[k, math.ceil(p)]
            out[cols[k], q] = lo if lo == hi else (math.ceil(p) - p) * lo + (p - math.floor(p)) * hi
            if lo == -math.inf and hi == math.inf:
                out[cols[k], q] = math.nan
    return out


def part_edges(df: DataFrame, cols: Sequence[str], parts: int) -> dict[str, list[float]]:
    """Lower edges of all but the first of ``parts`` equally filled parts of every column: the
    distinct values at ranks ``floor(k n / parts)``, exact at any size."""
    names = list(dict.fromkeys(cols))
    if not names:
        return {}
    _, found = _ranked(df, names, lambda n: {j * n // parts for j in range(1, parts)})
    edges: dict[int, set[float]] = {}
    for (k, _), v in found.items():
        edges.setdefault(k, set()).add(v)
    return {c: sorted(edges.get(k, ())) for k, c in enumerate(names)}


def mode_value(df: DataFrame, c: str):
    """Most frequent non-null value, smallest on ties.  Two-phase: ``groupBy(value)``
    with map-side counting, then a top-1 -- never a per-task map of all values."""
    row = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
           .orderBy(F.col("__n").desc(), F.col(c).asc()).limit(1).collect())
    return row[0][c] if row else None


def text_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """``mode_value`` of several text columns from one unpivoted count."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in enumerate(cols)])
    counts = df.select(F.explode(pairs).alias("p")).where("p.v is not null").groupBy("p.k", "p.v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b")).collect()
    got = {r["k"]: r["b"]["v"] for r in best}
    return {c: got.get(k) for k, c in enumerate(cols)}


_QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def column_stats(df: DataFrame, cols: Sequence[str], stats: Sequence[str]) -> dict:
    """Statistics of many columns together; returns ``{(col, stat): value}``."""
    plain = {"mean": F.avg, "std_pop": F.stddev_pop, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}
    unknown = [s for s in stats if s not in plain and s not in _QUANTILES]
    if unknown:
        raise ValueError(unknown[0])
    out = {}
    simple = [s for s in stats if s in plain]
    if simple and cols:
        row = df.agg(*[plain[s](c).alias(f"s{k}_{s}") for k, c in enumerate(cols) for s in simple]).first()
        out = {(c, s): row[f"s{k}_{s}"] for k, c in enumerate(cols) for s in simple}
    ordered = [s for s in stats if s in _QUANTILES]
    if ordered:
        got = quantiles(df, cols, [_QUANTILES[s] for s in ordered])
        out |= {(c, s): got[c, _QUANTILES[s]] for c in cols for s in ordered}
    return out
