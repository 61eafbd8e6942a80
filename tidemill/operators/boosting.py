"""Histogram tree ensembles: boosting and forests grown from binned features.

Features are binned to bytes once, at exact quantiles, and the binned rows are written with a
row id.  A tree grows level by level from the sums of gradient and weight per (fit, tree, node,
feature, bin).  Many fits share the table and run together:

* a table within ``LOCAL_BYTES`` (counted, not guessed) is broadcast, and Spark deals out the
  fits, forests in blocks of trees; a search of hundreds of fits is one job;
* above it every level is one aggregate for the trees of all fits at once: each task walks its
  rows down the trees so far, adds up its own histograms, Spark sums them and picks the best
  split of each node; only one row a node comes back to the driver.

Both grow the same trees: draws of rows come from a hash of the row id, not from order.  In both a
task holds its rows (all of a small table, or ``CHUNK_BYTES`` of a large one), a few bytes more a
row, and one tree's histogram of ``CELLS`` cells; whatever else it makes is of ``STEP`` rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.stats import part_edges
from tidemill.session import scratch_path

BINS = 64
LOCAL_BYTES = 64 << 20     # binned rows a task may hold
CHUNK_BYTES = 32 << 20     # binned rows a task of the distributed path holds at a time
CELLS = 1 << 18            # histogram cells made at a time
STEP = 1 << 16             # rows worked on at a time
TREE_BLOCK = 8             # trees of a forest grown in one task
MARGIN_ROUNDS = 16         # rounds between written predictions on the distributed path
PATIENCE = 20              # rounds without a better validation error before boosting stops
_MIN_GAIN = 1e-12


@dataclass(frozen=True)
class TreeSpec:
    """How one ensemble grows.  ``bagged``: a forest of trees on bootstrap rows, averaged; else
    boosting with shrinkage ``rate``.  ``leaves`` bounds a tree's leaves, best gains first."""
    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    min_leaf: float = 1.0
    min_split: float = 2.0
    l2: float = 0.0
    leaves: int = 1 << 20
    rows: float = 1.0
    columns: float = 1.0
    bagged: bool = False
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One fit: rows (SQL conditions over the table's columns) to learn from, to stop by and to score."""
    name: str
    spec: TreeSpec
    train: str
    valid: str | None = None
    test: str | None = None


@dataclass
class Tree:
    """Nodes in arrays: a row with bin <= cut of the feature goes left; feature -1 is a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = a, a + 1
        for x, none in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0)):
            x += [none, none]
        return a, a + 1

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node each row has come down to."""
        feature, cut, left, right = (np.asarray(x) for x in (self.feature, self.cut, self.left, self.right))
        out = np.zeros(len(bins), dtype=np.int32)
        for s in range(0, len(bins), STEP):
            some, node = bins[s:s + STEP], out[s:s + STEP]
            rows = np.arange(len(some))
            while len(rows):
                rows = rows[feature[node[rows]] >= 0]
                at = node[rows]
                node[rows] = np.where(some[rows, feature[at]] <= cut[at], left[at], right[at])
        return out

    def packed(self) -> Tree:
        """The same tree in numpy arrays, an eighth of the size, for tasks."""
        return Tree(*(np.array(x, np.int32) for x in (self.feature, self.cut, self.left, self.right)), np.array(self.value), np.array(self.gain))


@dataclass
class Ensemble:
    """A fitted ensemble: ``base`` plus ``scale`` times the sum of the trees' leaves."""
    features: list[str]
    edges: list[list[float]]
    base: float
    scale: float
    trees: list[Tree]
    error: float | None = None      # RMSE on the rows of ``Fit.test``

    def bins(self, x: np.ndarray) -> np.ndarray:
        return bin_rows(x, self.edges)

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(b), self.base)
        for t in self.trees:
            out += self.scale * np.asarray(t.value)[t.walk(b)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with a column of predictions; a row with a null or NaN feature is predicted null."""
        sent = Ensemble(self.features, self.edges, self.base, self.scale, [t.packed() for t in self.trees])

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd
            v = np.stack(x.to_numpy()).astype(float) if len(x) else np.empty((0, len(sent.features)))   # nulls are NaN here
            return pd.Series(np.where(np.isnan(v).any(axis=1), np.nan, sent.predict(v)))
        return df.withColumn(out, predict(F.array(*[F.col(c).cast("double") for c in self.features])))

    def importance(self) -> np.ndarray:
        """Each feature's share of the gains of all splits."""
        g = np.zeros(len(self.features))
        for t in self.trees:
            for f, x in zip(t.feature, t.gain):
                if f >= 0:
                    g[f] += x
        return g / g.sum() if g.sum() else g

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Ensemble:
        d = json.loads(text)
        return Ensemble(**(d | {"trees": [Tree(**t) for t in d["trees"]]}))

    def save(self, spark, path: str) -> str:
        """One row of JSON, written by Spark to any of its file systems."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark, path: str) -> Ensemble:
        return Ensemble.from_json(spark.read.parquet(path).first()["model"])


def bin_rows(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Number of edges at or below each value, a byte each."""
    return np.column_stack([np.searchsorted(np.asarray(e, dtype=float), x[:, k], "right") for k, e in enumerate(edges)]).astype(np.uint8)


# ---------------------------------------------------------------- draws by row id

def _uniform(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree, by a hash of the row id."""
    x = rid.astype(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1342543DE82EF95) & (1 << 64) - 1)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


# P(Poisson(1) <= k)
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 12)]))


def _weights(rid: np.ndarray, tree: int, spec: TreeSpec) -> np.ndarray:
    """How often each row counts in a tree: a bootstrap draw (Poisson), or a share of the rows."""
    out = np.ones(len(rid), np.uint8)
    if spec.bagged or spec.rows < 1:
        for s in range(0, len(rid), STEP):
            u = _uniform(rid[s:s + STEP], tree, spec.seed)
            out[s:s + STEP] = np.searchsorted(_POISSON, u) if spec.bagged else u < spec.rows
    return out


def _columns(n: int, tree: int, spec: TreeSpec) -> np.ndarray:
    """Which features a tree may use."""
    use = np.ones(n, dtype=bool)
    if spec.columns < 1:
        order = np.argsort(_uniform(np.arange(n), tree, spec.seed + 1), kind="stable")
        use[order[max(1, round(spec.columns * n)):]] = False
    return use


# ---------------------------------------------------------------- growing one level

def _add(total: np.ndarray | None, at: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """Sums by place, after ``total``: the same to the last bit as all rows summed at once."""
    if total is None:
        return np.bincount(at, x, size)
    return np.bincount(np.concatenate([np.arange(size), at]), np.concatenate([total, x]), size)


def histogram(bins: np.ndarray, node: np.ndarray, grad: np.ndarray, weight: np.ndarray, rows: np.ndarray, first: int, nodes: int,
              n_bins: int) -> np.ndarray:
    """(2, nodes, features, bins): sums of weighted gradient and weight over ``rows`` in the open nodes from ``first`` on."""
    f = bins.shape[1]
    if len(rows) * f <= STEP:      # few rows: all features in one call
        w = weight[rows].astype(float)
        at = (((node[rows].astype(np.int64) - first)[:, None] * f + np.arange(f)) * n_bins + bins[rows]).ravel()
        return np.stack([np.bincount(at, np.repeat(x, f), nodes * f * n_bins) for x in (grad[rows] * w, w)]).reshape(2, nodes, f, n_bins)
    total: list = [[None] * f, [None] * f]
    for s in range(0, len(rows), STEP):
        r = rows[s:s + STEP]
        b, w = bins[r], weight[r].astype(float)
        g, base = grad[r] * w, (node[r].astype(np.int64) - first) * n_bins
        for k in range(f):
            at = base + b[:, k]
            total[0][k], total[1][k] = _add(total[0][k], at, g, nodes * n_bins), _add(total[1][k], at, w, nodes * n_bins)
    return np.stack([np.stack([x.reshape(nodes, n_bins) for x in t], axis=1) for t in total])


def histograms(bins: np.ndarray, node: np.ndarray, grad: np.ndarray, weight: np.ndarray, nodes: int, n_bins: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first node and the histogram of some open nodes after others, at most CELLS cells (or one
    node) each; ``node`` is each row's place among the open nodes, -1 for none."""
    per = max(1, CELLS // (bins.shape[1] * n_bins))
    rows = np.flatnonzero(node >= 0)
    if nodes <= per:
        yield 0, histogram(bins, node, grad, weight, rows, 0, nodes, n_bins)
        return
    rows = rows[np.argsort(node[rows], kind="stable")]      # a node's rows stay in their order
    ends = np.searchsorted(node[rows], np.arange(0, nodes + per, per))
    for k, first in enumerate(range(0, nodes, per)):
        yield first, histogram(bins, node, grad, weight, rows[ends[k]:ends[k + 1]], first, min(per, nodes - first), n_bins)


def best_splits(hist: np.ndarray, spec: TreeSpec, use: np.ndarray) -> list[tuple[int, int, float] | None]:
    """Each node's split with the largest gain, the first feature and bin of equals; None: a leaf."""
    g, w = np.cumsum(hist, axis=3)
    total_g, total_w = g[:, :1, -1:], w[:, :1, -1:]
    left, right = w, total_w - w
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (g ** 2 / (left + spec.l2) + (total_g - g) ** 2 / (right + spec.l2) - total_g ** 2 / (total_w + spec.l2))
    legal = (left >= spec.min_leaf) & (right >= spec.min_leaf) & (total_w >= spec.min_split) & use[:, None]
    gain = np.where(legal & (left > 0) & (right > 0), gain, -1.0).reshape(len(g), -1)
    # single precision: gains that differ only by the order of summation are equal
    best, n_bins = gain.astype(np.float32).argmax(axis=1), hist.shape[3]
    return [(int(b) // n_bins, int(b) % n_bins, float(x[b])) if x[b] > _MIN_GAIN else None for b, x in zip(best, gain)]


class _Growing:
    """A tree and its open nodes; the same on a task and on the driver."""

    def __init__(self, spec: TreeSpec):
        self.spec, self.tree, self.open, self.leaves, self.level = spec, Tree(), [0], 1, 0

    def grow(self, splits: list, sums: Sequence[tuple[float, float]]) -> None:
        """Split the open nodes that have a split, the best gains first while leaves are left; the
        others become leaves with their mean gradient."""
        by_gain = sorted((i for i, s in enumerate(splits) if s), key=lambda i: -splits[i][2])
        chosen = set(by_gain[:max(0, self.spec.leaves - self.leaves)]) if self.level < self.spec.depth else set()
        nxt = []
        for i, node in enumerate(self.open):
            g, w = sums[i]
            self.tree.value[node] = g / (w + self.spec.l2) if w + self.spec.l2 > 0 else 0.0
            if i in chosen:
                nxt += self.tree.split(node, *splits[i])
                self.leaves += 1
        self.open, self.level = nxt, self.level + 1


def _node_sums(at: np.ndarray, grad: np.ndarray, weight: np.ndarray, nodes: int) -> np.ndarray:
    """(nodes, 2): sums of weighted gradient and weight over the rows of each open node."""
    g = w = None
    for s in range(0, len(at), STEP):
        r = s + np.flatnonzero(at[s:s + STEP] >= 0)
        weigh = weight[r].astype(float)
        g, w = _add(g, at[r], grad[r] * weigh, nodes), _add(w, at[r], weigh, nodes)
    return np.stack([g, w], axis=1) if len(at) else np.zeros((nodes, 2))


def grow_tree(bins: np.ndarray, grad: np.ndarray, weight: np.ndarray, spec: TreeSpec, use: np.ndarray, n_bins: int) -> Tree:
    """One tree on rows held in memory."""
    t = _Growing(spec)
    at = np.where(weight > 0, np.int32(0), np.int32(-1))     # each row's place among the open nodes, -1 in a leaf or left out
    while t.open:
        before = t.open
        sums = _node_sums(at, grad, weight, len(before))
        splits: list = [None] * len(before)
        if t.level < spec.depth:
            able = np.flatnonzero(sums[:, 1] >= max(spec.min_split, 2 * spec.min_leaf))   # others are leaves anyway
            place = np.full(len(before) + 1, -1, np.int32)     # the last one is that of rows without a place
            place[able] = np.arange(len(able))
            if len(able):
                for first, hist in histograms(bins, place[at], grad, weight, len(able), n_bins):
                    for i, found in zip(able[first:].tolist(), best_splits(hist, spec, use)):
                        splits[i] = found
        t.grow(splits, sums.tolist())
        f, c, lo, hi = (np.array([x[k] for k in before]) for x in (t.tree.feature, t.tree.cut, t.tree.left, t.tree.right))
        to = np.full(len(t.tree.feature), -1, np.int32)
        to[t.open] = np.arange(len(t.open))
        for s in range(0, len(at), STEP):
            part = at[s:s + STEP]
            rows = np.flatnonzero(part >= 0)
            n = part[rows]
            go = np.where(bins[s + rows, np.maximum(f[n], 0)] <= c[n], lo[n], hi[n])
            part[rows] = np.where(f[n] >= 0, to[go], -1)
    return t.tree


def _boost(b: dict, fit: dict, blocks: int = 1, block: int = 0) -> tuple[float, float, list[Tree]]:
    """Fit one ensemble (or one block of a forest's trees) on the broadcast rows."""
    spec, bins, y, rid, n_bins = fit["spec"], b["bins"], b["y"], b["rid"], b["n_bins"]
    train = np.flatnonzero(b["masks"][fit["train"]])
    valid = np.flatnonzero(b["masks"][fit["valid"]]) if fit["valid"] else np.empty(0, np.int64)
    if not len(train):
        raise ValueError("no training rows")
    base = float(y[train].mean())
    unseen, checked = bins[valid], y[valid]
    if len(train) < len(y):
        bins, y, rid = bins[train], y[train], rid[train]
    if spec.bagged:
        grad = y - base
        trees = [grow_tree(bins, grad, _weights(rid, k, spec), spec, _columns(bins.shape[1], k, spec), n_bins)
                 for k in range(block, spec.rounds, blocks)]
        return base, 1.0 / spec.rounds, trees
    margin, check = np.full(len(train), base), np.full(len(valid), base)
    trees, best, keep = [], np.inf, 0
    for k in range(spec.rounds):
        t = grow_tree(bins, y - margin, _weights(rid, k, spec), spec, _columns(bins.shape[1], k, spec), n_bins)
        trees.append(t)
        value = spec.rate * np.asarray(t.value)
        margin += value[t.walk(bins)]
        if len(valid):
            check += value[t.walk(unseen)]
            error = float(((checked - check) ** 2).mean())
            if error < best:
                best, keep = error, k + 1
            elif k + 1 - keep >= PATIENCE:
                break
    return base, spec.rate, trees[:keep] if len(valid) else trees


# ---------------------------------------------------------------- the binned table

@dataclass
class Binned:
    """Rows written as bytes: rid, y, bins (a byte a feature) and a flag for each condition."""
    df: DataFrame
    features: list[str]
    edges: list[list[float]]
    n_bins: int
    rows: int
    flags: dict[str, str]      # condition -> column


def bin_table(df: DataFrame, feature_cols: Sequence[str], label: str, conditions: Sequence[str], bins: int = BINS) -> Binned:
    """Bin at exact quantiles and write.  Rows with a null or NaN feature or label are refused, as
    by the estimators of Spark ML."""
    features = list(feature_cols)
    if not 2 <= bins <= 256:
        raise ValueError(f"bins must be 2 to 256, not {bins}")
    flags = {c: f"m{k}" for k, c in enumerate(dict.fromkeys(conditions))}
    used = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)], F.col(label).cast("double").alias("y"),
                     *[F.coalesce(F.expr(c), F.lit(False)).alias(m) for c, m in flags.items()])
    used = used.where(" or ".join(flags.values())).persist()
    try:
        names = [f"x{k}" for k in range(len(features))]
        bad = F.count(F.when(F.greatest(*[(F.col(c).isNull() | F.isnan(c)).cast("int") for c in [*names, "y"]]) == 1, 1))
        row = used.agg(F.count(F.lit(1)).alias("n"), bad.alias("bad")).first()
        if row["bad"]:
            raise ValueError(f"{row['bad']} rows with a null or NaN feature or label")
        found = part_edges(used, names, bins)
        edges = [found[c] for c in names]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(len(names))])
                raw = bin_rows(x, edges)
                cells = pa.Array.from_buffers(pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([cells.cast(pa.binary()), *b.columns[len(names):]],
                                                 names=["bins", *b.schema.names[len(names):]])

        kinds = "bins binary, y double" + "".join(f", {m} boolean" for m in flags.values())
        out = used.mapInArrow(run, kinds)
        path = scratch_path(df.sparkSession, "binned")
        same = ["bins", "y", *flags.values()]
        (out.withColumn("h", F.xxhash64(*same)).orderBy(*same)
         .mapInArrow(_number_copies, kinds + ", rid bigint").write.parquet(path))
    finally:
        used.unpersist()
    return Binned(df.sparkSession.read.parquet(path), features, edges, bins, row["n"], flags)


def _number_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid from a row's hash and its number among its copies, which are neighbours: the same on
    every run, and copies are drawn one by one."""
    last, n = None, 0
    for b in batches:
        h = b.column(b.num_columns - 1).to_numpy()
        if not len(h):
            continue
        start = np.r_[0, np.flatnonzero(h[1:] != h[:-1]) + 1]
        size = np.diff(np.r_[start, len(h)])
        number = np.arange(len(h)) - np.repeat(start, size)
        if h[0] == last:
            number[:size[0]] += n
        last, n = h[-1], int(number[-1]) + 1
        rid = h.view(np.uint64) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rid.view(np.int64))], names=[*b.schema.names[:-1], "rid"])


def _held(b: Binned) -> dict:
    """The binned rows in memory, by row id; only within LOCAL_BYTES."""
    t = b.df.orderBy("rid").toArrow().combine_chunks()
    raw = t.column("bins").combine_chunks().to_pylist()
    return {"bins": np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1), "y": t.column("y").to_numpy(),
            "rid": t.column("rid").to_numpy(), "n_bins": b.n_bins,
            "masks": {m: t.column(m).to_numpy(zero_copy_only=False).astype(bool) for m in b.flags.values()}}


def fit_all(df: DataFrame, feature_cols: Sequence[str], label: str, fits: Sequence[Fit], bins: int = BINS,
            keep: bool = True, local_bytes: int = LOCAL_BYTES) -> dict[str, Ensemble]:
    """Bin the table and fit every ensemble of ``fits`` (see ``fit_binned``)."""
    return fit_binned(bin_table(df, feature_cols, label, conditions(fits), bins), fits, keep, local_bytes)


def conditions(fits: Sequence[Fit]) -> list[str]:
    return [c for f in fits for c in (f.train, f.valid, f.test) if c]


def fit_binned(b: Binned, fits: Sequence[Fit], keep: bool = True, local_bytes: int = LOCAL_BYTES) -> dict[str, Ensemble]:
    """Fit every ensemble of ``fits`` on a binned table that has their conditions; ``keep=False``
    brings back the errors on ``Fit.test`` only.

    A fit without training rows raises; any failure of a task is the job's.
    """
    size = b.rows * (len(b.features) + 16 + len(b.flags))
    return (_fit_held if size <= local_bytes else _fit_levels)(b, fits, keep)


def _fit_held(b: Binned, fits: Sequence[Fit], keep: bool) -> dict[str, Ensemble]:
    spark = b.df.sparkSession
    table = spark.sparkContext.broadcast(_held(b))
    jobs = {}
    for k, f in enumerate(fits):
        job = {"spec": f.spec, "train": b.flags[f.train], "valid": b.flags.get(f.valid), "test": b.flags.get(f.test)}
        # a forest's trees do not depend on each other; scored ones stay whole, so that only their error comes back
        blocks = -(-f.spec.rounds // TREE_BLOCK) if f.spec.bagged and (keep and not f.test) else 1
        jobs |= {(k, i): (job, blocks) for i in range(blocks)}
    order = list(jobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        for batch in batches:
            for at in batch.column(0).to_pylist():
                (k, i), (job, blocks) = order[at], jobs[order[at]]
                base, scale, trees = _boost(rows, job, blocks, i)
                error = None
                if job["test"]:
                    test = np.flatnonzero(rows["masks"][job["test"]])
                    p, scored = np.full(len(test), base), rows["bins"][test]
                    for t in trees:
                        p += scale * np.asarray(t.value)[t.walk(scored)]
                    error = float(np.sqrt(((rows["y"][test] - p) ** 2).mean())) if len(test) else None
                made = json.dumps([asdict(t) for t in trees]) if keep else "[]"
                yield pa.RecordBatch.from_pydict({"fit": [k], "block": [i], "base": [base], "scale": [scale], "error": [error], "trees": [made]},
                                                 schema=pa.schema([("fit", pa.int32()), ("block", pa.int32()), ("base", pa.float64()),
                                                                   ("scale", pa.float64()), ("error", pa.float64()), ("trees", pa.string())]))

    # the long fits first, each its own task, so that the last ones to end are short
    order.sort(key=lambda at: -jobs[at][0]["spec"].rounds * jobs[at][0]["spec"].depth)
    units = spark.range(0, len(order), 1, min(len(order), max(1, 4 * spark.sparkContext.defaultParallelism)))
    rows = units.mapInArrow(run, "fit int, block int, base double, scale double, error double, trees string").collect()
    table.destroy()
    out = {}
    for k, f in enumerate(fits):
        mine = sorted((r for r in rows if r["fit"] == k), key=lambda r: r["block"])
        trees = [Tree(**t) for r in mine for t in json.loads(r["trees"])]
        out[f.name] = Ensemble(b.features, b.edges, mine[0]["base"], mine[0]["scale"], trees, mine[0]["error"])
    return out


# ---------------------------------------------------------------- level by level, for tables of any size

def _fit_levels(b: Binned, fits: Sequence[Fit], keep: bool) -> dict[str, Ensemble]:
    """All fits in step: one aggregate a level for every open tree.  Forests grow all trees at once,
    boosting one tree of each fit at a time; predictions so far are written every MARGIN_ROUNDS."""
    flags = [{"train": b.flags[f.train], "valid": b.flags.get(f.valid), "test": b.flags.get(f.test)} for f in fits]
    sums = b.df.agg(*[F.avg(F.when(F.col(m["train"]), F.col("y"))).alias(f"a{k}") for k, m in enumerate(flags)]).first()
    if any(x is None for x in sums):
        raise ValueError("no training rows")
    out = {f.name: Ensemble(b.features, b.edges, sums[f"a{k}"], 1.0 / f.spec.rounds if f.spec.bagged else f.spec.rate, [])
           for k, f in enumerate(fits)}
    forests = [(k, t) for k, f in enumerate(fits) if f.spec.bagged for t in range(f.spec.rounds)]
    bases = [out[f.name].base for f in fits]
    for lo in range(0, len(forests), 64):
        some = forests[lo:lo + 64]
        for (k, _), tree in zip(some, _grow_levels(b, fits, flags, some, b.df, bases, [[] for _ in fits])):
            out[fits[k].name].trees.append(tree)

    boosted = [k for k, f in enumerate(fits) if not f.spec.bagged]
    best, kept = {k: np.inf for k in boosted}, dict.fromkeys(boosted, 0)
    written, since = b.df, [[] for _ in fits]
    live, r = list(boosted), 0
    while live:
        for (k, _), tree in zip([(k, r) for k in live], _grow_levels(b, fits, flags, [(k, r) for k in live], written, bases, since)):
            out[fits[k].name].trees.append(tree)
            since[k].append(tree)
        if any(fits[k].valid for k in live):
            for k, error in _errors(b, fits, flags, [k for k in live if fits[k].valid], "valid", written, bases, since).items():
                if error is not None and error < best[k]:
                    best[k], kept[k] = error, r + 1
        r += 1
        live = [k for k in live if r < fits[k].spec.rounds and not (fits[k].valid and kept[k] and r - kept[k] >= PATIENCE)]
        if live and r % MARGIN_ROUNDS == 0:
            written, since = _write_margins(b, fits, written, bases, since), [[] for _ in fits]
    for k in boosted:
        if fits[k].valid and kept[k]:
            del out[fits[k].name].trees[kept[k]:]
    scored = [k for k, f in enumerate(fits) if f.test]
    if scored:
        whole = [out[f.name].trees for f in fits]
        for k, error in _errors(b, fits, flags, scored, "test", b.df, bases, whole).items():
            out[fits[k].name].error = None if error is None else error ** 0.5
    if not keep:
        for e in out.values():
            e.trees = []
    return out


def _columns_of(b: Binned, rows: DataFrame) -> list[str]:
    return ["bins", "y", "rid", *b.flags.values(), *(["margins"] if "margins" in rows.columns else [])]


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, dict]:
    cols = dict(zip(batch.schema.names, batch.columns))
    raw = b"".join(cols["bins"].to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(batch.num_rows, -1), cols


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, dict]]:
    """The rows of many batches together, up to CHUNK_BYTES, so that a histogram is made of many rows."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > CHUNK_BYTES:
            yield _together(held)
            held, size = [], 0
        held.append(_batch(batch))
        size += batch.nbytes
    if held:
        yield _together(held)


def _together(held: list[tuple[np.ndarray, dict]]) -> tuple[np.ndarray, dict]:
    names = [c for c in held[0][1] if c != "bins"]
    return np.concatenate([bins for bins, _ in held]), {c: pa.concat_arrays([cols[c] for _, cols in held]) for c in names}


def _margin(k: int, bins: np.ndarray, cols: dict, base: float, scale: float, since: list[Tree], rows: np.ndarray) -> np.ndarray:
    """Predictions of fit ``k``: those written, and the trees since."""
    if "margins" in cols:
        width = len(cols["margins"].values) // max(1, len(bins))
        out = cols["margins"].values.to_numpy().reshape(len(bins), width)[rows, k].copy()
    else:
        out = np.full(len(rows), base)
    for t in since:
        out += scale * np.asarray(t.value)[t.walk(bins[rows])]
    return out


def _scales(fits: Sequence[Fit]) -> list[float]:
    return [1.0 / f.spec.rounds if f.spec.bagged else f.spec.rate for f in fits]


def _grow_levels(b: Binned, fits, flags, trees: list[tuple[int, int]], rows: DataFrame, bases, since) -> list[Tree]:
    growing = [_Growing(fits[k].spec) for k, _ in trees]
    scales, n_bins = _scales(fits), b.n_bins
    use = [_columns(len(b.features), t, fits[k].spec) for k, t in trees]
    limits = b.df.sparkSession.createDataFrame(
        [(j, f, float(fits[k].spec.min_leaf), float(fits[k].spec.min_split), float(fits[k].spec.l2)) for j, (k, _) in enumerate(trees)
         for f in np.flatnonzero(use[j]).tolist()], "job int, feature int, min_leaf double, min_split double, l2 double")
    while any(g.open for g in growing):
        # a leaf at full depth needs its sums only, which any one feature has
        state = [(g.tree.packed(), g.open, 1 if g.level >= g.spec.depth else len(b.features)) for g in growing]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _level_sums(batches, trees, state, fits, flags, bases, scales, since, n_bins)

        sums = (rows.select(*_columns_of(b, rows)).mapInArrow(run, "job int, node int, feature int, bin int, g double, w double")
                .groupBy("job", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("w").alias("w")))
        of = Window.partitionBy("job", "node", "feature")
        run_up = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cum = sums.select("job", "node", "feature", "bin", F.sum("g").over(run_up).alias("gl"), F.sum("w").over(run_up).alias("wl"),
                          F.sum("g").over(of).alias("gt"), F.sum("w").over(of).alias("wt")).join(F.broadcast(limits), ["job", "feature"], "left")
        wr, gr = F.col("wt") - F.col("wl"), F.col("gt") - F.col("gl")
        legal = (F.col("wl") >= F.col("min_leaf")) & (wr >= F.col("min_leaf")) & (F.col("wt") >= F.col("min_split")) & (wr > 0)
        gain = F.when(legal, F.col("gl") ** 2 / (F.col("wl") + F.col("l2")) + gr ** 2 / (wr + F.col("l2"))
                      - F.col("gt") ** 2 / (F.col("wt") + F.col("l2")))
        best = cum.select("job", "node", "gt", "wt", F.struct(gain.cast("float").alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("c")).alias("s"))
        found = best.groupBy("job", "node").agg(F.first("gt").alias("g"), F.first("wt").alias("w"),
                                                F.max(F.when(F.col("s.gain") > _MIN_GAIN, F.col("s"))).alias("s")).collect()   # a row a node
        by = {(r["job"], r["node"]): r for r in found}
        for j, g in enumerate(growing):
            if g.open:
                got = [by.get((j, i)) for i in range(len(g.open))]
                g.grow([(-r["s"]["f"], -r["s"]["c"], r["s"]["gain"]) if r and r["s"] else None for r in got],
                       [(r["g"], r["w"]) if r else (0.0, 0.0) for r in got])
    return [g.tree for g in growing]


def _level_sums(batches: Iterator[pa.RecordBatch], trees: list[tuple[int, int]], state: list[tuple[Tree, list[int], int]], fits, flags, bases,
                scales, since, n_bins: int) -> Iterator[pa.RecordBatch]:
    """The histograms of a task's rows, handed on a part of a tree at a time; ``state`` has each tree,
    its open nodes and of how many features."""
    for bins, cols in _chunks(batches):
        rid, y = cols["rid"].to_numpy(), cols["y"].to_numpy()
        weight, grad, node = np.zeros(len(bins), np.uint8), np.zeros(len(bins)), np.full(len(bins), -1, np.int32)
        for j, ((k, number), (tree, nodes, width)) in enumerate(zip(trees, state)):
            if not nodes:
                continue
            place = np.full(len(tree.feature), -1, np.int32)
            place[nodes] = np.arange(len(nodes))
            node[:] = -1
            at = np.flatnonzero(cols[flags[k]["train"]].to_numpy(zero_copy_only=False).astype(bool))
            for s in range(0, len(at), STEP):
                some = at[s:s + STEP]
                weight[some] = _weights(rid[some], number, fits[k].spec)
                some = some[weight[some] > 0]
                node[some] = place[tree.walk(bins[some])]
                some = some[node[some] >= 0]
                grad[some] = y[some] - _margin(k, bins, cols, bases[k], scales[k], since[k], some)
            for first, h in histograms(bins[:, :width], node, grad, weight, len(nodes), n_bins):
                n, f, c = np.nonzero(h[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), j, np.int32)), *(pa.array(x.astype(np.int32)) for x in (n + first, f, c)),
                     pa.array(h[0][n, f, c]), pa.array(h[1][n, f, c])], names=["job", "node", "feature", "bin", "g", "w"])


def _errors(b: Binned, fits, flags, which: list[int], role: str, rows: DataFrame, bases, since) -> dict[int, float | None]:
    """Mean squared error of the fits ``which`` on their rows of ``role``."""
    scales = _scales(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(which)))
        for batch in batches:
            bins, cols = _batch(batch)
            y = cols["y"].to_numpy()
            for i, k in enumerate(which):
                at = np.flatnonzero(cols[flags[k][role]].to_numpy(zero_copy_only=False).astype(bool))
                if len(at):
                    total[:, i] += len(at), ((y[at] - _margin(k, bins, cols, bases[k], scales[k], since[k], at)) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.array(which, np.int32)), pa.array(total[0]), pa.array(total[1])], names=["fit", "n", "sse"])

    got = (rows.select(*_columns_of(b, rows)).mapInArrow(run, "fit int, n double, sse double").groupBy("fit")
           .agg(F.sum("n").alias("n"), F.sum("sse").alias("sse")).collect())
    return {r["fit"]: r["sse"] / r["n"] if r["n"] else None for r in got}


def _write_margins(b: Binned, fits, rows: DataFrame, bases, since) -> DataFrame:
    scales = _scales(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, cols = _batch(batch)
            every = np.arange(len(bins))
            m = np.column_stack([_margin(k, bins, cols, bases[k], scales[k], since[k], every) for k in range(len(fits))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel()))
            keep = [c for c in batch.schema.names if c != "margins"]
            yield pa.RecordBatch.from_arrays([*(cols[c] for c in keep), lists], names=[*keep, "margins"])

    kinds = "bins binary, y double, rid bigint" + "".join(f", {m} boolean" for m in b.flags.values())
    path = scratch_path(b.df.sparkSession, "margins")
    rows.select(*_columns_of(b, rows)).mapInArrow(run, kinds + ", margins array<double>").write.parquet(path)
    return b.df.sparkSession.read.parquet(path)
