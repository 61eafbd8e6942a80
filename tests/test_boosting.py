"""Histogram ensembles: one task and many, brute force, stopping, refusal of bad rows, persistence."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.operators import boosting as bo
from tidemill.session import scratch_path


def _frame(spark, n=600, seed=0, parts=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    y = np.where(x[:, 0] > 0.3, 2.0, 0.0) + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.1
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "i int, a double, b double, c double, d double, y double").repartition(parts, "i")


SPECS = {"boost": bo.TreeSpec(rounds=20, rate=0.3, depth=3, min_leaf=3, l2=1.0),
         "leafwise": bo.TreeSpec(rounds=18, rate=0.2, depth=8, leaves=7, rows=0.7, columns=0.5),
         "forest": bo.TreeSpec(rounds=12, depth=6, bagged=True, min_split=8)}
FEATURES = ["a", "b", "c", "d"]


def _fits():
    return [bo.Fit(n, s, "i < 400", None if s.bagged else "i >= 400 and i < 500", "i >= 500") for n, s in SPECS.items()]


def test_one_task_and_levels_grow_the_same_trees(spark):
    df = _frame(spark)
    held = bo.fit_all(df, FEATURES, "y", _fits())
    levels = bo.fit_all(df, FEATURES, "y", _fits(), local_bytes=0)
    x = np.array([[r[c] for c in FEATURES] for r in df.collect()])
    for name, e in held.items():
        assert len(e.trees) == len(levels[name].trees) > 5
        assert np.allclose(e.predict(x), levels[name].predict(x)), name
        assert e.error == pytest.approx(levels[name].error) and e.error < 1.0
    assert max(sum(f < 0 for f in t.feature) for t in held["leafwise"].trees) <= 7
    only = bo.fit_all(df, FEATURES, "y", _fits(), keep=False)
    assert {n: e.error for n, e in only.items()} == pytest.approx({n: e.error for n, e in held.items()})


def _plain_tree(rows, g, depth, min_leaf, l2):
    """(value) or (feature, threshold bin, left, right), by trying every cut of every feature."""
    total = sum(g[i] for i in rows)
    best = (1e-12, None)
    if depth:
        for f in range(len(BINS[0])):
            for c in sorted({BINS[i][f] for i in rows}):
                left = [i for i in rows if BINS[i][f] <= c]
                n, m = len(left), len(rows) - len(left)
                if n < min_leaf or m < min_leaf:
                    continue
                a = sum(g[i] for i in left)
                gain = a * a / (n + l2) + (total - a) ** 2 / (m + l2) - total * total / (len(rows) + l2)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, c, left))
    if best[1] is None:
        return total / (len(rows) + l2)
    f, c, left = best[1]
    inside = set(left)
    return f, c, _plain_tree(left, g, depth - 1, min_leaf, l2), _plain_tree([i for i in rows if i not in inside], g, depth - 1, min_leaf, l2)


def _plain_value(t, b):
    while isinstance(t, tuple):
        t = t[2] if b[t[0]] <= t[1] else t[3]
    return t


def test_boosting_against_plain_python(spark):
    global BINS
    df = _frame(spark, 120, 5, 2)
    spec = bo.TreeSpec(rounds=6, rate=0.4, depth=3, min_leaf=2, l2=0.5)
    e = bo.fit_all(df, FEATURES, "y", [bo.Fit("m", spec, "i < 100", None, "i >= 100")], bins=16)["m"]
    rows = sorted(df.collect(), key=lambda r: r["i"])
    x, y = np.array([[r[c] for c in FEATURES] for r in rows]), [r["y"] for r in rows]
    cuts = [sorted({sorted(x[:, f][:].tolist())[k * 120 // 16] for k in range(1, 16)}) for f in range(4)]
    assert e.edges == cuts
    BINS = [[sum(v >= c for c in cuts[f]) for f, v in enumerate(r)] for r in x.tolist()]
    train = list(range(100))
    pred = [sum(y[:100]) / 100] * 120
    for _ in range(spec.rounds):
        t = _plain_tree(train, [a - p for a, p in zip(y, pred)], spec.depth, spec.min_leaf, spec.l2)
        pred = [p + spec.rate * _plain_value(t, b) for p, b in zip(pred, BINS)]
    assert np.allclose(e.predict(x), pred)
    rmse = (sum((a - p) ** 2 for a, p in zip(y[100:], pred[100:])) / 20) ** 0.5
    assert e.error == pytest.approx(rmse)


def test_stops_early_and_saves(spark):
    df = _frame(spark, 300)
    noise = df.withColumn("y", F.rand(3))
    e = bo.fit_all(noise, FEATURES, "y", [bo.Fit("m", bo.TreeSpec(rounds=400, rate=0.3), "i < 200", "i >= 200")])["m"]
    assert len(e.trees) < 100
    again = bo.Ensemble.load(spark, e.save(spark, scratch_path(spark, "ensemble")))
    assert again == e
    with_null = df.union(df.limit(1).withColumns({"a": F.lit(None).cast("double"), "i": F.lit(-1)}))
    got = {r["i"]: r["prediction"] for r in again.transform(with_null).collect()}
    x = {r["i"]: [r[c] for c in FEATURES] for r in df.collect()}
    assert got.pop(-1) is None
    assert np.allclose([got[i] for i in sorted(x)], e.predict(np.array([x[i] for i in sorted(x)])))
    assert e.importance().sum() == pytest.approx(1.0)


def test_bad_rows_and_empty_fits_raise(spark):
    df = _frame(spark, 40)
    with pytest.raises(ValueError, match="1 rows with a null"):
        bo.fit_all(df.withColumn("a", F.when(F.col("i") != 3, F.col("a"))), FEATURES, "y", [bo.Fit("m", bo.TreeSpec(), "i >= 0")])
    with pytest.raises(Exception, match="no training rows"):
        bo.fit_all(df, FEATURES, "y", [bo.Fit("m", bo.TreeSpec(), "i > 1000", None, "i < 10")])
    flat = bo.fit_all(df.withColumns({c: F.lit(1.0) for c in FEATURES}), FEATURES, "y", [bo.Fit("m", bo.TreeSpec(rounds=2), "i >= 0")])["m"]
    assert all(t.feature == [-1] for t in flat.trees) and flat.importance().sum() == 0


def test_copies_are_drawn_one_by_one():
    rng = random.Random(0)
    rid = np.array([rng.randrange(1 << 40) for _ in range(20_000)])
    w = bo._weights(rid, 3, bo.TreeSpec(bagged=True))
    assert abs(w.mean() - 1) < 0.05 and abs((w == 0).mean() - np.exp(-1)) < 0.02
    assert abs(bo._weights(rid, 3, bo.TreeSpec(rows=0.7)).mean() - 0.7) < 0.02


def _peak(run):
    """MB that ``run`` takes at most, beside what there was."""
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_a_tree_takes_few_bytes_a_row():
    rng = np.random.default_rng(1)
    n, spec = 400_000, bo.TreeSpec(bagged=True, depth=7)
    bins, grad, rid = rng.integers(0, 64, (n, 14)).astype(np.uint8), rng.normal(size=n), rng.integers(0, 1 << 60, n)
    # a byte of weight, four of place and some rows' numbers; 400 bytes a row when a level was summed at once
    assert _peak(lambda: bo.grow_tree(bins, grad, bo._weights(rid, 0, spec), spec, np.ones(14, bool), 64)) < 50


def test_histograms_in_parts_are_the_whole(monkeypatch):
    rng = np.random.default_rng(2)
    n, nodes = 3000, 37
    bins, node = rng.integers(0, 8, (n, 3)).astype(np.uint8), rng.integers(-1, nodes, n)
    grad, weight = rng.normal(size=n), rng.integers(1, 4, n).astype(np.uint8)
    want = np.zeros((2, nodes, 3, 8))
    for b, at, g, w in zip(bins, node, grad, weight):
        for f in range(3):
            if at >= 0:
                want[:, at, f, b[f]] += g * w, w
    for cells in (1, 24 * 5, 1 << 20):
        monkeypatch.setattr(bo, "CELLS", cells)
        monkeypatch.setattr(bo, "STEP", 700)
        parts = list(bo.histograms(bins, node, grad, weight, nodes, 8))
        assert [first for first, _ in parts] == list(range(0, nodes, max(1, cells // 24)))
        assert np.array_equal(np.concatenate([h for _, h in parts], axis=1), want)


def test_a_level_of_many_trees_takes_one_trees_histogram(monkeypatch):
    rng = np.random.default_rng(3)
    n, grown = 20_000, bo._Growing(bo.TreeSpec(depth=9))
    for _ in range(9):
        grown.grow([(int(rng.integers(14)), int(rng.integers(20, 44)), 1.0)] * len(grown.open), [(0.0, 1.0)] * len(grown.open))
    bins = rng.integers(0, 64, (n, 14)).astype(np.uint8)
    batches = [pa.RecordBatch.from_pydict({"bins": [r.tobytes() for r in part], "y": rng.normal(size=len(part)), "rid": rng.integers(0, 1 << 60, len(part)),
                                           "m0": [True] * len(part)}) for part in np.array_split(bins, 7)]
    trees, fits = [(0, t) for t in range(64)], [bo.Fit("m", bo.TreeSpec(bagged=True, depth=9), "true")]
    state, got = [(grown.tree.packed(), grown.open, 14)] * 64, []

    def run():
        for b in bo._level_sums(iter(batches), trees, state, fits, [{"train": "m0"}], [0.0], [1 / 64], [[]], 64):
            if set(b.column("job").to_pylist()) == {5}:
                got.extend(b.select(["node", "feature", "bin", "w"]).to_pylist())

    assert _peak(run) < 100      # 64 trees' together are 470
    monkeypatch.setattr(bo, "CHUNK_BYTES", 1)
    assert sum(len(r[0]) for r in bo._chunks(iter(batches))) == n and len(list(bo._chunks(iter(batches)))) == 7
    rid = np.concatenate([b.column("rid").to_numpy() for b in batches])
    assert len({(r["node"], r["feature"], r["bin"]) for r in got}) == len(got)      # each cell once
    assert sum(r["w"] for r in got) == 14 * bo._weights(rid, 5, fits[0].spec).sum(dtype=float)
