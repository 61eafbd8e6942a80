"""Approximate nearest neighbours by shifted space-filling curves.

Every ordering projects the vectors onto a few random orthogonal directions, shifts them by a
random offset and sorts them by Hilbert key, range-partitioned in Spark.  A query's candidates
are its neighbours in rank within a window of each ordering; the windows' results merge and are
ranked by the exact inner product of the original vectors.

The window is measured, not guessed: for a bounded sample of queries the true neighbours are
found by brute force over all rows, and their distance in rank is taken in every ordering.  For
the first m orderings the window is the quantile, at the target recall, of the distance in the
nearest of them; the m that compares the fewest rows is searched.  Clustered data take several
orderings with narrow windows.  Data without structure take one with a wide window, which is
never more than an exact search but for the rest of a tile at either end.

Orderings are first made of ids alone; vectors are sorted only along those searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged
from ._vectors import as_matrix, batches_by_run, element_type, unpack, valid_vector

ORDERINGS = 8
PROJECTED = 8        # dimensions of a curve
BITS = 7             # per dimension: keys of 56 bits
SAMPLE_QUERIES = 128
TARGET_RECALL = 0.97
TILES = (512, 4096)  # rows of a tile: a quarter of the window, within these
BUCKET = 16          # a bucket is the window over this, within 1 and this many tiles
_BLOCK = 4096        # rows scored at a time
_HEAD = 8192         # best lists a task holds before handing them on


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of integer points (rows) along the Hilbert curve through a cube of side 2**bits.

    The axes are turned into the curve's transposed form bit by bit from the top (reflections and
    exchanges with the first axis), Gray-decoded and interleaved."""
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for i in range(d):
            flip = (x[i] & top) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        gray ^= np.where(x[d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= gray
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _curves(dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions and shift of every ordering."""
    rng = np.random.default_rng(seed)
    d = min(PROJECTED, dims)
    return [(np.linalg.qr(rng.normal(size=(dims, d)))[0], rng.random(d)) for _ in range(ORDERINGS)]


def curve_keys(m: np.ndarray, curve: tuple[np.ndarray, np.ndarray], span: np.ndarray) -> np.ndarray:
    """Hilbert keys of the rows of ``m``; ``span`` (low, high) bounds each projection, and the
    shift moves the curve's cube by up to half its side."""
    directions, shift = curve
    y = (m @ directions - span[0]) / np.maximum(span[1] - span[0], 1e-300)
    side = 1 << BITS
    return hilbert_keys(np.clip(((y + shift) / 2 * side), 0, side - 1).astype(np.int64), BITS)


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact score of row pairs: a fixed order of summation, whatever block they come in."""
    return (q * x).sum(axis=1)


def _near_rows(q: np.ndarray, x: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query the rows of ``x`` that may be among its k best; rounding of the block product
    cannot lose one."""
    s = q @ x.T
    if x.shape[0] <= k:
        return [np.arange(x.shape[0])] * len(q)
    floor = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    slack = 1e-9 * (1 + np.abs(s).max(axis=1))
    return [np.flatnonzero(s[i] >= floor[i] - slack[i]) for i in range(len(q))]


class _Lists:
    """The k best candidates per query (greatest score, then smallest id), handed on when many
    queries are held."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def add(self, query: int, x: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if query in self.held:
            x, first = np.unique(np.r_[self.held[query][0], x], return_index=True)
            ids = np.r_[self.held[query][1], ids][first]
            scores = np.r_[self.held[query][2], scores][first]
        o = np.lexsort((x, ids, -scores))[:self.k]
        self.held[query] = x[o], ids[o], scores[o]

    def flush(self, more_than: int = 0) -> Iterator[pa.RecordBatch]:
        """One row per query, its list packed."""
        if len(self.held) > more_than:
            lists = list(self.held.values())
            packed = [pa.array([a.astype(t).tobytes() for a in c], pa.binary()) for c, t in zip(zip(*lists), ("<i8", "<i8", "<f8"))]
            yield pa.RecordBatch.from_arrays([pa.array(list(self.held), pa.int64()), *packed], names=["q", "x", "x_id", "score"])
            self.held = {}


_FOUND = "q bigint, x binary, x_id binary, score binary"
_RANKED = "q bigint, rank int, x bigint, x_id bigint, score double"


def _scan(best: _Lists, q: np.ndarray, q_nodes: np.ndarray, x: np.ndarray, nodes: np.ndarray, ids: np.ndarray) -> None:
    """Offer a block of rows to a block of queries."""
    for lo in range(0, len(q), 512):
        for i, near in enumerate(_near_rows(q[lo:lo + 512], x, best.k + 1), lo):
            near = near[nodes[near] != q_nodes[i]]
            if len(near):
                best.add(int(q_nodes[i]), nodes[near], ids[near], inner_products(q[i][None, :], x[near]))


def _merge(found: DataFrame, k: int) -> DataFrame:
    """(q, rank, x, x_id, score): the k best of each query over the lists of all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, last = _Lists(k), None
        for b in batches:
            for q, *packed in zip(*(c.to_pylist() for c in b.columns)):
                if q != last:
                    yield from _ranked(best)
                last = q
                best.add(q, *(unpack(c, t) for c, t in zip(packed, ("<i8", "<i8", "<f8"))))
        yield from _ranked(best)

    return found.repartition("q").sortWithinPartitions("q").mapInArrow(run, _RANKED)


def _ranked(best: _Lists) -> Iterator[pa.RecordBatch]:
    for q, cols in best.held.items():
        n = len(cols[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, q, np.int64)), pa.array(np.arange(1, n + 1, dtype=np.int32)),
                                          *map(pa.array, cols)], names=["q", "rank", "x", "x_id", "score"])
    best.held = {}


def brute_force(rows: DataFrame, queries: np.ndarray, nodes: np.ndarray, dims: int, k: int) -> DataFrame:
    """(q, x, score): the k best rows (node, vec) of every query, each partition on its own first.
    The queries, a bounded set, travel to the rows."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Lists(k)
        for b in batches:
            for lo in range(0, b.num_rows, _BLOCK):
                part = b.slice(lo, _BLOCK)
                node = part.column(0).to_numpy()
                _scan(best, *shared.value, as_matrix(part.column(1), dims), node, node)
        yield from best.flush()

    return _merge(rows.select("node", "vec").mapInArrow(run, _FOUND), k).select("q", "x", "score")


def nearest(df: DataFrame, k: int = 20, query_every: int = 20, target_recall: float = TARGET_RECALL,
            sample_queries: int = SAMPLE_QUERIES, seed: int = 3, id_col: str = "vec_id",
            vec_col: str = "embedding", dims: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by ``query_every`` its
    ``k`` nearest rows found, by inner product in double precision.

    Vectors that are null, zero, of another length than ``dims``, or hold null or non-finite
    components take no part, nor do rows with a null id.  Ties go to the smaller id.  A repeated
    id is a row of its own (a repeated query id is searched for each of its rows, and finds the
    others).  Fewer candidates than ``k``: all of them.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    ok = F.col(id_col).isNotNull() & valid_vector(F.col(vec_col), dims)
    kind = element_type(df, vec_col)
    rows = staged(df.where(ok).select(F.monotonically_increasing_id().alias("node"), F.col(id_col).cast("bigint").alias("vec_id"),
                                      F.col(vec_col).cast(f"array<{kind}>").alias("vec")), "ann-rows")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    curves = _curves(dims, seed)
    spans = _spans(rows, curves, dims)
    plan = measure(rows.where(F.col("vec_id") % query_every == 0), rows, curves, spans, n, dims, k, sample_queries, target_recall)
    tiles = ordered_tiles(rows, curves[:plan.orderings], spans, dims, plan.tile, kind)
    found = staged(_merge(_search(tiles, plan, dims, k, query_every, _PACKED[kind]), k), "ann-found")
    return (found.hint("merge").join(rows.select(F.col("node").alias("q"), F.col("vec_id").alias("query_id")), "q")
            .select("query_id", "rank", F.col("x_id").alias("vec_id"), "score"))


_PACKED = {"float": "<f4", "double": "<f8"}


def ordered_tiles(rows: DataFrame, curves: list, spans: list[np.ndarray], dims: int, tile: int, kind: str | None) -> DataFrame:
    """The rows of every ordering in curve order, packed into tiles: curve, start (rank of the first
    row), n, nodes, and with a ``kind`` of vector components ids and vecs."""
    shared = rows.sparkSession.sparkContext.broadcast((curves, spans))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cs, sp = shared.value
        for b in batches:
            m = as_matrix(b.column(1), dims)
            for c, curve in enumerate(cs):
                carried = [b.column(0), *([b.column(2), b.column(1)] if kind else [])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(m), c, np.int32)), pa.array(curve_keys(m, curve, sp[c])), *carried],
                    names=["curve", "key", "node", "vec_id", "vec"][:2 + len(carried)])

    more = f", vec_id bigint, vec array<{kind}>" if kind else ""
    keyed = rows.select("node", "vec", "vec_id").mapInArrow(key, "curve int, key bigint, node bigint" + more)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for curve, t in batches_by_run(batches, tile):
            packed = [t.column("node").to_numpy().astype("<i8")]
            if kind:
                packed += [t.column("vec_id").to_numpy().astype("<i8"),
                           t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(_PACKED[kind])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([curve], pa.int32()), pa.array([part], pa.int32()), pa.array([at], pa.int64()),
                 pa.array([len(packed[0])], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in packed]],
                names=["curve", "part", "seq", "n", "nodes", "ids", "vecs"][:4 + len(packed)])
            at += 1

    names = ["nodes", "ids", "vecs"] if kind else ["nodes"]
    tiles = staged(keyed.repartitionByRange("curve", "key", "node").sortWithinPartitions("curve", "key", "node").drop("key")
                   .mapInArrow(pack, "curve int, part int, seq bigint, n bigint, " + ", ".join(f"{c} binary" for c in names)), "ann-tiles")
    # ranks: rows before a partition (one row each), then those before a tile in its partition
    per_part = tiles.groupBy("curve", "part").agg(F.sum("n").alias("rows"))
    before = per_part.withColumn("before", F.coalesce(F.sum("rows").over(
        Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = tiles.select("curve", "part", "seq", F.coalesce(F.sum("n").over(
        Window.partitionBy("curve", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inside"))
    starts = staged(inside.join(before, ["curve", "part"])
                    .select("curve", "part", "seq", (F.col("before") + F.col("inside")).alias("start")), "ann-starts")
    return tiles.join(starts, ["curve", "part", "seq"]).select("curve", "start", "n", *names)


def _spans(rows: DataFrame, curves: list, dims: int) -> list[np.ndarray]:
    """Least and greatest projection of every ordering's directions: one row per partition."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(np.hstack([c[0] for c in curves]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, lo, hi = shared.value, None, None
        for b in batches:
            if b.num_rows:
                y = as_matrix(b.column(0), dims) @ d
                lo = y.min(0) if lo is None else np.minimum(lo, y.min(0))
                hi = y.max(0) if hi is None else np.maximum(hi, y.max(0))
        if lo is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lo), dtype=np.int32)), pa.array(lo), pa.array(hi)], names=["i", "lo", "hi"])

    got = (rows.select("vec").mapInArrow(run, "i int, lo double, hi double").groupBy("i")
           .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("i").collect())  # orderings x projected rows
    flat = np.array([[r.lo, r.hi] for r in got]).T
    d = curves[0][0].shape[1]
    return [flat[:, c * d:(c + 1) * d] for c in range(len(curves))]


@dataclass
class Plan:
    orderings: int       # the first of the curves are searched
    window: int          # in ranks, each way
    tile: int
    compared: float      # rows a query is compared with, expected

    @property
    def bucket(self) -> int:
        """In ranks: a query's vector is copied once for each that its window touches."""
        return int(np.clip(self.window // BUCKET, self.tile, BUCKET * self.tile))


def measure(queries: DataFrame, rows: DataFrame, curves: list, spans: list[np.ndarray], n: int, dims: int, k: int,
            sample: int, target_recall: float) -> Plan:
    """Orderings and window that meet the target share of the sampled queries' true neighbours
    with the fewest rows compared."""
    picked = queries.orderBy(F.xxhash64("vec_id", "node"), "node").limit(sample).select("node", "vec").toPandas()
    if not len(picked):
        return Plan(1, 0, TILES[0], 0.0)
    q = np.stack(picked["vec"].to_numpy()).astype(np.float64)
    nodes = picked["node"].to_numpy()
    true = staged(brute_force(rows, q, nodes, dims, k).select("q", "x"), "ann-true")
    wanted = F.broadcast(true.select(F.col("x").alias("node")).union(true.select(F.col("q").alias("node"))).distinct())  # sample x (k + 1)

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for curve, start, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                node = unpack(raw, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), curve, np.int32)), pa.array(node), pa.array(start + np.arange(len(node)))],
                    names=["curve", "node", "at"])

    order = ordered_tiles(rows, curves, spans, dims, TILES[1], None).select("curve", "start", "nodes")
    placed = staged(order.mapInArrow(ranks, "curve int, node bigint, at bigint").join(wanted, "node"), "ann-places")
    pq = placed.select("curve", F.col("node").alias("q"), F.col("at").alias("at_q"))
    px = placed.select("curve", F.col("node").alias("x"), F.col("at").alias("at_x"))
    got = true.join(pq, "q").join(px, ["curve", "x"]).select("q", "x", "curve", "at_q", "at_x").toPandas()  # sample x k x curves
    if not len(got):
        return Plan(1, 0, TILES[0], 0.0)
    got = got.sort_values(["q", "x", "curve"])
    at_q = got["at_q"].to_numpy().reshape(-1, len(curves))
    gaps = np.abs(at_q - got["at_x"].to_numpy().reshape(-1, len(curves)))
    return min((_plan(gaps[:, :m], at_q[:, :m], n, target_recall) for m in range(1, len(curves) + 1)), key=lambda p: p.compared)


def _plan(gaps: np.ndarray, at_q: np.ndarray, n: int, target_recall: float) -> Plan:
    window = int(np.ceil(np.quantile(gaps.min(1), target_recall)))
    tile = int(np.clip(window // 4, *TILES))
    seen = np.minimum(at_q + window + tile / 2, n) - np.maximum(at_q - window - tile / 2, 0)  # half a tile more either way
    return Plan(gaps.shape[1], window, tile, float(seen.sum(1).mean()))


def _search(tiles: DataFrame, plan: Plan, dims: int, k: int, query_every: int, packed: str) -> DataFrame:
    """Candidates (q, x, x_id, score) of every query from the tiles that its own windows touch."""
    window, tile, bucket = plan.window, plan.tile, plan.bucket

    def queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for curve, start, nodes, ids, vecs in zip(*(c.to_pylist() for c in b.columns)):
                at = np.flatnonzero(unpack(ids, "<i8") % query_every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([curve], pa.int32()), pa.array([start + int(at[0]) - window], pa.int64()),
                         pa.array([start + int(at[-1]) + window], pa.int64()),
                         pa.array([(start + at).astype("<i8").tobytes()], pa.binary()),
                         pa.array([unpack(nodes, "<i8")[at].tobytes()], pa.binary()),
                         pa.array([unpack(vecs, packed, dims)[at].tobytes()], pa.binary())],
                        names=["curve", "lo", "hi", "q_at", "q_nodes", "q_vecs"])

    asked = staged(tiles.select("curve", "start", "nodes", "ids", "vecs")
                   .mapInArrow(queries, "curve int, lo bigint, hi bigint, q_at binary, q_nodes binary, q_vecs binary"), "ann-queries")
    # a tile that reaches into [lo, hi] starts after lo - tile, and no tile starts before rank 0
    asked = asked.select("curve", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("lo") - tile + 1) / bucket)), F.floor(F.col("hi") / bucket)))
                         .alias("bucket"), "q_at", "q_nodes", "q_vecs")
    # Spark sizes the copies as the one row they come from, and would broadcast all of them
    met = (asked.hint("merge").join(tiles.withColumn("bucket", F.floor(F.col("start") / bucket)), ["curve", "bucket"])
           .select("q_at", "q_nodes", "q_vecs", "start", "nodes", "ids", "vecs"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Lists(k)
        for b in batches:
            for q_at, q_nodes, q_vecs, start, nodes, ids, vecs in zip(*(c.to_pylist() for c in b.columns)):
                at, nodes = unpack(q_at, "<i8"), unpack(nodes, "<i8")
                here = (at + window >= start) & (at - window < start + len(nodes))
                if here.any():
                    _scan(best, unpack(q_vecs, packed, dims)[here].astype(np.float64), unpack(q_nodes, "<i8")[here],
                          unpack(vecs, packed, dims).astype(np.float64), nodes, unpack(ids, "<i8"))
                yield from best.flush(_HEAD)
        yield from best.flush()

    return met.mapInArrow(search, _FOUND)
