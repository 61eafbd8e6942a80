"""Embedding near-dedup with an inverted multi-index.

Each half of the unit vectors has a codebook of its own; a vector belongs to the cell of the
product grid that its halves' nearest codewords name.  A vector's multi-sequence walks the
cells from the nearest outward, ordered by the lower bound on the squared distance from the
vector to anything in the cell.  The walk ends at the bound within which the target share of
partners lies.  It is the largest of three measures on a bounded sample: partners at exactly the
threshold, the furthest there are, in random directions; the same in the directions in which the
sample's own vectors differ; and the partners that the sample's vectors have among each other.

Bitwise equal vectors are folded into one row with a count first.  Visits carry a vector's number
and 128 signs of random projections, not the vector.  A cell's members and its visitors are packed
into tiles, so a crowded cell spreads over many tile pairs.  A pair of tiles names the rows whose
signs differ little enough for a partner somewhere in the other tile; the share of partners lost
there depends on the angle alone and is below 1e-7.  Only these rows' vectors are fetched, and the
pair is verified by cosine in double precision.  It hands on counts of links per vector and a
spanning forest, never the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged
from ._vectors import as_matrix, batches_by_run, element_type, unit, unpack, valid_vector
from .components import connected_components, local_forest

THRESHOLD = 0.95
TARGET_RECALL = 0.99999
SAMPLE = 4096            # bound on the vectors that codebooks and the walk's end are fitted on
ROWS_PER_CELL = 1024
MAX_CODEWORDS = 1024
_PREFIX = (1, 2, 4, 8, 16)  # nearest codewords averaged for the lower bounds
_PARTNERS = 4            # simulated partners per sampled vector
TILE = 512
SIGNS = 128              # random projections whose signs travel with a visit
LOST_BY_SIGNS = 1e-7     # share of partners at exactly the threshold whose signs differ too much


@dataclass
class Grid:
    books: tuple[np.ndarray, np.ndarray]
    reach: float          # squared lower bound at which the walk ends
    planes: np.ndarray    # directions of the signs
    differ: int           # signs of partners that may differ

    @property
    def width(self) -> int:
        return len(self.books[1])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def kmeans(a: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = a[rng.choice(len(a), k, replace=False)].copy()
    for _ in range(rounds):
        near = _squared(a, c).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, a)
        n = np.bincount(near, minlength=k)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(c, axis=0)


def bounds(a: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``a`` its nearest codeword, and for every codeword a lower bound on the squared
    distance from the row to that codeword's cell.

    A point of cell c is no further from c than from any codeword, so it lies beyond the plane
    between c and the mean of any few codewords; the distance to the furthest such plane counts.
    """
    d = _squared(a, book)
    order = np.argsort(d, axis=1, kind="stable")[:, :max(_PREFIX)]
    near = np.take_along_axis(d, order, axis=1)
    best = np.zeros_like(d)
    norms = (book * book).sum(1)
    for t in _PREFIX:
        if t > order.shape[1]:
            break
        mean_d = near[:, :t].mean(1)
        mean_c = book[order[:, :t]].mean(1)
        gap = np.maximum(norms[None, :] - 2 * mean_c @ book.T + (mean_c * mean_c).sum(1)[:, None], 1e-12)
        over = np.maximum(d - mean_d[:, None], 0)
        best = np.maximum(best, over * over / (4 * gap))
    return order[:, 0], best


def fit_grid(sample: np.ndarray, n_rows: int, threshold: float, target_recall: float, seed: int = 5) -> Grid:
    """Codebooks and the walk's end from a bounded sample of unit vectors."""
    half = sample.shape[1] // 2
    k = int(min(MAX_CODEWORDS, len(sample), max(1, round(math.sqrt(n_rows / ROWS_PER_CELL)))))
    books = kmeans(sample[:, :half], k, seed), kmeans(sample[:, half:], k, seed + 1)
    rng = np.random.default_rng(seed)
    q = np.repeat(sample, _PARTNERS, axis=0)
    own = sample[rng.permutation(len(q)) % len(sample)] - sample[rng.permutation(len(q)) % len(sample)]
    i, j = _sample_links(sample, threshold)
    partners = [(q, _partners(q, rng.normal(size=q.shape), threshold)), (q, _partners(q, own, threshold)), (sample[i], sample[j])]
    # a little beyond the quantile, as the sample's own extremes are uncertain; never beyond
    # 2 - 2 * threshold, within which no partner at all can be missed
    ends = [1.25 * float(np.quantile(_bound_between(a, b, books), target_recall)) + 1e-9 for a, b in partners if len(a)]
    planes = np.random.default_rng(seed + 2).normal(size=(sample.shape[1], SIGNS))
    return Grid(books, min(2 - 2 * threshold, max(ends)), planes, signs_that_differ(threshold))


def _partners(q: np.ndarray, toward: np.ndarray, threshold: float) -> np.ndarray:
    """Unit vectors at exactly the threshold from the rows of ``q``: t * q + sqrt(1 - t * t) * (the
    unit vector across q that points ``toward``); q itself where nothing is left across it."""
    z = toward - (toward * q).sum(1, keepdims=True) * q
    length = np.sqrt((z * z).sum(1, keepdims=True))
    z = np.where(length > 1e-9, z / np.maximum(length, 1e-9), 0.0)
    return unit(threshold * q + math.sqrt(1 - threshold * threshold) * z)


def _sample_links(sample: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sampled vectors at the threshold or nearer, at most 64 of a vector's."""
    found_i, found_j = [np.empty(0, int)], [np.empty(0, int)]
    for lo in range(0, len(sample), 512):
        near = sample[lo:lo + 512] @ sample.T >= threshold
        near[np.arange(len(near)), lo + np.arange(len(near))] = False
        near &= near.cumsum(1) <= 64
        i, j = np.nonzero(near)
        found_i.append(lo + i)
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def _bound_between(q: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The walk's bound, from each row of ``q``, of the cell that holds the same row of ``x``."""
    half = books[0].shape[1]
    total = np.zeros(len(q))
    for book, cols in ((books[0], slice(None, half)), (books[1], slice(half, None))):
        for lo in range(0, len(q), 2048):
            own = _squared(x[lo:lo + 2048, cols], book).argmin(1)
            total[lo:lo + 2048] += bounds(q[lo:lo + 2048, cols], book)[1][np.arange(len(own)), own]
    return total


def signs_that_differ(threshold: float, lost: float = LOST_BY_SIGNS, signs: int = SIGNS) -> int:
    """The most signs that may differ: vectors at the threshold exceed it in less than ``lost`` of
    cases.  A random plane parts two vectors with probability angle / pi, whatever the data."""
    p = math.acos(threshold) / math.pi
    below = 0.0
    for k in range(signs + 1):
        below += math.comb(signs, k) * p**k * (1 - p)**(signs - k)
        if 1 - below < lost:
            return k
    return signs


def sign_words(a: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Signs of every row's projections, packed in 64-bit words."""
    return np.packbits(a @ planes > 0, axis=1).view("<i8")


def walk(a: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own cell of every unit vector, and the visits (row, cell) of its multi-sequence, nearest
    first, to cells numbered from its own upward: of two vectors in different cells the one in
    the lower cell visits."""
    half = grid.books[0].shape[1]
    own1, b1 = bounds(a[:, :half], grid.books[0])
    own2, b2 = bounds(a[:, half:], grid.books[1])
    own = own1.astype(np.int64) * grid.width + own2
    rows, cells = [], []
    for i in range(len(a)):
        o1, o2 = np.argsort(b1[i], kind="stable"), np.argsort(b2[i], kind="stable")
        s1, s2 = b1[i][o1], b2[i][o2]
        reach2 = np.searchsorted(s2, grid.reach - s1, side="right")  # how far along half 2 for each step of half 1
        found = np.concatenate([o1[j] * grid.width + o2[:m] for j, m in enumerate(reach2.tolist()) if m] or [np.empty(0, int)])
        found = found[found > own[i]]
        rows.append(np.full(len(found), i))
        cells.append(found)
    return own, np.concatenate(rows) if rows else np.empty(0, int), np.concatenate(cells) if cells else np.empty(0, int)


_WORDS = SIGNS // 64


def _vector_links(reps: DataFrame, grid: Grid, dims: int, threshold: float) -> DataFrame:
    """``reps`` (node, copies, vec) -> rows (node, links, u, v): counts of linked vectors to add up
    per node, and edges of a spanning forest."""
    asked = staged(_tile_pairs(reps, grid, dims), "imi-asked")
    fetched = (asked.mapInArrow(_rows_asked, "pair bigint, side int, node bigint").join(reps.select("node", "copies", "vec"), "node")
               .select("pair", "side", "node", "copies", "vec"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in batches_by_run(batches, 2 * TILE):      # a pair's rows: two tiles at most
            t = t.combine_chunks()
            first = int(np.searchsorted(t.column("side").to_numpy(), 1))
            cols = [t.column("node").to_numpy(), t.column("copies").to_numpy(), unit(as_matrix(t.column("vec").combine_chunks(), dims))]
            yield from _verified(*(c[:first] for c in cols), *(c[first:] for c in cols), threshold)

    return (fetched.repartition("pair").sortWithinPartitions("pair", "side", "node")
            .mapInArrow(verify, "node bigint, links bigint, u bigint, v bigint"))


def _tile_pairs(reps: DataFrame, grid: Grid, dims: int) -> DataFrame:
    """(pair, a, b): for every pair of tiles that may hold partners the numbers of the rows that may
    have one, packed; without b for a tile with itself."""
    shared = reps.sparkSession.sparkContext.broadcast(grid)  # codebooks of bounded size

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                u = unit(as_matrix(part.column(1), dims))
                own, rows, cells = walk(u, g)
                words = sign_words(u, g.planes)
                at = np.r_[np.arange(len(own)), rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[own * 2 + 1, cells * 2]), part.column(0).take(pa.array(at)),
                     *[pa.array(np.ascontiguousarray(words[at, w])) for w in range(_WORDS)]],
                    names=["seat", "node", *[f"s{w}" for w in range(_WORDS)]])

    signs = ", ".join(f"s{w} bigint" for w in range(_WORDS))
    # sorted by seat (twice the cell, and one more for its members): tiles hold one cell's members or its visitors
    seats = reps.select("node", "vec").mapInArrow(visit, "seat bigint, node bigint, " + signs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, t in batches_by_run(batches, TILE):
            node = t.column("node").to_numpy()
            words = np.column_stack([t.column(f"s{w}").to_numpy() for w in range(_WORDS)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([key >> 1], pa.int64()), pa.array([bool(key & 1)]), pa.array([int(node[0])], pa.int64()),
                 pa.array([node.astype("<i8").tobytes()], pa.binary()), pa.array([words.astype("<i8").tobytes()], pa.binary())],
                names=["cell", "member", "first", "nodes", "signs"])

    tiles = staged(seats.repartitionByRange("seat", "node").sortWithinPartitions("seat", "node")
                   .mapInArrow(pack, "cell bigint, member boolean, first bigint, nodes binary, signs binary"), "imi-tiles")
    a = tiles.select("cell", F.col("member").alias("member_a"), F.col("first").alias("first_a"),
                     *[F.col(c).alias(f"{c}_a") for c in ("nodes", "signs")])
    b = tiles.where("member").select("cell", F.col("first").alias("first_b"), *[F.col(c).alias(f"{c}_b") for c in ("nodes", "signs")])
    pairs = (a.join(b, "cell").where("not member_a or first_a <= first_b")
             .select(F.expr("member_a and first_a = first_b").alias("own"), "nodes_a", "signs_a", "nodes_b", "signs_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ, pair = shared.value.differ, TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for own, na, sa, nb, sb in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = (np.frombuffer(raw, "<u8").reshape(-1, _WORDS) for raw in (sa, sb))
                near = sum(np.bitwise_count(x[:, None, w] ^ y[None, :, w]).astype(np.uint16) for w in range(_WORDS)) <= differ
                if own:
                    np.fill_diagonal(near, False)
                if near.any():
                    rows_b = b"" if own else np.frombuffer(nb, "<i8")[near.any(0)].tobytes()
                    out.append((pair, np.frombuffer(na, "<i8")[near.any(1)].tobytes(), rows_b))
                    pair += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["pair", "a", "b"])

    return pairs.mapInArrow(compare, "pair bigint, a binary, b binary")


def _rows_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per row of a pair of tiles: side 0 of the first tile, 1 of the second."""
    for batch in batches:
        for pair, *sides in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = (unpack(raw, "<i8") for raw in sides)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a) + len(b), pair)), pa.array(np.repeat(np.array([0, 1], np.int32), (len(a), len(b)))),
                 pa.array(np.r_[a, b])], names=["pair", "side", "node"])


def _verified(na: np.ndarray, ca: np.ndarray, a: np.ndarray, nb: np.ndarray, cb: np.ndarray, b: np.ndarray,
              threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between two tiles' unit vectors, or inside the first where the second is empty."""
    own = not len(nb)
    if own:
        nb, cb, b = na, ca, a
    near = a @ b.T >= threshold
    if own:
        np.fill_diagonal(near, False)
    i, j = np.nonzero(near)
    if not len(i):
        return
    add_a, add_b = near @ cb, near.T @ ca
    if own:
        both, node, root = na, *local_forest(len(na), i, j)
        linked, links = na[add_a > 0], add_a[add_a > 0]
    else:
        both = np.concatenate([na, nb])
        node, root = local_forest(len(both), i, j + len(na))
        linked = np.concatenate([na[add_a > 0], nb[add_b > 0]])
        links = np.concatenate([add_a[add_a > 0], add_b[add_b > 0]])
    n, e = len(linked), len(node)
    yield pa.RecordBatch.from_arrays(
        [pa.concat_arrays([pa.array(linked, pa.int64()), pa.nulls(e, pa.int64())]),
         pa.concat_arrays([pa.array(links, pa.int64()), pa.nulls(e, pa.int64())]),
         pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(both[node], pa.int64())]),
         pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(both[root], pa.int64())])],
        names=["node", "links", "u", "v"])


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
                    id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly), component_id (the
    smallest id reachable, its own included), kept (vec_id = component_id).

    Vectors that are null, zero, of another length than ``dims``, or hold null or non-finite
    components link with nothing: no links, their own component.  Rows with equal vectors link
    with each other.  Repeated ids are rows of their own; a null id counts as a member and is
    its component's id only where all ids are null (kept is then null).  An empty table gives
    an empty result; other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"),
                     F.when(valid_vector(F.col(vec_col), dims), F.col(vec_col).cast(f"array<{element_type(df, vec_col)}>")).alias("vec"))
    folded = rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    reps = staged(folded.select(F.monotonically_increasing_id().alias("node"), "first_id", "copies", "vec"), "imi-vectors")
    n = reps.count()
    picked = reps.orderBy(F.xxhash64("vec"), "node").limit(SAMPLE).select("vec").toPandas()["vec"]
    if n:
        grid = fit_grid(unit(np.stack(picked.to_numpy()).astype(np.float64)), n, threshold, target_recall)
        found = staged(_vector_links(reps, grid, dims, threshold), "imi-links")
    else:
        found = staged(df.sparkSession.createDataFrame([], "node bigint, links bigint, u bigint, v bigint"), "imi-links")
    links = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("u is not null").select("u", "v"))
    full = staged(reps.select("node", "first_id", "copies")
                  .join(links, "node", "left").join(comp, "node", "left")
                  .select("node", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("root", "node").alias("root")), "imi-nodes")
    least = full.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(reps.select("node", "vec").join(full.join(least, "root").select("node", "n_links", "component_id"), "node")
                   .select("vec", "n_links", "component_id"), "imi-named")
    out = rows.join(named, "vec", "left")
    component = F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      (F.col("vec_id") == component).alias("kept"))
