"""Conversation prefix trie from padded turn-id matrices.

A turn's id is the MD5 of its role and text.  Conversations become rows of turn ids, Spark
range-partitions and sorts them, and each shard is read in tiles of bounded size: a matrix of
dense turn ids, padded to the longest row.  numpy's lexsort orders a tile; the mask of columns
that change from one row to the next, OR-accumulated along the row, marks where a node starts
at every depth; reduceat aggregates all nodes of a depth at once.  Nodes on the path of a
tile's first or last row may go on in the next tile: those leave as additive parts keyed by the
digest of their prefix and are summed over the shards, with what two neighbouring tiles
counted twice taken off.

A turn (at its place) that only one conversation has ends what that conversation shares, so a
path stops there and the rest of it, a chain of nodes with one member, is emitted from the
turns themselves.  A conversation without copies is thus never gathered, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

CELLS = 1 << 20       # cells of a tile's padded matrix, unless one row alone has more
NODE, PART, ENDS, EDGE, OWNER = range(5)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# what a tile hands on: one layout for nodes, parts of nodes, lists of ends, shard edges and chain owners
_FIELDS = [("kind", pa.int32(), "int"), ("conv_id", pa.int64(), "bigint"), ("depth", pa.int64(), "bigint"),
           ("parent_conv_id", pa.int64(), "bigint"), ("digest", pa.binary(), "binary"),
           ("parent_digest", pa.binary(), "binary"), ("n_convs", pa.int64(), "bigint"),
           ("n_children", pa.int64(), "bigint"), ("n_leaves", pa.int64(), "bigint"),
           ("member_bytes", pa.int64(), "bigint"), ("node_bytes", pa.int64(), "bigint"),
           ("ends", pa.binary(), "binary"), ("shard", pa.int64(), "bigint"),
           ("path", pa.binary(), "binary"), ("last_path", pa.binary(), "binary"),
           ("sizes", pa.binary(), "binary"), ("last_tail", pa.bool_(), "boolean")]
_SCHEMA = pa.schema([(n, t) for n, t, _ in _FIELDS])
_DDL = ", ".join(f"{n} {t}" for n, _, t in _FIELDS)


# ---------------------------------------------------------------- turns

def turn_table(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn_id, n_bytes): every turn with its place from 1 in its conversation,
    ordered by turn (null first), ties by turn id.  Rows without a conversation take no part.

    A conversation may hold any share of the rows: the rows are range-partitioned by the whole
    order, numbered within each part, and moved on by what the parts before hold."""
    role, text = F.coalesce(df[role_col].cast("string"), F.lit("")), F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = df.select(df[conv_col].cast("bigint").alias("conv_id"), df[turn_col].alias("turn"),
                     F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("turn_id"),
                     F.octet_length(text).cast("bigint").alias("n_bytes")).where("conv_id is not null")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id")]
    parts = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "trie-turns")
    counts = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "turn_id")
    numbered = parts.withColumn("k", F.row_number().over(local)).join(offsets, ["conv_id", "part"])
    return numbered.select("conv_id", (F.col("k") + F.col("before")).alias("pos"), "turn_id", "n_bytes")


def rebuild(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversation c gets the first h turns of conversation c - c % group in place of its own
    first h, h = crc32(c in decimal) % heads.  -> (turns, conversations (conv_id, n)); a
    conversation without any turn left keeps its row.  % truncates, as in SQL."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = staged(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", "own", F.least("h", F.coalesce("base_own", F.lit(0))).alias("given")), "trie-convs")
    kept = turns.join(convs.select("conv_id", "h", "given"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn_id", "n_bytes")
    first = turns.where(F.col("pos") < heads).where(F.col("conv_id") % group == 0).withColumnRenamed("conv_id", "base")
    given = first.join(convs.select("conv_id", "base", "h"), "base").where("pos <= h").select(
        "conv_id", "pos", "turn_id", "n_bytes")
    sizes = convs.select("conv_id", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return staged(kept.unionByName(given), "trie-rebuilt"), sizes


# ---------------------------------------------------------------- tiles

def _dense(paths: list[bytes], lens: np.ndarray) -> np.ndarray:
    """Matrix of the turn ids' ranks, -1 beyond a row's end."""
    raw = np.frombuffer(b"".join(paths), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    by = np.lexsort((raw[:, 1], raw[:, 0]))
    new = np.ones(len(raw), dtype=bool)
    new[1:] = (raw[by[1:]] != raw[by[:-1]]).any(axis=1)
    rank = np.empty(len(raw), dtype=np.int64)
    rank[by] = np.cumsum(new) - 1
    m = np.full((len(paths), int(lens.max(initial=0))), -1, dtype=np.int64)
    m[np.arange(m.shape[1]) < lens[:, None]] = rank
    return m


def _prefix_digests(path: bytes) -> list[bytes]:
    """Digest of every prefix of a path, from the empty one on."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for at in range(0, len(path), 16):
        h.update(path[at:at + 16])
        out.append(h.copy().digest())
    return out


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    n = min(len(a), len(b)) // 16
    x, y = (np.frombuffer(p[:16 * n], dtype=np.uint64).reshape(-1, 2) for p in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _row(**values) -> dict:
    return {n: None for n, _, _ in _FIELDS} | values


def _joint(last_path: bytes, last_tail: bool, path: bytes, sizes: np.ndarray) -> list[dict]:
    """What two neighbouring tiles count twice, as negative parts: nodes of the latter's first row
    that began before it, and a leaf at the former's end that goes on."""
    shared = _shared(last_path, path)
    leaf = int(len(last_path) == 16 * shared and not last_tail)
    if not shared and not leaf:
        return []
    digests = _prefix_digests(path[:16 * shared])
    left = np.r_[0, np.cumsum(sizes[:shared][::-1])][::-1]   # bytes from each depth's turn on
    return [_row(kind=PART, depth=d, digest=digests[d], parent_digest=digests[d - 1] if d else None, n_convs=0,
                 n_children=-int(d < shared), n_leaves=-leaf, member_bytes=0, node_bytes=-int(left[max(d, 1) - 1]))
            for d in range(shared + 1)]


def tile_nodes(conv: np.ndarray, paths: list[bytes], sizes: list[np.ndarray], tail: np.ndarray) -> tuple[dict, list[dict], tuple]:
    """All nodes of one tile: (columns of whole nodes, rows of parts, ends and owners, first and last row)."""
    lens = np.fromiter((len(p) // 16 for p in paths), np.int64, len(paths))
    m = _dense(paths, lens)
    by = np.lexsort((conv, tail, *m.T[::-1]))
    m, conv, tail, lens = m[by], conv[by], tail[by], lens[by]
    n, width = m.shape
    first, last = paths[by[0]], paths[by[-1]]
    size = np.zeros((n, width), dtype=np.int64)
    size[np.arange(width) < lens[:, None]] = np.concatenate([sizes[i] for i in by]) if width else []
    change = np.ones((n, width), dtype=bool)
    change[1:] = np.logical_or.accumulate(m[1:] != m[:-1], axis=1)
    start = change & (m >= 0)
    suffix = lambda a: np.cumsum(a[:, ::-1], axis=1)[:, ::-1]
    below, own = suffix(size), suffix(size * start)
    ends_here = np.ones(n, dtype=bool)               # the next row leaves this row's whole path
    if n > 1:
        ends_here[:-1] = (lens[:-1] > 0) & change[1:][np.arange(n - 1), np.maximum(lens[:-1] - 1, 0)] if width else False
    leaf = (tail | ends_here).astype(np.int64)

    head, foot = _prefix_digests(first), _prefix_digests(last)
    whole: list[dict] = []
    out: list[dict] = []
    parent_of = np.zeros(n, dtype=np.int64)          # each row's node one depth up: its place in whole, or -1 - (0: head, 1: foot)
    owner = np.zeros(n, dtype=np.int64)
    for d in range(width + 1):
        if d:
            s = np.flatnonzero(change[:, d - 1])
            e = np.r_[s[1:], n]
            real = m[s, d - 1] >= 0
        else:
            s, e, real = np.array([0]), np.array([n]), np.array([True])
        if not real.any():
            break
        kids = start[:, d].astype(np.int64) if d < width else np.zeros(n, dtype=np.int64)
        stops = lens == d
        kids = kids + (stops & tail)
        cols = {"conv_id": np.minimum.reduceat(conv, s), "n_convs": e - s, "n_children": np.add.reduceat(kids, s),
                "n_leaves": np.add.reduceat(leaf, s),
                "member_bytes": np.add.reduceat(below[:, max(d, 1) - 1], s) if width else np.zeros(len(s), np.int64),
                "node_bytes": np.add.reduceat(own[:, max(d, 1) - 1], s) if width else np.zeros(len(s), np.int64),
                "n_ends": np.add.reduceat((stops & ~tail).astype(np.int64), s)}
        at_head, at_foot = s == 0, e == n
        inner = real & ~at_head & ~at_foot
        node = np.where(at_head, -1, np.where(at_foot, -2, -3))
        node[inner] = np.arange(inner.sum())
        for j in np.flatnonzero(real & (at_head | at_foot)).tolist():
            digests = head if at_head[j] else foot
            out.append(_row(kind=PART, depth=d, digest=digests[d], parent_digest=digests[d - 1] if d else None,
                            **{c: int(cols[c][j]) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes")}))
            if k := cols["n_ends"][j]:
                out.append(_row(kind=ENDS, digest=digests[d], conv_id=int(conv[s[j]]), ends=_decimals(conv[s[j]:s[j] + k])))
        up = parent_of[s[inner]]
        sha = [_EMPTY_SHA] * len(up)
        for i, (a, k) in enumerate(zip(s[inner].tolist(), cols["n_ends"][inner].tolist())):
            if k:
                sha[i] = hashlib.sha256(_decimals(conv[a:a + k])).hexdigest()
        whole.append({c: v[inner] for c, v in cols.items()} | {
            "depth": np.full(len(up), d), "sha": sha,
            "parent_conv_id": np.where(up >= 0, whole[-1]["conv_id"][np.maximum(up, 0)], 0) if d and len(whole[-1]["conv_id"]) else np.zeros(len(up), np.int64),
            "known": up >= 0, "parent_digest": [None if u >= 0 else (head if u == -1 else foot)[d - 1] for u in up.tolist()] if d else []})
        row_node = np.repeat(node, e - s)
        owner = np.where(stops, row_node, owner)
        for i in np.flatnonzero(stops & tail).tolist():
            u = row_node[i]
            out.append(_row(kind=OWNER, conv_id=int(conv[i]), parent_conv_id=int(whole[-1]["conv_id"][u]) if u >= 0 else None,
                            parent_digest=None if u >= 0 else (head if u == -1 else foot)[d]))
        parent_of = row_node
    return _joined(whole), out, (first, sizes[by[0]], last, bool(tail[-1]))


def _joined(parts: list[dict]) -> dict:
    return {c: np.concatenate([p[c] for p in parts]) if isinstance(parts[0][c], np.ndarray) else [x for p in parts for x in p[c]]
            for c in parts[0]}


def _decimals(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _node_batch(t: dict) -> pa.RecordBatch:
    n = len(t["conv_id"])
    null = {name: pa.nulls(n, kind) for name, kind, _ in _FIELDS}
    null |= {"kind": pa.array(np.full(n, NODE, np.int32)), "ends": pa.array([s.encode() for s in t["sha"]], pa.binary()),
             "parent_conv_id": pa.array(t["parent_conv_id"], mask=~t["known"].astype(bool)),
             "parent_digest": pa.array(t["parent_digest"], pa.binary())}
    null |= {c: pa.array(t[c].astype(np.int64)) for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes")}
    return pa.RecordBatch.from_arrays([null[name] for name, _, _ in _FIELDS], schema=_SCHEMA)


def _tiles(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple]:
    """Runs of the sorted rows whose padded matrix stays within ``cells``."""
    conv, paths, sizes, tail, width = [], [], [], [], 0
    for b in batches:
        ids, cut = b.column(0).to_pylist(), b.column(3).to_pylist()
        for i, c in enumerate(ids):
            path = b"".join(b.column(1)[i].as_py())
            w = max(width, len(path) // 16, 1)
            if conv and (len(conv) + 1) * w > cells:
                yield np.array(conv, dtype=np.int64), paths, sizes, np.array(tail, dtype=bool)
                conv, paths, sizes, tail, w = [], [], [], [], max(len(path) // 16, 1)
            width = w
            conv.append(c)
            paths.append(path)
            sizes.append(b.column(2)[i].values.to_numpy())
            tail.append(cut[i])
    if conv:
        yield np.array(conv, dtype=np.int64), paths, sizes, np.array(tail, dtype=bool)


def _run_tiles(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, edge, before = TaskContext.get().partitionId(), None, None
        for tile in _tiles(batches, cells):
            nodes, rows, (first, sizes, last, tail) = tile_nodes(*tile)
            if before:
                rows += _joint(*before, first, sizes)
            edge = edge or (first, sizes.astype("<i8").tobytes())
            before = (last, tail)
            if len(nodes["conv_id"]):
                yield _node_batch(nodes)
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
        if edge:
            yield pa.RecordBatch.from_pylist([_row(kind=EDGE, shard=shard, path=edge[0], sizes=edge[1], last_path=before[0],
                                                   last_tail=before[1])], schema=_SCHEMA)
    return run


def _run_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [r for path, sizes, last, tail in zip(*(b.column(i).to_pylist() for i in range(4)))
                for r in _joint(last, tail, path, np.frombuffer(sizes, "<i8"))]
        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _run_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists of ends, which arrive in order."""
    out = pa.schema([("digest", pa.binary()), ("sha", pa.string())])
    digest, h = None, None
    for b in batches:
        done = []
        for d, part in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if d == digest:
                h.update(b"," + part)
            else:
                if h:
                    done.append({"digest": digest, "sha": h.hexdigest()})
                digest, h = d, hashlib.sha256(part)
        yield pa.RecordBatch.from_pylist(done, schema=out)
    if h:
        yield pa.RecordBatch.from_pylist([{"digest": digest, "sha": h.hexdigest()}], schema=out)


# ---------------------------------------------------------------- the trie

def prefix_trie(turns: DataFrame, convs: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 1, turn_id of 16 bytes,
    n_bytes), with ``convs`` (conv_id, n) naming every conversation, those without turns too.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) x bytes of the node's last turn) and
    ends_sha256 (of the ids that end there, ascending, joined by commas).  No conversation: no row.
    """
    alone = turns.groupBy("pos", "turn_id").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1")
    cuts = alone.groupBy("conv_id").agg(F.min("pos").alias("cut"))
    marked = staged(turns.join(cuts, "conv_id", "left").select("*", F.coalesce(F.col("pos") >= F.col("cut"), F.lit(False)).alias("alone")),
                    "trie-marked")
    paths = marked.where("not alone").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "turn_id", "n_bytes"))).alias("t"))
    chained = marked.where("alone and pos = cut").select("conv_id", F.lit(True).alias("tail"))
    rows = convs.join(paths, "conv_id", "left").join(chained, "conv_id", "left").select(
        "conv_id", F.coalesce(F.col("t")["turn_id"], F.array().cast("array<binary>")).alias("path"),
        F.coalesce(F.col("t")["n_bytes"], F.array().cast("array<bigint>")).alias("sizes"),
        F.coalesce("tail", F.lit(False)).alias("tail"))
    order = ["path", "tail", "conv_id"]
    rows = staged(rows, "trie-paths").repartitionByRange(*order).sortWithinPartitions(*order)
    made = staged(rows.mapInArrow(_run_tiles(cells), _DDL), "trie-tiles", partition_by="kind")

    edges = made.where(F.col("kind") == EDGE)
    by_shard = Window.orderBy("shard")               # one row a shard
    joints = (edges.select("path", "sizes", F.lag("last_path").over(by_shard).alias("last_path"),
                           F.lag("last_tail").over(by_shard).alias("last_tail"))
              .where("last_path is not null").mapInArrow(_run_edges, _DDL))
    parts = made.where(F.col("kind") == PART).select(*[n for n, _, _ in _FIELDS]).unionByName(joints)
    sums = parts.groupBy("digest").agg(
        F.max("depth").alias("depth"), F.max("parent_digest").alias("parent_digest"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "member_bytes", "node_bytes")])
    lists = (made.where(F.col("kind") == ENDS).select("digest", "conv_id", "ends").repartition("digest")
             .sortWithinPartitions("digest", "conv_id").mapInArrow(_run_ends, "digest binary, sha string"))
    spread = staged(sums.join(lists, "digest", "left").withColumn("sha", F.coalesce("sha", F.lit(_EMPTY_SHA))), "trie-spread")
    names = spread.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("spread_conv"))

    numbers = ["n_convs", "n_children", "n_leaves", (F.col("member_bytes") - F.col("node_bytes")).alias("saved_tokens")]
    inner = made.where(F.col("kind") == NODE).join(names, "parent_digest", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "spread_conv").alias("parent_conv_id"), *numbers,
        F.col("ends").cast("string").alias("ends_sha256"))
    outer = spread.join(names, "parent_digest", "left").select(
        "conv_id", "depth", F.col("spread_conv").alias("parent_conv_id"), *numbers, F.col("sha").alias("ends_sha256"))
    owners = made.where(F.col("kind") == OWNER).join(names, "parent_digest", "left").select(
        "conv_id", F.coalesce("parent_conv_id", "spread_conv").alias("top_parent"), F.lit(True).alias("top"))
    chain = marked.where("alone").withColumn("top", F.col("pos") == F.col("cut")).join(owners, ["conv_id", "top"], "left")
    last = convs.select("conv_id", F.col("n").alias("pos"), F.lit(True).alias("is_last"))
    chain = chain.join(last, ["conv_id", "pos"], "left")
    ended = F.coalesce("is_last", F.lit(False))
    chain = chain.select(
        "conv_id", F.col("pos").alias("depth"), F.when(F.col("top"), F.col("top_parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"), F.when(ended, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(ended, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_EMPTY_SHA).alias("ends_sha256"))
    return inner.unionByName(outer).unionByName(chain)


def conversation_trie(df: DataFrame, group: int = 5, heads: int = 9, cells: int = CELLS, conv_col: str = "conv_id",
                      turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of a conversation table whose conversations are rebuilt (see ``rebuild``).

    Null roles and texts count as empty.  Rows with a null conversation id take no part; rows that
    repeat a (conversation, turn) are turns of their own, ordered by turn id; long texts count by
    their digest and bytes; other columns are not read.  An empty table gives an empty result.
    """
    turns = staged(turn_table(df, conv_col, turn_col, role_col, text_col), "trie-numbered")
    rebuilt, convs = rebuild(turns, group, heads)
    return prefix_trie(rebuilt, convs, cells)
