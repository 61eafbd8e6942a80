"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles.

Distinct fingerprints are sorted by their cell, the population counts of the segments of the 64
bits, and packed into tiles of one cell each.  Two fingerprints within ``radius`` bits have
cells within ``radius`` of each other (sum over the segments), so a tile meets only the tiles of
such cells; every other tile pair is skipped by its population counts alone.  A met pair is
compared in full with numpy exclusive-or and bit counts, and hands on a spanning forest of its
links, not the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged
from .components import connected_components, local_forest

TILE = 1024
_BLOCK = 1 << 16     # shingles hashed at a time, so a very long text stays bounded
_CELLS = 1 << 22     # compared pairs held at a time
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of the lower-cased words' shingles (XXH64, seed 42); no words: 0."""
    words = (text or b"").lower().split()  # bytes: ASCII case and white space only
    n = max(1, len(words) - shingle + 1)
    if not words:
        return 0
    counts = np.zeros((8, 256), dtype=np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        runs = [words[lo + k:hi + k] for k in range(shingle)] if len(words) >= shingle else None
        joined = map(b" ".join, zip(*runs)) if runs else [b" ".join(words)]
        raw = np.frombuffer(b"".join([digest(s, 42) for s in joined]), dtype=np.uint8).reshape(-1, 8)
        for j in range(8):
            counts[j] += np.bincount(raw[:, j], minlength=256)
    ones = (counts @ _BITS).ravel()  # most significant bit first
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per input row, fp the fingerprint as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return (df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                      F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint"))


def _cell_digit(segments: int, radius: int) -> int:
    """Bits of a cell code's digit: a count of 0..64/segments moved by up to the radius either way."""
    return (64 // segments + 2 * radius).bit_length()


def _cell(fp, segments: int, radius: int):
    """Population counts of the segments, each in a digit of its own."""
    width, digit = 64 // segments, _cell_digit(segments, radius)
    code = F.lit(0).cast("bigint")
    for k in range(segments):
        seg = F.shiftrightunsigned(F.shiftleft(fp, 64 - width * (k + 1)), 64 - width)
        code = code + F.shiftleft((F.bit_count(seg) + radius).cast("bigint"), digit * k)
    return code


def _offsets(segments: int, radius: int) -> list[int]:
    """Differences of cell codes within the radius, one of each pair of opposites."""
    digit, out = _cell_digit(segments, radius), []
    for o in product(range(-radius, radius + 1), repeat=segments) if segments <= 4 else _sparse(segments, radius):
        if sum(map(abs, o)) <= radius and o >= (0,) * segments:
            out.append(sum(x << (digit * k) if x >= 0 else -((-x) << (digit * k)) for k, x in enumerate(o)))
    return sorted(set(out))


def _sparse(segments: int, radius: int):
    def grow(prefix, left):
        if len(prefix) == segments:
            yield tuple(prefix)
            return
        for x in range(-left, left + 1):
            yield from grow([*prefix, x], left - abs(x))
    return grow([], radius)


def fingerprint_links(fps: DataFrame, radius: int = 3, segments: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect just the distinct fingerprints (column fp) within ``radius`` bits."""
    cells = fps.select(_cell(F.col("fp"), segments, radius).alias("cell"), "fp")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        out: list[tuple[int, int, bytes]] = []
        for b in batches:
            c, f = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(c)) + 1
            for part, code in zip(np.split(f, cuts), c[np.r_[0, cuts]].tolist() if len(c) else []):
                if code != cell and held:
                    out.append(_tile(cell, held))
                    held = []
                cell = code
                for lo in range(0, len(part), tile):
                    held.append(part[lo:lo + tile])
                    if sum(map(len, held)) >= tile:
                        out.append(_tile(cell, held))
                        held = []
            if out:
                yield _tiles(out)
                out = []
        if held:
            yield _tiles([_tile(cell, held)])

    tiles = staged(cells.repartitionByRange("cell", "fp").sortWithinPartitions("cell", "fp")
                   .mapInArrow(pack, "cell bigint, first bigint, fps binary"), "simhash-tiles")
    moves = F.explode(F.array(*[F.lit(o).cast("bigint") for o in _offsets(segments, radius)]))
    left = tiles.select("cell", "first", "fps", moves.alias("move"))
    left = left.select((F.col("cell") + F.col("move")).alias("at"), F.col("cell").alias("cell_a"),
                       F.col("first").alias("first_a"), F.col("fps").alias("fps_a"))
    right = tiles.select(F.col("cell").alias("at"), F.col("first").alias("first_b"), F.col("fps").alias("fps_b"))
    pairs = left.join(right, "at").where("cell_a <> at or first_a <= first_b")
    pairs = pairs.select(F.expr("cell_a = at and first_a = first_b").alias("own"), "fps_a", "fps_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us, vs = [], []
            for own, x, y in zip(*(b.column(i).to_pylist() for i in range(3))):
                u, v = tile_forest(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), own, radius)
                us.append(u)
                vs.append(v)
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return pairs.mapInArrow(compare, "u bigint, v bigint")


def _tile(cell: int, held: list[np.ndarray]) -> tuple[int, int, bytes]:
    f = np.concatenate(held)
    return cell, int(f[0]), f.astype("<i8").tobytes()


def _tiles(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    c, f, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(f, pa.int64()), pa.array(b, pa.binary())],
                                      names=["cell", "first", "fps"])


def tile_forest(a: np.ndarray, b: np.ndarray, own: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one), as fingerprints."""
    rows = max(1, _CELLS // max(1, len(b)))
    us, vs = [], []
    for lo in range(0, len(a), rows):
        near = np.bitwise_count(a[lo:lo + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i = i + lo
        if own:
            keep = i < j
            i, j = i[keep], j[keep]
        if len(i):
            both = a if own else np.concatenate([a, b])
            node, root = local_forest(len(both), i, j if own else j + len(a))
            us.append(both[node])
            vs.append(both[root])
    empty = np.empty(0, dtype="<u8")
    return (np.concatenate(us), np.concatenate(vs)) if us else (empty, empty)


def simhash_components(df: DataFrame, radius: int = 3, shingle: int = 3, segments: int = 4,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, fp (signed bigint), root (the component's
    fingerprint that stands for it), component_id (the smallest doc_id in the component).

    Fingerprints at ``radius`` or fewer differing bits link; rows with equal fingerprints are
    linked.  Null and empty texts, and texts of white space, have fingerprint 0 and link like
    any other.  Rows with null doc_id are members; component_id is null where all ids are.
    Repeated ids keep their rows.  An empty table gives an empty result.
    """
    docs = staged(fingerprints(df, id_col, text_col, shingle), "simhash-docs")
    distinct = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    comp = connected_components(fingerprint_links(distinct.select("fp"), radius, segments))
    rooted = staged(distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(rooted.select("fp", "root").join(least, "root"), "simhash-classes")
    return docs.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def simhash_dedup(df: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row of each component, in the columns of ``df``: the one with the smallest id (null
    ids last; of rows that repeat it the one with the smallest hash of the text, then of the
    whole row but for map columns)."""
    marked = simhash_components(df, radius, shingle, id_col=id_col, text_col=text_col)
    first = marked.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")).alias("k"))
    keep = staged(first.select("k.*"), "simhash-keep")
    keys = {"simhash_no_id": keep["no_id"], "simhash_id": keep["id"], "simhash_hash": keep["text_hash"]}
    keep = keep.select(*[c.alias(k) for k, c in keys.items()])
    rows = df.withColumns({"simhash_no_id": df[id_col].isNull(),
                           "simhash_id": F.coalesce(df[id_col].cast("bigint"), F.lit(0)),
                           "simhash_hash": F.xxhash64(df[text_col])})
    whole = F.xxhash64(*[df[c] for c, t in df.dtypes if "map<" not in t])
    first_row = F.row_number().over(Window.partitionBy(*keys).orderBy(whole))   # Spark keeps one row a key before the shuffle
    return (rows.join(keep, list(keys)).withColumn("simhash_row", first_row).where("simhash_row = 1")
            .select(*[df[c] for c in df.columns]))
