"""Best-fit packing of tokenized documents into fixed-length sequences.

Bounded-space online best-fit: a task keeps a fixed number of open bins, indexed by their free
space in one integer used as a bitset.  A piece goes to the open bin with the least free space
that still holds it; the lowest set bit at or above the piece's length finds it.  When a new
bin would exceed the number of open bins, the fullest one closes first.

Tokenizing and packing happen in one pass over each partition, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 4096
OPEN_BINS = 4096
_CACHE_WORDS = 400_000   # bound on remembered words of one Python worker
_BATCH_CHARS = 1 << 20
# Texts of these characters only take the short way: their letters have one-letter lower case
# and are composed, so the vocabulary's own normalizing and splitting come down to lower() and
# the split pattern below (fixed value: the vocabulary file's pattern, for these letters).
_OTHER = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]|<\|")
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class WordTokenizer:
    """Token ids of whole texts as little-endian uint32 bytes, remembering pieces already met.

    The vocabulary splits a text into pieces (runs of letters, digits, signs) and merges inside
    a piece only, so a text's ids are those of its pieces.  New runs of letters are encoded
    together, separated by spaces, and cut at the tokens that end a piece.  Texts with other
    characters are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for t, i in vocab.items():
            self.ends[i] = t.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, new: list[str]) -> None:
        letters = [p for p in new if p.isalpha()]
        for p in new:
            if not p.isalpha():
                self.known[p] = self._encode(p).tobytes()
        for i in range(0, len(letters), 1024):
            some = letters[i:i + 1024]
            a = self._encode(" ".join(some))
            cuts = ((np.flatnonzero(self.ends[a]) + 1) * 4).tolist()
            if len(cuts) != len(some):
                raise ValueError("the vocabulary does not end every word with a token of its own")
            raw = a.tobytes()
            self.known.update(zip(some, [raw[lo:hi] for lo, hi in zip([0, *cuts], cuts)]))

    def ids(self, texts: list[str]) -> list[bytes]:
        known = self.known
        plain = [None if _OTHER.search(t) else _SPLIT.findall(t.lower()) for t in texts]
        room = max(0, _CACHE_WORDS - len(known))
        new = list(set().union(*filter(None, plain)).difference(known))
        if new:
            self._learn(new)
        out = [self._encode(t).tobytes() if p is None else b"".join(map(known.__getitem__, p)) for t, p in zip(texts, plain)]
        for p in new[room:]:
            del known[p]
        return out


class BestFit:
    """Open bins by free space; ``place`` gives the bin and the offset of a piece."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits = 0                               # bit f is set: some open bin has f tokens free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0
        self.next_bin = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + ((fits & -fits).bit_length() - 1)
            at = self._take(free)
        else:
            if length < self.capacity and self.n_open >= self.open_bins:
                fullest = (self.bits & -self.bits).bit_length() - 1
                self._take(fullest)                 # closed: its free space stays unused
            at, free = self.next_bin, self.capacity
            self.next_bin += 1
        left = free - length
        if left:
            self.bins[left].append(at)
            self.bits |= 1 << left
            self.n_open += 1
        return at, self.capacity - free

    def _take(self, free: int) -> int:
        at = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return at


_WORKER: dict[str, WordTokenizer] = {}  # one per Python worker and vocabulary


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _WORKER:
        _WORKER[path] = WordTokenizer(path)
    return _WORKER[path]


PACKED = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "sequence_id bigint, offset bigint")


def pack_documents(df: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = 1,
                   open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and ids, array<int>, if asked for).

    A document is its token ids and ``end_id``; only longer ones are cut, into pieces of
    ``max_tokens``, the last one shorter.  A null or empty text is ``end_id`` alone.  Null and
    repeated ids are packed row by row.  Pieces of one Arrow batch are placed longest first.
    sequence_id is the partition's number and the bin's; every partition packs its own rows.
    """
    schema = PACKED + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, fit = _tokenizer(tokenizer_path), BestFit(max_tokens, open_bins)
        first = TaskContext.get().partitionId() << 36
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1)
            rows = []
            lo = 0
            while lo < len(doc_ids):
                some, size, hi = [], 0, lo
                while hi < len(doc_ids) and size < _BATCH_CHARS:
                    some.append(texts[hi].as_py() or "")
                    size += len(some[-1])
                    hi += 1
                for d, raw in zip(doc_ids[lo:hi], tok.ids(some)):
                    raw += end
                    for p, at in enumerate(range(0, len(raw), 4 * max_tokens)):
                        part = raw[at:at + 4 * max_tokens]
                        rows.append((d, p, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                lo = hi
            rows.sort(key=lambda r: -r[3])
            placed = [fit.place(r[3]) for r in rows]
            cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4] for r in rows], pa.int64()),
                    pa.array([first + q for q, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            if with_ids:
                cols.append(pa.array([np.frombuffer(r[5], "<i4") for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=[c.strip().split()[0] for c in schema.split(",")])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
