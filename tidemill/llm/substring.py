"""Substring dedup by content-defined chunks.

A gear rolling hash runs over a text's bytes.  A chunk ends after white space where the hash of
the last 32 bytes falls on a cut, so the cuts depend on the content alone and an insertion
moves only the cuts around it.  Where the last 32 bytes hold no white space (Chinese, Japanese,
Thai, minified code, base64) any character may end a chunk, on a rarer cut, and words count by
their length.

What is counted corpus-wide by digest is windows: the fewest neighbouring chunks of at least
``min_words`` words from each chunk on, and up to each chunk.  A window whose digest stands in a
document before is a repeat and is removed from the later document, so all that is removed
belongs to a run of enough words that one earlier document holds as a whole; and a repeated run
goes to its last chunk at either end.  The first document keeps the passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged

MIN_BYTES, MAX_BYTES = 16, 192
CUT_BITS = 2          # one white space in 4 is a cut, then shorter chunks are joined up to MIN_BYTES
DENSE_BITS = 5        # one byte in 32 without white space before it is a cut
MIN_WORDS = 16
LONG_WORD, WORD_BYTES = 20, 8  # more bytes than that without white space are a word each 8
_WINDOW = 32
_BLOCK = 4 << 20      # bytes hashed at a time
_NO_ID = 1 << 62      # documents without an id come after all others, by the hash of their text


def _gear() -> np.ndarray:
    """256 random words from splitmix64; 0 for the byte that separates texts."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    g = (x ^ (x >> np.uint64(31))).astype(np.uint32)
    g[0] = 0
    return g


GEAR = _gear()
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte: sum of GEAR[b[i-j]] << j over the last 32 bytes, mod 2**32."""
    h = GEAR[data]
    step = 1
    while step < _WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h


def _cuts(texts: list[bytes]) -> list[list[int]]:
    """Ends of each text's chunks, in bytes."""
    pad = b"\0" * _WINDOW
    joined = pad.join(texts)
    data = np.frombuffer(joined, dtype=np.uint8)
    if not len(data):
        return [[] for _ in texts]
    h = gear_hash(data)
    spaces = np.flatnonzero(_IS_SPACE[data])
    at = spaces[h[spaces] >> np.uint32(32 - CUT_BITS) == 0] + 1
    dense = np.flatnonzero(h < np.uint32(1 << 32 - DENSE_BITS))
    dense = dense[dense - np.r_[-_WINDOW, spaces][np.searchsorted(spaces, dense, "right")] >= _WINDOW] + 1
    for _ in range(3):  # on to the character's end
        dense += (dense < len(data)) & (data[np.minimum(dense, len(data) - 1)] & 0xC0 == 0x80)
    at = np.union1d(at, dense)
    starts = np.cumsum([0] + [len(t) + _WINDOW for t in texts[:-1]])
    ends = starts + [len(t) for t in texts]
    lo, hi = np.searchsorted(at, starts, "right"), np.searchsorted(at, ends, "left")
    out = []
    for t, s, a, b in zip(texts, starts.tolist(), lo.tolist(), hi.tolist()):
        cuts, last = [], 0
        for c in [*(at[a:b] - s).tolist(), len(t)]:
            while c - last > MAX_BYTES:
                last = _soft_cut(t, last)
                cuts.append(last)
            if c - last >= MIN_BYTES or c == len(t) and c > last:
                cuts.append(c)
                last = c
        out.append(cuts)
    return out


def _soft_cut(t: bytes, start: int) -> int:
    """End of a chunk that meets no cut in MAX_BYTES: after the last space there, or at a character."""
    end = start + MAX_BYTES
    space = max(t.rfind(b" ", start + MIN_BYTES, end), t.rfind(b"\n", start + MIN_BYTES, end))
    if space >= 0:
        return space + 1
    while end > start + 1 and t[end] & 0xC0 == 0x80:
        end -= 1
    return end


def _words(piece: bytes) -> int:
    words = piece.split()
    if len(piece) <= LONG_WORD or len(max(words, key=len, default=b"")) <= LONG_WORD:
        return len(words)
    return sum(1 if len(w) <= LONG_WORD else -(-len(w) // WORD_BYTES) for w in words)


def chunk_texts(texts: list[bytes]) -> list[list[int]]:
    """Chunk ends of every text, hashed block by block."""
    out: list[list[int]] = []
    some: list[bytes] = []
    size = 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= _BLOCK:
            out += _cuts(some)
            some, size = [], 0
    return out + (_cuts(some) if some else [])


_WINDOWS = "doc bigint, text_hash bigint, digest bigint, digest_more bigint, place bigint"
_DIGEST = ["digest", "digest_more"]
_LEN_BITS = 32  # place: start << 32 | length in bytes, so a row stays short and sorts by start


def _windows(t: bytes, cuts: list[int], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every window of a text, in bytes."""
    ends, words, last = [0], [0], 0
    for e in cuts:
        n = _words(t[last:e])
        if n or len(ends) == 1:
            ends.append(e)
            words.append(n)
        else:  # white space alone goes with the chunk before it
            ends[-1] = e
        last = e
    at, total = np.array(ends, dtype=np.int64), np.cumsum(words)
    n = len(at) - 1
    to = np.searchsorted(total, total[:-1] + min_words, "left")              # from each chunk on
    since = np.searchsorted(total, total[1:] - min_words, "right") - 1       # up to each chunk
    from_here, up_to = np.flatnonzero(to <= n), np.flatnonzero(since >= 0)
    both = np.unique(np.r_[from_here * (n + 1) + to[from_here], since[up_to] * (n + 1) + up_to + 1])
    return at[both // (n + 1)], at[both % (n + 1)]


def document_windows(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every window: doc (the id; without one a number from the text's hash), text_hash, digest and
    digest_more (128 bits of BLAKE2b), and place (start, length in bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.blake2b
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(2)]
            n, place, raw = [], [np.empty(0, np.int64)], []
            for t, cuts in zip(texts, chunk_texts(texts)):
                s, e = _windows(t, cuts, min_words)
                n.append(len(s))
                place.append(s << _LEN_BITS | e - s)
                raw.append(b"".join(digest(t[i:j], digest_size=16).digest() for i, j in zip(s.tolist(), e.tolist())))
            n = np.array(n, dtype=np.int64)
            halves = np.frombuffer(b"".join(raw), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), n)), pa.array(np.repeat(b.column(1).to_numpy(), n)),
                 *[pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)], pa.array(np.concatenate(place))],
                names=["doc", "text_hash", "digest", "digest_more", "place"])

    return df.select(_doc(df[id_col], df[text_col]).alias("doc"), F.xxhash64(df[text_col]).alias("text_hash"),
                     df[text_col].cast("binary").alias("text")).mapInArrow(run, _WINDOWS)


def _doc(id_col, text_col):
    return F.coalesce(id_col.cast("bigint"), F.xxhash64(text_col).bitwiseAND(F.lit(_NO_ID - 1)) + F.lit(_NO_ID))


def repeated_spans(windows: DataFrame) -> DataFrame:
    """(doc, text_hash, spans): the byte spans to remove, merged and in order, for texts with any."""
    firsts = staged(windows.groupBy(*_DIGEST).agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
                    .where("first_doc < last_doc").select(*_DIGEST, "first_doc"), "window-firsts")
    dups = (windows.join(firsts, _DIGEST).where("doc > first_doc")
            .groupBy("doc", "text_hash")
            .agg(F.array_sort(F.collect_set("place")).alias("places")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_merged(c.values.to_numpy()) for c in b.column(2)]
            spans = pa.array(out, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), spans], names=["doc", "text_hash", "spans"])

    return dups.mapInArrow(run, "doc bigint, text_hash bigint, spans array<struct<s:int,e:int>>")


def _merged(places: np.ndarray) -> list[dict]:
    """The spans of windows in order of start, joined where they touch or overlap."""
    start = places >> _LEN_BITS
    end = np.maximum.accumulate(start + (places & (1 << _LEN_BITS) - 1))
    head = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    tail = np.r_[head[1:], len(start)] - 1
    return [{"s": int(start[a]), "e": int(end[b])} for a, b in zip(head, tail)]


def dedup_substrings(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with repeated passages removed from the text, and a column
    ``substring_spans`` of the byte spans removed from the former text (null: none).

    A passage stays in the document with the smallest id, documents without an id coming last.
    Passages that repeat only inside one document stay.  Rows that repeat an id are one
    document to each other: none loses text to the other.  A null text stays null, an empty
    one empty; a text that repeats as a whole becomes empty, its row stays.  An empty table
    gives an empty result; other columns pass through.
    """
    windows = staged(document_windows(df, min_words, id_col, text_col), "windows")
    spans = staged(repeated_spans(windows), "window-spans")
    spans = spans.select(F.col("doc").alias("substring_doc"), F.col("text_hash").alias("substring_hash"),
                         F.col("spans").alias("substring_spans"))
    rows = df.withColumns({"substring_doc": _doc(df[id_col], df[text_col]), "substring_hash": F.xxhash64(df[text_col])})
    # the spans grow with the corpus, so they are merged at every size rather than broadcast at some
    j = rows.join(spans.hint("merge"), ["substring_doc", "substring_hash"], "left")
    s = j["substring_spans"]
    raw = df[text_col].cast("binary")
    # what stands between the spans: from each span's end to the next one's start
    starts = F.concat(F.array(F.lit(0)), F.transform(s, lambda x: x["e"]))
    ends = F.concat(F.transform(s, lambda x: x["s"]), F.array(F.octet_length(raw)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                        lambda x: F.substring(raw, x["a"] + 1, x["b"] - x["a"]).cast("string"))
    text = F.when(s.isNull(), df[text_col]).otherwise(F.array_join(parts, ""))
    return j.select(*[text.alias(c) if c == text_col else df[c] for c in df.columns], s)
