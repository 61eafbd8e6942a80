"""Spelling variant grouping by reduced-alphabet generation.

Letters are hashed to a few symbols, and a reduced word to one number, a polynomial over its
symbols, from which the number of any word one edit away follows without building that word.
Every vocabulary word generates the full one-edit neighbourhood of its reduced word (itself,
replacements, deletions, insertions); what meets no vocabulary word is dropped by a bit table
of fixed size, the rest joins the reduced vocabulary, and every pair is verified on the original
strings.  A smaller alphabet generates less and verifies more; none loses a pair, since an edit
of a word is an edit of its reduced word or leaves that as it is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged

SYMBOLS = 16
TABLE_BITS = 25           # bits of the table of reduced words, 4 MB at any vocabulary
MIN_LETTERS, MIN_COUNT, FORM_RATIO, DROP_RATE = 6, 5, 5, 199
_RUN = re.compile(rb"[a-z\xc0-\xff]+")   # Latin-1, after lower-casing A-Z
_BLOCK = 1 << 20          # characters of a text searched at a time
_FLUSH = 400_000          # words counted in a task before they are handed on
_CELLS = 1 << 20          # neighbours generated at a time
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# ---------------------------------------------------------------- words

def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks that cut no run."""
    at = 0
    while len(text) - at > _BLOCK:
        m = re.compile(rb"[^a-z\xc0-\xff]").search(text, at + _BLOCK)
        end = m.end() if m else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def document_words(doc_id: str, text: str) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences in the document): letter runs with A-Z lower-cased, with one
    letter dropped from those whose CRC with the id is a multiple of DROP_RATE."""
    raw = text.encode("latin-1", "replace").lower()   # bytes: lowers A-Z only; '?' is no letter either
    runs: Counter[bytes] = Counter()
    for part in _blocks(raw):
        runs.update(_RUN.findall(part))
    seed = zlib.crc32(f"{doc_id}:".encode())
    for w, n in runs.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), seed)
        if h % DROP_RATE == 0:
            i = h % len(w)
            w = w[:i] + w[i + 1:]
        if len(w) >= MIN_LETTERS:
            yield w, n


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least MIN_LETTERS letters and MIN_COUNT occurrences in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        counts: dict[bytes, int] = {}
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                for w, n in document_words(i or "", t.as_py() or ""):
                    counts[w] = counts.get(w, 0) + n
                if len(counts) > _FLUSH:
                    yield flush()
        yield flush()

    rows = df.select(df[id_col].cast("string").alias("id"), df[text_col].alias("text"))
    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


# ---------------------------------------------------------------- reduced words

def symbol_table(symbols: int) -> np.ndarray:
    """Symbol 1..symbols of every Latin-1 letter: letters in order of their hash take turns."""
    by = sorted(range(256), key=lambda b: zlib.crc32(bytes([b, 7])))
    out = np.zeros(256, dtype=np.uint64)
    for script in (range(ord("a"), ord("z") + 1), range(0xC0, 0x100)):
        for k, b in enumerate(x for x in by if x in script):
            out[b] = k % symbols + 1
    return out


def _powers(n: int) -> np.ndarray:
    """_BASE ** 0..n-1 mod 2**64."""
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(_BASE)
        out = np.cumprod(out, dtype=np.uint64)
    return out


def _letters(words: list[bytes], table: np.ndarray) -> np.ndarray:
    return table[np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)]


def reduced_codes(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """The reduced words' numbers."""
    out = np.zeros(len(words), dtype=np.uint64)
    for at, same in _by_length(words):
        sym = _letters(same, table)
        out[at] = (sym * _powers(sym.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    lens = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lens):
        at = np.flatnonzero(lens == n)
        step = max(1, _CELLS // int(n))
        for lo in range(0, len(at), step):
            some = at[lo:lo + step]
            yield some, [words[i] for i in some.tolist()]


def neighbour_codes(words: list[bytes], table: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) of each word's reduced word and of all reduced words one edit from it, in blocks.

    A deletion from a run of equal symbols is made once, at its start, and so is an insertion
    that would lengthen a run; each other edit gives a reduced word of its own."""
    letter = np.arange(1, symbols + 1, dtype=np.uint64)
    for at, same in _by_length(words):
        rows = max(1, _CELLS // (2 * symbols * (len(same[0]) + 1)))
        for lo in range(0, len(same), rows):
            sym, row = _letters(same[lo:lo + rows], table), at[lo:lo + rows]
            m = sym.shape[1]
            power = _powers(m + 1)
            term = sym * power[:m]
            head = np.concatenate([np.zeros((len(row), 1), np.uint64), np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
            total = head[:, -1:]
            yield row, total[:, 0]
            step = max(1, _CELLS // (symbols * len(row)))
            before = np.concatenate([np.zeros((len(row), 1), np.uint64), sym], axis=1)   # symbol before each place
            dels = head[:, :-1] + (total - head[:, 1:]) * _INVERSE
            yield _picked(row, dels, before[:, :-1] != sym)
            for i in range(0, m + 1, step):
                j = min(m + 1, i + step)
                ins = (head[:, i:j] + (total - head[:, i:j]) * np.uint64(_BASE))[:, :, None] + power[i:j, None] * letter
                yield _picked(row, ins, before[:, i:j, None] != letter)
                j = min(m, j)
                subs = (total - term[:, i:j])[:, :, None] + power[i:j, None] * letter
                yield _picked(row, subs, sym[:, i:j, None] != letter)


def _picked(row: np.ndarray, codes: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(row, codes[0].size)[keep.ravel()], codes[keep]


def _bit(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes * _MIX) >> np.uint64(64 - bits)


def _bit_table(coded: DataFrame, bits: int) -> np.ndarray:
    """A bit for each reduced word; 2 ** (bits - 6) words of 64 bits at most come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = np.unique(_bit(b.column(0).to_numpy().view(np.uint64), bits))
            slot, first = np.unique(bit >> np.uint64(6), return_index=True)
            if len(slot):
                word = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(word.view(np.int64))], names=["slot", "bits"])

    slots = coded.select("code").mapInArrow(run, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    got = slots.toArrow()
    out = np.zeros(1 << max(0, bits - 6), dtype=np.uint64)
    out[got.column("slot").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


# ---------------------------------------------------------------- pairs and forms

def near_words(vocab: DataFrame, symbols: int = SYMBOLS, bits: int = TABLE_BITS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words that differ by one inserted, deleted or
    replaced code point.  ``vocab``: (word, n), words distinct, of Latin-1 letters."""
    table = symbol_table(symbols)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = reduced_codes([w.encode("latin-1") for w in b.column(0).to_pylist()], table)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes.view(np.int64))], names=["word", "n", "code"])

    coded = staged(vocab.select("word", "n").mapInArrow(encode, "word string, n bigint, code bigint"), "spelling-codes")
    known = _bit_table(coded, bits)

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, codes = [], []
            for row, code in neighbour_codes([w.encode("latin-1") for w in b.column(0).to_pylist()], table, symbols):
                bit = _bit(code, bits)
                hit = known[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
                rows.append(row[hit])
                codes.append(code[hit])
            if rows:
                row, code = np.concatenate(rows), np.concatenate(codes)
                by = np.lexsort((code, row))
                row, code = row[by], code[by]
                new = np.ones(len(row), dtype=bool)      # numbers that two edits share by chance count once
                new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
                row = pa.array(row[new])
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(code[new].view(np.int64))],
                                                 names=["word", "n", "code"])

    found = coded.select("word", "n").mapInArrow(generate, "word string, n bigint, code bigint")
    others = coded.select("code", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Spark sizes all neighbours found as the words they come from, and would broadcast them
    return found.hint("merge").join(others, "code").where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to their end by pointer jumping; a form has at least FORM_RATIO
    times the count, so chains have a logarithm of the largest count and no loop."""
    at = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"))
        nxt = staged(at.hint("merge").join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")),
                     "spelling-roots")
        at = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return at


def spelling_forms(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int = SYMBOLS,
                   bits: int = TABLE_BITS) -> DataFrame:
    """One row per vocabulary word: word, form (the near word with the largest count, ties to the
    smallest, if that is at least FORM_RATIO times the word's; else null), root (form of form, to the
    last), n, n_near, form_n.

    A null text has no words; a null id counts as empty; rows that repeat an id or a text count each;
    a text of any length is searched in blocks.  Other columns are not read.  No vocabulary: no row.
    """
    vocab = staged(vocabulary(df, id_col, text_col), "spelling-vocabulary")
    near = near_words(vocab, symbols, bits).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top"))
    enough = -F.col("top")["minus"] >= F.col("n") * FORM_RATIO
    near = staged(near.select("word", "n_near", F.when(enough, F.col("top")["near"]).alias("form"),
                              F.when(enough, -F.col("top")["minus"]).alias("form_n")), "spelling-near")
    roots = _roots(near.where("form is not null"))
    # packed files of words take several times their size in memory: merged too, not broadcast
    return (vocab.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))
