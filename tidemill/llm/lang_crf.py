"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language.  A word's own score comes from its affixes, its
letter n-grams and what the lexicon of each language says of it; learned transitions join
neighbouring words, so a word that fits several languages follows its neighbours while a
switch inside a text stays possible.  Forward-backward gives each word's marginal
probabilities; a document's language is the one with the largest sum of them.

The lexicon counts every word of every training document.  The field's weights are fitted on a
bounded sample: at most ``SAMPLE_DOCS`` training documents a language, from which
sequences are cut; half of them are spliced from two documents, so that transitions learn
what a switch costs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

SAMPLE_DOCS = 200         # training documents a language that the weights are fitted on
MAX_LANGS = 50            # languages, the most frequent first; the lexicon and sample are bounded by it
LEXICON = 5_000           # most frequent words a language
SEQUENCE = 48             # words of a training sequence
PER_DOC = 3               # segments cut from a sampled document, from places all over it
BUCKETS = 1 << 16
STEPS, RATE, RIDGE = 30, 0.2, 1e-4
UNDECIDED = "und"
# letters only: what Python counts as alphanumeric without being a letter is no word
_NUMERIC = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
_TOKEN = re.compile(r"\w+")
_LETTERS = re.compile(rf"[^\W\d_{re.escape(_NUMERIC)}]+")
_BLOCK = 1 << 20          # characters of a text searched at a time
_FLUSH = 400_000          # words counted in a task before they are handed on
_TYPES = 400_000          # words whose scores a task remembers
_CHARS = 1 << 22          # characters of the texts labelled together
_CELLS = 1 << 20          # words x languages of a padded matrix
_STEP_WORDS = 1 << 16     # words of a text whose forward scores are held at a time
_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)
_EVIDENCE = 4             # strongest lexicon evidence, in steps of 1.5 bits


def text_words(text: str) -> Iterator[list[str]]:
    """The lower-cased words of a text, block by block; no word is cut."""
    at = 0
    while len(text) - at > _BLOCK:
        end = at + _BLOCK
        while end < len(text) and text[end].isalpha():
            end += 1
        yield _letter_runs(text[at:end].lower())
        at = end
    yield _letter_runs(text[at:].lower())


def _letter_runs(text: str) -> list[str]:
    tokens = _TOKEN.findall(text)
    if all(map(str.isalpha, tokens)):
        return tokens
    return [w for t in tokens for w in ((t,) if t.isalpha() else _LETTERS.findall(t))]


# ---------------------------------------------------------------- features

def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' features in one array, and each word's start in it: letter n-grams of 1
    to 4, and prefixes and suffixes of 1 to 4 letters."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(np.r_[1, lens[:-1] + 1])
    word = np.repeat(np.arange(len(words)), lens)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens)       # of each letter in its word
    at = start[word] + place
    room = lens[word] - place                                                    # letters from here to the word's end
    rows, feats = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, 5):
        # h[i]: the n codes from i on
        h = h * _P + np.r_[codes[n - 1:], np.zeros(n - 1, np.uint64)] + np.uint64(1)
        inner = room >= n
        rows += [word[inner], np.arange(len(words))[lens >= n], np.arange(len(words))[lens >= n]]
        feats += [_hashed(h[at[inner]], 2 * n), _hashed(h[start[lens >= n]], 20 + n), _hashed(h[(start + lens - n)[lens >= n]], 30 + n)]
    rows, feats = np.concatenate(rows), np.concatenate(feats)
    by = np.argsort(rows, kind="stable")
    return feats[by], np.searchsorted(rows[by], np.arange(len(words)))


def _hashed(h: np.ndarray, salt: int) -> np.ndarray:
    x = (h + np.uint64(salt * int(_P) & (1 << 64) - 1)) * _M
    x = (x ^ (x >> np.uint64(31))) * _M
    return (x >> np.uint64(32)).astype(np.int64) % BUCKETS


@dataclass
class LanguageModel:
    langs: list[str]                       # in order
    weights: np.ndarray                    # buckets x languages
    evidence: np.ndarray                   # a row of weights for no entry, and for each language and strength of it
    transitions: np.ndarray                # from x to, as logarithms
    lexicon: dict[str, int]                # word -> row of evidence

    def scores(self, words: list[str]) -> np.ndarray:
        """Log potentials, words x languages."""
        if not words:
            return np.zeros((0, len(self.langs)))
        feats, start = word_features(words)
        return np.add.reduceat(self.weights[feats], start) + self.evidence[self.lexicon_bins(words)]

    def lexicon_bins(self, words: list[str]) -> np.ndarray:
        known = self.lexicon.get
        return np.fromiter((known(w, 0) for w in words), np.int64, len(words))


# ---------------------------------------------------------------- forward-backward

def marginals(emit: np.ndarray, trans: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of padded sequences (rows x steps x languages of potentials, each row's length
    falling) and the expected transitions; potentials and not logarithms, normalised at each step."""
    rows, steps, k = emit.shape
    alpha, beta, scale = np.zeros_like(emit), np.ones_like(emit), np.ones((rows, steps, 1))
    alpha[:, 0] = emit[:, 0]
    active = (lens[:, None] > np.arange(steps)).sum(axis=0)      # rows that reach each step, as lengths fall
    for t in range(steps):
        a = active[t]
        if t:
            alpha[:a, t] = (alpha[:a, t - 1] @ trans) * emit[:a, t]
        scale[:a, t] = alpha[:a, t].sum(axis=1, keepdims=True)
        alpha[:a, t] /= scale[:a, t]
    pairs = np.zeros((k, k))
    for t in range(steps - 1, 0, -1):
        a = active[t]
        right = emit[:a, t] * beta[:a, t] / scale[:a, t]
        beta[:a, t - 1] = right @ trans.T
        pairs += alpha[:a, t - 1].T @ right
    return alpha * beta, pairs * trans


def document_marginals(ids: np.ndarray, emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Sum of one text's marginals per language; ``ids`` are rows of ``emit`` (potentials).  Forward
    scores are kept at the start of each block and made again on the way back."""
    k = emit.shape[1]
    bounds = [*range(0, len(ids), _STEP_WORDS), len(ids)]
    heads, alpha = [], None
    for lo, hi in zip(bounds, bounds[1:]):
        heads.append(alpha)
        if hi < len(ids):
            alpha = _forward(emit[ids[lo:hi]], trans, alpha)[0][-1]
    total, beta = np.zeros(k), np.ones(k)
    for (lo, hi), head in reversed(list(zip(zip(bounds, bounds[1:]), heads))):
        e = emit[ids[lo:hi]]
        a, scale = _forward(e, trans, head)
        back = np.empty_like(e)
        for t in range(hi - lo - 1, -1, -1):
            back[t] = beta
            beta = trans @ (e[t] * beta / scale[t])
        total += (a * back).sum(axis=0)
    return total


def _forward(e: np.ndarray, trans: np.ndarray, alpha: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    out, scale = np.empty_like(e), np.empty(len(e))
    for t in range(len(e)):
        alpha = e[t] if alpha is None else (alpha @ trans) * e[t]
        scale[t] = alpha.sum()
        alpha = out[t] = alpha / scale[t]
    return out, scale


def _potentials(scores: np.ndarray) -> np.ndarray:
    """exp, each row's largest 1, none so small that a sequence's product vanishes."""
    return np.exp(np.maximum(scores - scores.max(axis=-1, keepdims=True), -30))


# ---------------------------------------------------------------- fitting

def training_rows(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(doc_id, text, lang) of what may be learned from: crc32 of the id in decimal not divisible by
    5, a language and an id given."""
    return (df.select(df[id_col].cast("string").alias("doc_id"), df[text_col].alias("text"), df[lang_col].cast("string").alias("lang"))
            .where("lang is not null and text is not null and crc32(cast(doc_id as binary)) % 5 <> 0"))


def count_lexicon(train: DataFrame, langs: list[str], size: int) -> dict[str, int]:
    """Row of the evidence for each word of any language's ``size`` most frequent ones, from the word's
    counts over all training documents."""
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            names = ["lang", "word", "n"]
            cols = zip(*rows) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))], names=names)

        counts: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                if lang in index:
                    c = counts.setdefault(lang, Counter())
                    for words in text_words(text.as_py()):
                        c.update(words)
                if sum(map(len, counts.values())) > _FLUSH:
                    yield flush()
        yield flush()

    counted = staged(train.select("text", "lang").mapInArrow(run, "lang string, word string, n bigint")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")), "crf-words")
    total = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}      # one row a language
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    picked = staged(counted.where(F.col("n") >= 3).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= size)
                    .select("word").distinct(), "crf-lexicon")
    weight = F.create_map(*[F.lit(x) for lang in total for x in (lang, 1.0 / total[lang])]) if total else F.create_map()
    shares = F.sort_array(F.collect_list(F.struct((F.col("n") * F.element_at(weight, F.col("lang"))).alias("share"), "lang")), asc=False)
    rows = counted.join(picked, "word").groupBy("word").agg(shares.alias("s")).select(      # languages x size rows at most
        "word", F.col("s")[0]["lang"].alias("lang"), F.col("s")[0]["share"].alias("first"),
        F.coalesce(F.try_element_at("s", F.lit(2))["share"], F.lit(0.0)).alias("second")).toArrow().to_pydict()
    floor = 1e-6
    odds = np.log2((np.array(rows["first"]) + floor) / (np.array(rows["second"]) + floor))
    strength = np.clip(odds // 1.5, 0, _EVIDENCE).astype(np.int64)
    first = np.array([index[x] for x in rows["lang"]], dtype=np.int64)
    return dict(zip(rows["word"], (1 + first * (_EVIDENCE + 1) + strength).tolist()))


def sample_texts(train: DataFrame, docs: int, langs: list[str]) -> list[tuple[str, str]]:
    """(lang, text) of at most ``docs`` training documents a language, those whose ids have the
    smallest hashes; of rows that repeat an id and language the smallest text."""
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    keys = staged(train.where(F.col("lang").isin(langs)).select("lang", "doc_id").distinct()
                  .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= docs).select("lang", "doc_id"), "crf-sample")
    rows = train.join(F.broadcast(keys), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    return sorted((r.lang, r.doc_id, seg) for r in rows.select("lang", "doc_id", _segments("text").alias("segments")).collect()
                  for seg in r.segments)


def _segments(text_col: str):
    """PER_DOC segments of a text, from the start, the end and places between."""
    @F.pandas_udf("array<string>")
    def cut(texts):
        def one(t):
            words = [w for part in text_words(t) for w in part]
            span = max(0, len(words) - SEQUENCE)
            firsts = sorted({span * i // max(1, PER_DOC - 1) for i in range(PER_DOC)})
            return [" ".join(words[i:i + SEQUENCE]) for i in firsts if words]
        return texts.map(one)
    return cut(text_col)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
        lexicon: int = LEXICON, steps: int = STEPS) -> LanguageModel | None:
    """Count the lexicon over all training documents and fit the field on the sample; None without a
    language to learn."""
    train = training_rows(df, id_col, text_col, lang_col)
    seen = train.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGS).collect()
    langs = sorted(r.lang for r in seen)
    if not langs:
        return None
    words = count_lexicon(train, langs, lexicon)
    segments = [(lang, seg.split(" ")) for lang, _, seg in sample_texts(train, sample_docs, langs)]
    return fit_field(langs, segments, words, steps)


def _sequences(segments: list[tuple[str, list[str]]], langs: list[str]) -> tuple[list[list[str]], list[np.ndarray]]:
    """Segments as they are, and as many spliced from two segments, each cut at its own place."""
    rng = np.random.default_rng(11)
    code = {x: i for i, x in enumerate(langs)}
    seqs = [(w, np.full(len(w), code[lang])) for lang, w in segments]
    other = rng.permutation(len(seqs))
    for i, j in enumerate(other.tolist()):
        (a, la), (b, lb) = seqs[i], seqs[j]
        x, y = int(rng.integers(len(a) // 4, len(a) + 1)), int(rng.integers(0, len(b) * 3 // 4 + 1))
        mixed = a[:x] + b[y:]
        if mixed:
            seqs.append((mixed[:SEQUENCE], np.r_[la[:x], lb[y:]][:SEQUENCE]))
    seqs.sort(key=lambda s: -len(s[0]))
    return [s for s, _ in seqs], [y for _, y in seqs]


def fit_field(langs: list[str], segments: list[tuple[str, list[str]]], lexicon: dict[str, int], steps: int = STEPS) -> LanguageModel:
    """Largest penalised likelihood of the labelled sequences, by Adam over all of them."""
    k = len(langs)
    model = LanguageModel(langs, np.zeros((BUCKETS, k)), np.zeros((1 + k * (_EVIDENCE + 1), k)), np.zeros((k, k)), lexicon)
    seqs, labels = _sequences(segments, langs)
    if not seqs or k == 1:
        return model
    lens = np.array([len(s) for s in seqs])
    types = sorted({w for s in seqs for w in s})
    index = {w: i for i, w in enumerate(types)}
    mask = np.arange(lens[0]) < lens[:, None]
    word, gold = np.zeros(mask.shape, np.int64), np.zeros(mask.shape, np.int64)
    word[mask] = [index[w] for s in seqs for w in s]
    gold[mask] = np.concatenate(labels)
    feats, start = word_features(types)
    of_word = np.repeat(np.arange(len(types)), np.diff(np.r_[start, len(feats)]))
    bins = model.lexicon_bins(types)
    flat = word[mask]
    want = np.zeros((len(types), k))
    np.add.at(want, (flat, gold[mask]), 1)
    want_pairs = np.zeros((k, k))
    both = mask[:, 1:]
    np.add.at(want_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    params = [model.weights, model.evidence, model.transitions]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        scores = np.add.reduceat(model.weights[feats], start) + model.evidence[bins]
        emit = np.where(mask[:, :, None], _potentials(scores)[word], 1.0)
        gamma, pairs = marginals(emit, np.exp(model.transitions), lens)
        got = np.stack([np.bincount(flat, gamma[:, :, c][mask], len(types)) for c in range(k)], axis=1)
        miss = (want - got) / len(flat)
        grads = [np.stack([np.bincount(feats, miss[of_word, c], BUCKETS) for c in range(k)], axis=1),
                 np.stack([np.bincount(bins, miss[:, c], len(model.evidence)) for c in range(k)], axis=1),
                 (want_pairs - pairs) / len(flat)]
        for p, g, m, v in zip(params, grads, first, second):
            g -= RIDGE * p / 10
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return model


# ---------------------------------------------------------------- prediction

class _Scorer:
    """Potentials of words, remembered from one text to the next."""

    def __init__(self, model: LanguageModel):
        self.model, self.trans = model, np.exp(model.transitions)
        self.clear()

    def clear(self):
        self.rows: dict[str, int] = {}
        self.emit = np.zeros((1024, len(self.model.langs)))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's words as rows of ``emit``; words new to the task are scored together."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0
        for i, t in enumerate(texts):
            for words in text_words(t):
                held.append((i, words))
                size += len(words)
                if size > _CHARS // 4:
                    self._look_up(held, out)
                    held, size = [], 0
        self._look_up(held, out)
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in out]

    def _look_up(self, held, out):
        rows = self.rows
        new = [w for w in set().union(*(words for _, words in held)) if w not in rows]
        n = len(rows)
        rows.update(zip(new, range(n, n + len(new))))
        if len(self.emit) < len(rows):
            self.emit = np.concatenate([self.emit, np.zeros((len(rows), self.emit.shape[1]))])
        for lo in range(n, len(rows), 4096):
            some = new[lo - n:lo - n + 4096]
            self.emit[lo:lo + len(some)] = _potentials(self.model.scores(some))
        for i, words in held:
            out[i].append(np.array([rows[w] for w in words], dtype=np.int32))

    def totals(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's summed marginals; zeros without a word."""
        if len(self.rows) > _TYPES:
            self.clear()
        ids = self.ids(texts)
        lens = np.array([len(x) for x in ids])
        out = [np.zeros(len(self.model.langs)) for _ in ids]
        short = np.flatnonzero((lens > 0) & (lens <= 1 << 13))
        short = short[np.argsort(-lens[short], kind="stable")]
        for lo, hi in _even(lens[short], _CELLS // self.emit.shape[1]):
            rows = short[lo:hi]
            n = lens[rows]
            word = np.zeros((len(rows), n[0]), dtype=np.int32)
            inside = np.arange(n[0]) < n[:, None]
            word[inside] = np.concatenate([ids[r] for r in rows])
            gamma, _ = marginals(np.where(inside[:, :, None], self.emit[word], 1.0), self.trans, n)
            for r, total in zip(rows.tolist(), (gamma * inside[:, :, None]).sum(axis=1)):
                out[r] = total
        for r in np.flatnonzero(lens > 1 << 13).tolist():
            out[r] = document_marginals(ids[r], self.emit, self.trans)
        return out


def _even(lens: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    """Runs of falling lengths whose padded matrix stays within ``words`` and is at least half full."""
    lo = 0
    while lo < len(lens):
        hi = lo + 1
        while hi < len(lens) and (hi + 1 - lo) * lens[lo] <= words and (2 * lens[hi] >= lens[lo] or lens[lo] < 64):
            hi += 1
        yield lo, hi
        lo = hi


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
             lexicon: int = LEXICON, steps: int = STEPS) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out (crc32 of the id in decimal is divisible by 5; false
    without an id), lang_pred (a learned language, or ``und`` for a text without a letter), score
    (the mean marginal of that language over the text's words, 0 for ``und``).

    A null or empty text is ``und``; without any training document every text is.  Texts of any
    length are read whole; rows that repeat an id are rows of their own; equal sums go to the first
    language in order.  Languages beyond the MAX_LANGS most frequent are not learned.  Other
    columns are not read.  An empty table gives an empty result.
    """
    model = fit(df, id_col, text_col, lang_col, sample_docs, lexicon, steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model) if model else None
        for whole in batches:
            sizes = np.cumsum([len(t) if t else 0 for t in whole.column(2).to_pylist()])
            cuts = np.flatnonzero(np.diff(sizes // _CHARS)) + 1      # texts that are labelled together
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                b = whole.slice(lo, hi - lo)
                texts = [t or "" for t in b.column(2).to_pylist()]
                sums = scorer.totals(texts) if scorer else [np.zeros(1)] * len(texts)
                mass = [float(x.sum()) for x in sums]
                lang = [model.langs[int(np.argmax(x))] if m > 0 else UNDECIDED for x, m in zip(sums, mass)]
                score = [min(1.0, float(x.max()) / m) if m > 0 else 0.0 for x, m in zip(sums, mass)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    rows = df.select(df[id_col].alias("doc_id"), F.coalesce(F.crc32(df[id_col].cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"),
                     df[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
