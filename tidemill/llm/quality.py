"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the target (documents labelled
good), one of the raw text (all documents).  A document's log weight is the sum over its n-grams
of log p(target) - log p(raw), both smoothed by the same count per bucket, so that n-grams the
labelled sample is too small to hold say little.  Adding Gumbel noise and keeping the k largest keys samples k
documents without replacement in proportion to their weights; the others are rejected.

k is the number of documents whose log weight reaches a cut, placed on the labelled sample
where it best separates good from bad; a good document is weighed there without its own
counts in the target, as an unlabelled one would be.  The labelled sample is bounded (``max_labels``); the
raw model, the weights, k and the k-th largest key are taken over all documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import staged

BUCKETS = 1 << 16
MAX_LABELS = 20_000
_TOKENS = re.compile(r"\w+|[^\w\s]")
_SAME = zlib.crc32(b"\0same")    # stands for a token equal to the one before
_CACHE_TOKENS = 200_000
_SMOOTH = 5.0                    # added to each bucket's count in the target and its expected count

_HASHES: dict[str, int] = {}     # one per Python worker


def ngram_buckets(text: str) -> np.ndarray:
    """Buckets of the lower-cased text's unigrams and bigrams; a token that repeats its
    predecessor counts as the mark of repetition."""
    tokens = _TOKENS.findall(text.lower())
    if not tokens:
        return np.empty(0, dtype=np.int64)
    known = _HASHES
    if len(known) > _CACHE_TOKENS:
        known.clear()
    try:
        ids = [known[t] for t in tokens]
    except KeyError:
        for t in set(tokens):
            if t not in known:
                known[t] = zlib.crc32(t.encode("utf-8", "surrogatepass"))
        ids = [known[t] for t in tokens]
    a = np.array(ids, dtype=np.uint64)
    same = np.flatnonzero(a[1:] == a[:-1]) + 1
    a[same] = _SAME
    pairs = (a[:-1] * np.uint64(0x9E3779B97F4A7C15) + a[1:]) * np.uint64(0xBF58476D1CE4E5B9)
    singles = a * np.uint64(0x94D049BB133111EB)
    return (np.concatenate([singles, pairs]) >> np.uint64(48)).astype(np.int64) % BUCKETS


@dataclass
class QualityModel:
    target: np.ndarray      # n-grams of the labelled good documents, per bucket
    expected: np.ndarray    # as many n-grams, in the raw text's shares
    cut: float = -np.inf    # log weight that best separates the labelled sample

    def log_weight(self, at: np.ndarray, own: bool = False) -> float:
        """Sum of log p(target) - log p(raw) over buckets ``at``; ``own``: without these n-grams'
        own counts in the target."""
        if not len(at):
            return 0.0
        bucket, n = np.unique(at, return_counts=True)
        t, e = self.target[bucket], self.expected[bucket]
        return float((n * (np.log(t - own * n + _SMOOTH) - np.log(e + _SMOOTH))).sum())


def labelled_sample(labels: DataFrame, max_labels: int = MAX_LABELS, id_col: str = "doc_id",
                    quality_col: str = "quality") -> DataFrame:
    """(label_id, good): at most ``max_labels`` labelled ids, those with the smallest hashes.  An
    id labelled twice is good if all its labels are; null ids and labels are left out."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
            .groupBy(F.col(id_col).cast("bigint").alias("label_id"))
            .agg((F.min(quality_col) > 0).cast("int").alias("good"))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labels))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                     F.col(text_col).alias("text"))


def fit(df: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, id_col: str = "doc_id",
        text_col: str = "text", quality_col: str = "quality") -> QualityModel:
    """Count both models and place the cut.  Without good labels every weight is 0."""
    sample = staged(labelled_sample(labels, max_labels, id_col, quality_col), "quality-labels")
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    marked = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left").select("text", "good")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for t, good in zip(b.column(0), b.column(1).to_pylist()):
                if text := t.as_py():
                    n = np.bincount(ngram_buckets(text), minlength=0)
                    raw[:len(n)] += n
                    if good == 1:
                        target[:len(n)] += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                                         names=["bucket", "raw", "target"])

    rows = (marked.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    model = QualityModel(target, raw * (target.sum() / max(raw.sum(), 1)))
    # the labelled documents' weights: as many rows as the sample holds
    held = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("label_id", "good", "text")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = b.column(1).to_pylist()
            w = [shared.value.log_weight(ngram_buckets(t.as_py() or ""), own=g == 1) for t, g in zip(b.column(2), good)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(w, pa.float64())], names=["label_id", "good", "w"])

    got = (held.mapInArrow(weigh, "label_id bigint, good int, w double")
           .groupBy("label_id").agg(F.min("w").alias("w"), F.first("good").alias("good")).collect())
    model.cut = best_cut(np.array([r.w for r in got]), np.array([r.good for r in got]))
    return model


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The middle of the widest-margin cut with the fewest mistakes; 0 without both kinds."""
    if not len(weights) or good.min() == good.max():
        return -np.inf if not len(weights) or good.min() == 1 else 0.0
    o = np.argsort(weights, kind="stable")
    w, g = weights[o], good[o]
    # cut before position i: the good ones below and the bad ones from i on are mistakes
    wrong = np.r_[0, np.cumsum(g)] + np.r_[np.cumsum((1 - g)[::-1])[::-1], 0]
    inner = np.arange(1, len(w))
    inner = inner[w[inner] > w[inner - 1]]
    if not len(inner):
        return float(w[0])
    best = inner[wrong[inner] == wrong[inner].min()]
    i = best[np.argmax(w[best] - w[best - 1])]
    return float((w[i] + w[i - 1]) / 2)


_SCORED = "doc_id bigint, text_hash bigint, n_ngrams bigint, log_weight double"


def score(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_ngrams, log_weight): one row per input row; no text weighs 0."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # two doubles a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n, w = [], []
            for t in b.column(2):
                at = ngram_buckets(t.as_py() or "")
                n.append(len(at))
                w.append(m.log_weight(at))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(w, pa.float64())],
                                             names=["doc_id", "text_hash", "n_ngrams", "log_weight"])

    return _texts(df, id_col, text_col).mapInArrow(run, _SCORED)


def _gumbel(seed: int, doc_id, text_hash):
    """Gumbel noise from the id and the text's hash, so a rerun agrees."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text_hash), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def kth_largest(df: DataFrame, col: str, k: int) -> float:
    """The k-th largest value of a finite double column, exact: the bin that holds the rank is
    split again and again; the driver sees bin counts only."""
    if k <= 0:
        return float("inf")
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    lo, hi = b.lo, b.hi
    if k >= b.n:
        return lo if lo is not None else float("inf")
    bins = 4096
    while lo < hi:
        width = (hi - lo) / bins
        if width == 0 or lo + width == lo:
            break
        at = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        rows = (df.where(F.col(col).between(lo, hi)).groupBy(at.alias("bin"))
                .agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
                .orderBy(F.desc("bin")).collect())  # at most 4096 rows
        for r in rows:
            if k <= r.n:
                break
            k -= r.n
        lo, hi = r.lo, r.hi
        if k == r.n:
            return lo
        if k == 1:
            return hi
    return lo


def resample(df: DataFrame, model: QualityModel, seed: int = 11, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, float]:
    """Scored rows with ``gumbel_key``, and the key from which rows are kept (ties all stay)."""
    keyed = staged(score(df, model, id_col, text_col).withColumn("gumbel_key", F.col("log_weight") + _gumbel(seed, F.col("doc_id"), F.col("text_hash"))),
                   "quality-scores")
    k = keyed.where(F.col("log_weight") >= F.lit(model.cut)).count()
    return keyed, kth_largest(keyed, "gumbel_key", k)


def classify(df: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, seed: int = 11,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_ngrams, log_weight, gumbel_key, kept.

    A null or empty text has no n-grams and weight 0.  Rows that repeat id and text share their
    noise and their verdict; null ids draw by the text's hash.  Without labels, or with good
    ones only, every document stays.  An empty table gives an empty result; other columns are
    ignored.
    """
    model = fit(df, labels, max_labels, id_col, text_col)
    keyed, least = resample(df, model, seed, id_col, text_col)
    return keyed.select("doc_id", "n_ngrams", "log_weight", "gumbel_key", (F.col("gumbel_key") >= F.lit(least)).alias("kept"))


def keep_good(df: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, seed: int = 11,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``classify`` keeps.  Weights are computed again beside the texts,
    which is less work than joining the verdicts to them."""
    model = fit(df, labels, max_labels, id_col, text_col)
    _, least = resample(df, model, seed, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def weight(texts):
        m = shared.value
        return texts.map(lambda t: m.log_weight(ngram_buckets(t or "")))

    rows = df.withColumns({"quality_weight": weight(df[text_col]), "quality_hash": F.xxhash64(df[text_col])})
    key = F.col("quality_weight") + _gumbel(seed, df[id_col].cast("bigint"), F.col("quality_hash"))
    return rows.where(key >= F.lit(least)).select(*[df[c] for c in df.columns])
