"""Language identification: forward-backward against enumeration, held-out accuracy, code-switched text, edges."""

import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import lang_crf, queries

SF = "/root/testdata/sf0.01"


def _enumerated(emit, trans):
    n, k = emit.shape
    gamma, pairs, z = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in product(range(k), repeat=n):
        p = emit[0, path[0]] * np.prod([trans[a, b] * emit[i + 1, b] for i, (a, b) in enumerate(zip(path, path[1:]))])
        z += p
        for i, a in enumerate(path):
            gamma[i, a] += p
        for a, b in zip(path, path[1:]):
            pairs[a, b] += p
    return gamma / z, pairs / z


def test_marginals_against_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    lens = np.array([6, 4, 4, 1])
    emit, trans = rng.random((4, 6, 3)) + 0.01, rng.random((3, 3)) + 0.01
    gamma, pairs = lang_crf.marginals(emit, trans, lens)
    want_pairs = np.zeros((3, 3))
    for e, g, n in zip(emit, gamma, lens):
        want, p = _enumerated(e[:n], trans)
        want_pairs += p
        assert np.allclose(g[:n], want) and (g[n:] == 0).all()
    assert np.allclose(pairs, want_pairs)
    ids = rng.integers(0, 6, 500)
    whole = lang_crf.marginals(emit[:1][:, ids], trans, np.array([500]))[0].sum(axis=(0, 1))
    for block in (1, 7, 500, 1000):     # forward scores kept by block, made again on the way back
        monkeypatch.setattr(lang_crf, "_STEP_WORDS", block)
        assert np.allclose(lang_crf.document_marginals(ids, emit[0], trans), whole)


def test_features_are_the_words_own():
    words = ["a", "straße", "ab", "überall"]
    feats, start = lang_crf.word_features(words)
    bounds = [*start.tolist(), len(feats)]
    for i, w in enumerate(words):
        alone, _ = lang_crf.word_features([w])
        assert sorted(alone.tolist()) == sorted(feats[bounds[i]:bounds[i + 1]].tolist())
        n = len(w)
        assert len(alone) == sum(max(0, n - g + 1) + 2 * (n >= g) for g in range(1, 5))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    got = queries.QUERIES["op12_language_id"](spark, SF).toPandas().merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.98
    assert got.score.between(0, 1).all() and set(got.lang_pred) <= {*docs.lang, "und"}


@pytest.fixture(scope="module")
def model(spark):
    return lang_crf.fit(spark.read.parquet(f"{SF}/documents.parquet"), sample_docs=60, steps=25)


def test_code_switched_text_is_labelled_by_word(spark, model):
    rows = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de') and n_chars > 2000")
            .where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()}
    halves = [[w for part in lang_crf.text_words(rows[x]) for w in part][:40] for x in ("en", "de")]
    words = halves[0] + halves[1]
    emit = lang_crf._potentials(model.scores(words))
    gamma, _ = lang_crf.marginals(emit[None], np.exp(model.transitions), np.array([len(words)]))
    label = [model.langs[i] for i in gamma[0].argmax(axis=1)]
    right = sum(x == "en" for x in label[:40]) + sum(x == "de" for x in label[40:])
    assert right >= 74
    stay, switch = np.diag(model.transitions), model.transitions[~np.eye(len(model.langs), dtype=bool)]
    assert stay.min() > switch.max()        # learned, not set


def test_long_and_short_texts_get_the_same_sums(model, monkeypatch):
    text = "the of und der nicht que la " * 2000
    short = lang_crf._Scorer(model).totals([text, "the", ""])
    monkeypatch.setattr(lang_crf, "_BLOCK", 500)
    again = lang_crf._Scorer(model).totals(["", text])
    assert np.allclose(short[0], again[1]) and short[0].sum() == pytest.approx(14000)
    assert short[2].sum() == 0
    few = [text[:n] for n in (30, 300, 3000)]
    for t, total in zip(few, lang_crf._Scorer(model).totals(few)):
        ids = lang_crf._Scorer(model)
        at = ids.ids([t])[0]
        assert np.allclose(total, lang_crf.document_marginals(at, ids.emit, ids.trans))


def test_edges(spark):
    base = [(i, f"{w} {w}s ge{w} the" if lang == "en" else f"{w}ción {w}ado que la", lang) for i, (w, lang) in
            enumerate((a + b, lang) for a in "bcdfgh" for b in ("as", "el", "or", "in") for lang in ("en", "es"))]
    odd = [(None, "que la casación", "es"), (100, None, "en"), (101, "", "en"), (102, "12 ² ½ _ !", None), (103, "the base", None),
           (103, "the base", None), (104, "que " * 300_000, "zz")]
    df = spark.createDataFrame([(*r, 0.5) for r in base + odd], "doc_id bigint, text string, lang string, score double")
    out = lang_crf.identify(df, steps=15)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == len(base) + len(odd)
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and [by[i].score for i in (100, 101, 102)] == [0.0] * 3
    assert by[None].held_out is False and by[None].lang_pred in ("en", "es")
    assert sum(r.doc_id == 103 for r in rows) == 2 and by[103].lang_pred == "en"
    zz_held = zlib.crc32(b"104") % 5 == 0
    assert {r.lang_pred for r in rows} <= {"en", "es", "und"} | (set() if zz_held else {"zz"})
    assert lang_crf.identify(df.limit(0)).count() == 0
    unlabelled = lang_crf.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
