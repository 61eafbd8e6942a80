"""WARC archive, mixing, packing and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tidemill.llm import mixing, packing, queries, warc


def test_warc_round_trip_and_edges(spark):
    big = "<p>é</p>" * 100_000
    rows = [(3, "http://a/\r\nx", big, 1), (1, "http://b", big, 1), (2, None, None, 1), (5, "u", "", 1), (4, "u", "x" * 99, 1), (6, "u", "x" * 99, 1),
            (8, "u", "y" * 100, 1), (7, "u", "y" * 100, 1), (7, "u", "y" * 100, 1), (None, "u", "y" * 100, 1), (None, "v", "z" * 200, 1),
            (-9, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n" * 9, 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    archive = warc.write_archive(df)
    assert archive.payloads.count() == len({r[2] or "" for r in rows})
    records = warc.read_records(archive)
    back = sorted(((r.id, bytes(r.payload)) for r in records.collect()), key=repr)
    assert back == sorted(((r[0], (r[2] or "").encode()) for r in rows), key=repr)
    for r in records.collect():
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        assert head + b"\r\n\r\n" == r.header.encode() and block.endswith(b"\r\n\r\n")
        assert f"Content-Length: {len(block) - 4}".encode() in head
    got = {(r.page_id, r.payload_bytes): r for r in warc.parse_records(records).collect()}
    n = len(big.encode())
    assert got[1, n].record_type == "response" and (got[3, n].record_type, got[3, n].refers_to) == ("revisit", 1)
    assert {got[4, 99].record_type, got[6, 99].record_type, got[2, 0].record_type, got[5, 0].record_type} == {"response"}
    assert got[7, 100].record_type == "response" and got[8, 100].refers_to == 7 and got[None, 100].refers_to == 7
    assert got[None, 200].record_type == "response" and got[None, 200].refers_to is None
    assert got[1, n].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert warc.parse_records(warc.read_records(warc.write_archive(df.limit(0)))).count() == 0


def test_warc_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "one\r\ntwo"), (2, "http://b", "three")], "page_id bigint, url string, html string")
    warc.export_warc(warc.write_archive(df), str(tmp_path / "w"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert text.count(b"WARC/1.1\r\n") == 2 and b"one\r\ntwo\r\n\r\n" in text


def test_exported_payloads_stay_whatever_the_url_says(spark, tmp_path):
    big = "naïve " * 40
    rows = [(1, "http://a/?q=WARC-Type: revisit", "twelve bytes"), (2, "http://b/", big), (3, "http://c/", big)]
    archive = warc.write_archive(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    warc.export_warc(archive, str(tmp_path / "w"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert b"Content-Length: 12\r\n\r\ntwelve bytes\r\n\r\n" in text
    assert text.count(big.encode()) == 1 and text.count(b"WARC/1.1\r\n") == 3


def _targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        rest, left = total - sum(done.values()), [s for s in names if s not in done]
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if share[s] >= cap * sizes[s]]
        if not over:
            return done | share
        done |= {s: cap * sizes[s] for s in over}


def test_mixing_targets_and_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(0, 300)), str(rng.choice(["a", "b", "Z", "é", "z"], p=[.8, .05, .05, .05, .05])), 1) for i in range(3000)]
    rows += [(5000, "a b\x0bc\x1cd\xa0e", None, 1), (None, None, "empty", 1), (None, "x y", "a", 1), (7, rows[7][1], rows[7][2], 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, rate int")
    out = mixing.mix_plan(df).toPandas()
    assert len(out) == len(rows)
    sizes = out.groupby(out.source.fillna("<null>"))["mix_size"].sum()
    sizes = {(None if k == "<null>" else k): int(v) for k, v in sizes.items()}
    want = _targets(sizes)
    for s, g in out.groupby(out.source.fillna("<null>")):
        key = None if s == "<null>" else s
        assert g.mix_target.iloc[0] == pytest.approx(want[key])
        taken = (g.mix_size * g.mix_copies).sum()
        if len(g) > 100:
            assert taken == pytest.approx(want[key], rel=0.1)
    assert out.mix_copies.max() <= 3 and out[out.doc_id == 5000].mix_size.iloc[0] == 3
    emitted = mixing.mix_documents(df)
    assert emitted.columns == df.columns and emitted.count() == out.mix_copies.sum()
    assert mixing.mix_plan(df).toPandas().equals(out) or sorted(mixing.mix_plan(df).toPandas().mix_copies) == sorted(out.mix_copies)
    assert mixing.mix_plan(df.limit(0)).count() == 0


def test_packing_against_plain_tokenizer(spark):
    path = queries.default_tokenizer()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = ["", None, " \n ", "İstanbul ΑΣ Σ. é a\xa0b\x1cc\x85d d <|endoftext|> x<|startoftext|>y don't it's 12ab3 ß ẞ µ ª ﬁ 你好 ́x é", "A'S 'LL !!'s ...a...",
           "word " * 20_000, "x" * 5000, "¿qué? ×÷ Äß ÄSS", "a" * 4095 + " b", "\x00\x1b\x7f[]~"]
    extra = [(10_000 + i, t) for i, t in enumerate(odd)] + [(None, "null id"), (10_003, odd[3])]
    df = docs.union(spark.createDataFrame(extra, "doc_id bigint, text string")).selectExpr("*", "1 AS piece", "2 AS length")
    got = packing.pack_documents(df, path).toPandas()
    tok = Tokenizer.from_file(path)
    want = []
    for r in df.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want.append((r.doc_id, p, at, len(part), zlib.crc32(part.tobytes())))
    have = [(None if np.isnan(d) else int(d), *map(int, rest)) for d, *rest in
            got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(have, key=str) == sorted(want, key=str)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        ends = g.offset + g.length
        assert g.offset.tolist() == [0, *ends.tolist()[:-1]] and ends.max() <= 4096
    assert packing.pack_documents(df.limit(0), path).count() == 0
    with_ids = packing.pack_documents(df.where("doc_id = 10003"), path, with_ids=True).first()
    assert list(with_ids.ids) == tok.encode(odd[3], add_special_tokens=False).ids + [1]


def test_packing_fills_sequences(spark):
    got = queries.QUERIES["op7_packing"](spark, "/root/testdata/sf0.1").toPandas()
    parts = (got.sequence_id.to_numpy() >> 36)
    for p in np.unique(parts):
        g = got[parts == p]
        assert g.sequence_id.nunique() <= 1.01 * np.ceil(g.length.sum() / 4096) + 1


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 9, 4, 1)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (2, 9)]
    assert fit.n_open == 0 and fit.bits == 0
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 8, 3, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0)]   # bin 1, the fullest, closed


def test_pipeline_stages_each_on_the_one_before(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, ids = docs.columns, {r.doc_id for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == cols and dict(out.dtypes) == dict(docs.dtypes), name
        out = out.cache()
        now = {r.doc_id for r in out.collect()}
        assert now <= ids
        if name == "quality_classifier":
            good = [d for d in ids if labels.get(d) == 1]
            assert len([d for d in good if d in now]) >= 0.97 * len(good) and len(now) < len(ids)
        if name == "substring_dedup":
            assert now == ids and all(r.n_chars == len(r.text) for r in out.collect())
        docs, ids = out, now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == ids
    assert corpus_pipeline.run(spark, SF_SMALL).count() == packed.count()


def test_pipeline_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0)], docs.schema)
    for rows in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF_SMALL)
        rows.collect()
