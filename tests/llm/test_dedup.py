"""SimHash, substring and embedding near-dedup, components, nearest neighbours."""

import re

import numpy as np
import xxhash

from tests.conftest import SF_SMALL
from tidemill.llm import ann, embed_dedup, queries, simhash, substring
from tidemill.llm.components import connected_components


def _labels(ids, i, j):
    lab = np.array(ids)
    while True:
        new = lab.copy()
        np.minimum.at(new, i, lab[j])
        np.minimum.at(new, j, lab[i])
        if (new == lab).all():
            return lab
        lab = new


def test_components_against_union(spark):
    rng = np.random.default_rng(0)
    n = 3000
    i, j = rng.integers(0, n, 2200), rng.integers(0, n, 2200)
    i = np.r_[i, np.arange(400, 700), np.full(500, 7), 5]       # a long chain, a star, a loop
    j = np.r_[j, np.arange(401, 701), np.arange(1000, 1500), 5]
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(i, j)], "u bigint, v bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    want = _labels(np.arange(n), i, j)
    touched = set(i[i != j].tolist()) | set(j[i != j].tolist())
    assert got == {x: int(want[x]) for x in touched}
    assert connected_components(edges.limit(0)).count() == 0


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(sh))


def test_simhash_query_against_brute_force(spark):
    got = queries.QUERIES["op8_simhash_near_dedup"](spark, SF_SMALL).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().sort_values("doc_id")
    fp = np.array([_fingerprint(t) for t in docs.text], dtype=np.uint64)
    assert [int(x, 16) for x in got.fingerprint] == fp.tolist()
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    assert got.component_id.tolist() == _labels(docs.doc_id.to_numpy(), i, j).tolist()


def test_simhash_edges(spark):
    rows = [(5, "a b c d", 1), (3, "A  b\nc d", 1), (None, "a b c d", 1), (9, None, 1), (8, "", 1), (7, " \t", 1), (2, "one two", 1),
            (2, "one two", 1), (None, "lonely words here", 1), (4, "w " * 200_000, 1), (6, "a\x1cb\x85c\xa0d", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root int")
    out = simhash.simhash_components(df).select("doc_id", "fp", "component_id").collect()
    assert len(out) == len(rows)
    comp = {r.doc_id: r.component_id for r in out if r.doc_id is not None}
    assert comp == {5: 3, 3: 3, 9: 7, 8: 7, 7: 7, 2: 2, 4: 4, 6: 6}
    assert {r.component_id for r in out if r.doc_id is None} == {3, None}
    assert all(r.fp == 0 for r in out if r.doc_id in (7, 8, 9))
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 3, 4, 6, 7, None]
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_simhash_tiles_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(base.tolist()) | {0, 1, 2**64 - 1}
    for b in base.tolist():
        for k in range(1, 5):   # up to 4 bits: links and near misses
            fps.add(b ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)))
    fps = np.array(sorted(fps), dtype=np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    want = _labels(fps.view(np.int64), i, j)
    for segments, tile in ((4, 1024), (4, 2), (8, 16), (1, 8)):
        comp = {r.node: r.root for r in connected_components(simhash.fingerprint_links(df, 3, segments, tile)).collect()}
        assert [comp.get(x, x) for x in fps.view(np.int64).tolist()] == want.tolist()


def _words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n))


def test_substring_passages_are_caught_and_clean_texts_left_alone(spark):
    rng = np.random.default_rng(4)
    passages = [_words(rng, 60) for _ in range(12)]
    rows, planted = [], {}
    for d in range(120):
        parts = [_words(rng, int(rng.integers(20, 200)))]
        if d % 3 == 0:
            planted[d] = passages[d // 3 % 12]
            parts += [planted[d], _words(rng, 40)]
        rows.append((d, " ".join(parts), "x", 0))
    line = "the same short line"
    rows += [(200 + i, _words(rng, 30) + "\n" + line, "x", 0) for i in range(5)] + [(300, "Of " * 4000, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, place int")
    out = {r.doc_id: r for r in substring.dedup_substrings(df).collect()}
    assert len(out) == len(rows)
    first = {p: min(d for d, q in planted.items() if q == p) for p in passages}
    for d, text, *_ in rows:
        if d in planted and first[planted[d]] != d:
            left = out[d].text.encode()
            assert planted[d] not in out[d].text and len(left) < len(text.encode()) - 100
            cut = b"".join(text.encode()[s.s:s.e] for s in out[d].substring_spans)
            assert cut.strip() in planted[d].encode() and len(cut) + len(left) == len(text.encode())
        else:
            assert out[d].text == text and out[d].substring_spans is None


def test_substring_edges(spark):
    long = " ".join(f"w{i}x" for i in range(60_000))
    rows = [(4, long), (2, long), (2, long), (None, long), (None, "short"), (7, None), (8, ""), (9, "é" * 5000), (10, "é" * 5000),
            (2, "other " + " ".join(f"v{i}" for i in range(100)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sorted(((r.doc_id, r.text) for r in substring.dedup_substrings(df).collect()), key=str)
    texts = [t for d, t in out if d == 2]
    assert texts.count(long) == 2 and len(texts) == 3      # rows of one id do not cut each other
    by = {d: t for d, t in out}
    assert by[4] == "" and by[7] is None and by[8] == ""
    assert sorted((t for d, t in out if d is None)) == ["", "short"]
    assert by[9] == "é" * 5000 and by[10] == ""               # without white space every chunk counts as a word
    assert substring.dedup_substrings(df.limit(0)).count() == 0


def test_substring_passages_without_white_space(spark):
    rng = np.random.default_rng(6)
    alphabets = {"han": [chr(c) for c in range(0x4E00, 0x5200)], "thai": [chr(c) for c in range(0x0E01, 0x0E2F)],
                 "base64": list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")}
    rows, passages = [], {}
    for k, (name, chars) in enumerate(alphabets.items()):
        draw = lambda n: "".join(rng.choice(chars, n))
        passages[name] = draw(500)
        for i, front in enumerate((0, 40, 41, 333)):   # the same passage at four offsets
            rows.append((10 * k + i, draw(front) + passages[name] + draw(90), name))
        rows += [(10 * k + 5, whole := draw(150), name), (10 * k + 6, whole, name), (10 * k + 7, draw(800), name)]
    joined = ["\u3000".join(_words(rng, 60).split()) for _ in range(2)]
    rows += [(100, joined[0], "joined"), (101, "x\u3000" + joined[0] + joined[1], "joined")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    out = {r.doc_id: r for r in substring.dedup_substrings(df).collect()}
    for d, text, kind in rows:
        cut = "".join(text.encode()[s.s:s.e].decode() for s in out[d].substring_spans or [])
        if kind == "joined":
            assert len(cut) > 200 and cut in joined[0] if d == 101 else not cut
        elif d % 10 in (0, 5, 7):
            assert out[d].text == text
        elif d % 10 == 6:
            assert out[d].text == ""
        else:
            assert any(cut in t for e, t, _ in rows if e < d) and len(cut.encode()) > len(passages[kind].encode()) - 200


def test_substring_runs_stand_in_one_earlier_document(spark):
    rng = np.random.default_rng(8)
    lines = [_words(rng, 8) + "\n" for _ in range(40)]
    rows = [(d, "".join(rng.permutation(lines)[:12])) for d in range(300)]      # forms of stock lines
    rows += [(1000 + d, _words(rng, 30) + "\n" + "".join(rows[d][1]) + _words(rng, 30)) for d in range(0, 300, 10)]
    out = {r.doc_id: r for r in substring.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for d, text in rows:
        raw, spans = text.encode(), out[d].substring_spans or []
        earlier = [t for e, t in rows if e < d]
        for s in spans:  # every word removed stands among 16 that one earlier document holds
            words = raw[s.s:s.e].decode().split()
            assert len(words) >= 16
            held = np.zeros(len(words), bool)
            for i in range(len(words) - 15):
                if any(" ".join(words[i:i + 16]) in " ".join(t.split()) for t in earlier):
                    held[i:i + 16] = True
            assert held.all()
        if d >= 1000:
            assert sum(s.e - s.s for s in spans) > 0.6 * len(rows[d - 1000][1])


def test_windows_against_brute_force():
    rng = np.random.default_rng(9)
    text = "\n ".join(_words(rng, int(n)) for n in rng.integers(1, 30, 20)).encode() + b" " * 700 + _words(rng, 40).encode()
    ends = substring.chunk_texts([text])[0]
    got = set(zip(*(x.tolist() for x in substring._windows(text, ends, 16))))
    blank = [e for s, e in zip([0, *ends], ends) if not text[s:e].strip()]
    at = [0, *(e for e, f in zip(ends, [*ends[1:], 0]) if f not in blank)]
    enough = [(s, e) for s in at for e in at if s < e and len(text[s:e].split()) >= 16]
    assert blank and got == {min(w for w in enough if w[0] == s) for s, _ in enough} | {max(w for w in enough if w[1] == e) for _, e in enough}
    assert [len(x) for x in substring._windows(b"", [], 16)] == [0, 0]


def test_chunks_shift_with_insertions():
    rng = np.random.default_rng(2)
    text = _words(rng, 2000).encode()
    moved = b"some new words in front " + text
    a, b = ({t[s:e] for s, e in zip([0, *c], c)} for t, c in ((x, substring.chunk_texts([x])[0]) for x in (text, moved)))
    assert len(a & b) > 0.98 * len(a)
    ends = substring.chunk_texts([text, b"", moved])
    assert ends == [substring.chunk_texts([text])[0], [], substring.chunk_texts([moved])[0]] and ends[0][-1] == len(text)


def test_simhash_dedup_keeps_the_same_of_rows_that_differ_elsewhere(spark):
    rows = [(1, "one two three four", s) for s in ("c", "a", None, "b", "a")] + [(2, "one two three four", "z"), (3, "other words are here now", "q")]
    kept = set()
    for seed in range(4):
        shuffled = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
        df = spark.createDataFrame(shuffled, "doc_id bigint, text string, source string").repartition(seed + 1)
        kept.add(tuple(sorted(tuple(r) for r in simhash.simhash_dedup(df).collect())))
    assert len(kept) == 1 and [r[0] for r in kept.pop()] == [1, 3]


def test_written_tables_go_with_the_scratch_list(spark):
    from tidemill.llm._common import staged
    from tidemill.session import drop_scratch, scratch_mark
    mark = scratch_mark()
    first, second = (staged(spark.range(5), n) for n in ("first", "second"))
    folders = [f.rsplit("/", 1)[0] for f in first.inputFiles()[:1] + second.inputFiles()[:1]]
    drop_scratch(spark, since=mark, keep_last=1)
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = [path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(f)) for f in folders]
    assert there == [False, True] and second.count() == 5 and scratch_mark() == mark + 1


def _embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 64))
    copies = np.repeat(base[:30], 6, axis=0) + rng.normal(size=(180, 64)) * rng.choice([0.05, 0.3, 0.35], size=(180, 1))
    x = np.vstack([base, copies, np.repeat(base[:1], 40, axis=0), 3 * base[5:6]]).astype(np.float32)
    rows = [(i, v.tolist(), "l") for i, v in enumerate(x)]
    bad = [None, [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [], [1.0] * 3]
    rows += [(10_000 + i, v, "l") for i, v in enumerate(bad)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, node string"), x.astype(np.float64)


def test_embedding_near_dups_against_brute_force(spark):
    df, x = _embeddings(spark)
    out = embed_dedup.near_duplicates(df).toPandas().sort_values("vec_id").reset_index(drop=True)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    n = len(x)
    assert out.n_links[:n].tolist() == near.sum(1).tolist()
    assert out.component_id[:n].tolist() == _labels(np.arange(n), *np.nonzero(near)).tolist()
    assert (out.n_links[n:] == 0).all() and (out.component_id[n:] == out.vec_id[n:]).all() and out.kept[n:].all()
    assert (out.kept == (out.vec_id == out.component_id)).all()
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
    one = spark.createDataFrame([(None, [1.0] * 64), (None, [1.0] * 64), (3, [2.0] * 64)], "vec_id bigint, embedding array<float>")
    got = embed_dedup.near_duplicates(one).collect()
    assert {r.n_links for r in got} == {2} and {r.component_id for r in got} == {3}


def test_embedding_links_with_and_without_a_decaying_spectrum(spark):
    """Thousands of partners just above the threshold, of doubles, scattered evenly or along few directions."""
    for spectrum in (np.ones(64), 1 / np.arange(1, 65)):
        rng = np.random.default_rng(11)
        base = rng.normal(size=(1500, 64)) * spectrum
        q = base / np.linalg.norm(base, axis=1, keepdims=True)
        parts = [q]
        for k in range(3):
            z = rng.normal(size=q.shape) * (spectrum if k else 1)
            z -= (z * q).sum(1, keepdims=True) * q
            z /= np.linalg.norm(z, axis=1, keepdims=True)
            parts.append(0.951 * q + np.sqrt(1 - 0.951**2) * z)
        x = np.vstack(parts) * rng.uniform(0.5, 2, size=(6000, 1))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
        out = embed_dedup.near_duplicates(df).toPandas().sort_values("vec_id")
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = u @ u.T >= 0.95
        np.fill_diagonal(near, False)
        want = near.sum(1)
        assert want.sum() > 8000
        assert (out.n_links.to_numpy() <= want).all() and out.n_links.sum() >= 0.9995 * want.sum()


def test_signs_of_partners_differ_little():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(20_000, 64)) / np.arange(1, 65)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = embed_dedup._partners(a, rng.normal(size=a.shape), 0.95)
    assert np.allclose((a * b).sum(1), 0.95)
    planes = rng.normal(size=(64, embed_dedup.SIGNS))
    x, y = (embed_dedup.sign_words(m, planes).view("<u8") for m in (a, b))
    assert np.bitwise_count(x ^ y).sum(1).max() <= embed_dedup.signs_that_differ(0.95) < 40


def test_walk_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(0)
    a, book = rng.normal(size=(300, 8)), rng.normal(size=(20, 8))
    own, low = embed_dedup.bounds(a, book)
    d = ((a[:, None] - a[None]) ** 2).sum(-1)
    assert (low[:, own] <= d + 1e-9).all()


def test_nearest_against_brute_force(spark):
    df, x = _embeddings(spark)
    out = ann.nearest(df).toPandas()
    for q in range(0, len(x), 20):
        s = x @ x[q]
        cand = np.array([i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20])
        got = out[out.query_id == q].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21))
        exact = np.array([(x[q] * x[v]).sum() for v in got.vec_id])
        assert np.array_equal(got.score.to_numpy(), exact)
        assert len(set(got.vec_id) & set(cand.tolist())) >= 18
    few = spark.createDataFrame([(0, [1.0] * 64), (1, [2.0] * 64), (2, [2.0] * 64), (20, None), (None, [1.0] * 64)],
                                "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(few).orderBy("rank").collect()] == [(0, 1, 1, 128.0), (0, 2, 2, 128.0)]
    assert ann.nearest(few.limit(0)).count() == 0


def _joins(df):
    """The joins as Spark plans them before it has run anything."""
    return [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]


def test_nearest_shuffles_copies_of_queries_once_a_bucket(spark, monkeypatch):
    """Copies of the queries' vectors are not broadcast, few in a wide window, and meet all of it."""
    monkeypatch.setattr(ann, "TILES", (8, 16))
    n, k = 2_000, 5
    x = np.random.default_rng(4).normal(size=(n, 64))
    rows = ann.staged(spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "node bigint, vec_id bigint, vec array<double>"), "t")
    curves = ann._curves(64, 3)[:1]
    tiles = ann.ordered_tiles(rows, curves, ann._spans(rows, curves, 64), 64, 16, "double")
    rank = np.zeros(n, dtype=int)
    for t in tiles.select("start", "nodes").collect():
        rank[np.frombuffer(t.nodes, "<i8")] = t.start + np.arange(len(t.nodes) // 8)
    for window, bucket in ((40, 16), (800, 50)):
        plan = ann.Plan(1, window, 16, 0.0)
        found = ann._search(tiles, plan, 64, k, 20, "<f8")
        joins = [j for j in _joins(found) if "bucket" in j]
        assert len(joins) == 1 and "SortMergeJoin" in joins[0], joins
        assert plan.bucket == bucket
        best = {}
        for r in ann._merge(found, k).collect():
            best.setdefault(r.q, []).append(r.x)
        assert sorted(best) == list(range(0, n, 20))
        for q, got in best.items():
            s = x @ x[q]
            inside = np.sort(s[(np.abs(rank - rank[q]) <= window) & (np.arange(n) != q)])[-k:]
            assert len(set(got)) == k and (np.sort(s[got]) >= inside - 1e-9).all()   # whole tiles: the window's best or better
    few = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:100])], "vec_id bigint, embedding array<double>")
    assert "SortMergeJoin" in _joins(ann.nearest(few))[0]


def test_nearest_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES["op6_nearest_neighbours"](spark, sf).toPandas()
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.stack(t.embedding).astype(np.float64), t.vec_id.to_numpy()
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        true = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hit += len(true & set(out[out.query_id == ids[q]].vec_id))
        total += 20
    assert hit / total >= 0.9


def test_nearest_compares_no_more_than_an_exact_search(spark):
    """Vectors without structure stay within the exact search's work, clustered ones far below it."""
    n, share = 12_000, {}
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 64))
    for name, x in (("even", rng.normal(size=(n, 64))), ("clustered", centres[rng.integers(0, 300, n)] + 0.1 * rng.normal(size=(n, 64)))):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        rows = ann.staged(spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "node bigint, vec_id bigint, vec array<double>"), "t")
        curves = ann._curves(64, 3)
        spans = ann._spans(rows, curves, 64)
        plan = ann.measure(rows.where("vec_id % 20 = 0"), rows, curves, spans, n, 64, 20, 128, 0.97)
        tiles = ann.ordered_tiles(rows, curves[:plan.orderings], spans, 64, plan.tile, "double").select("curve", "start", "n", "ids").toPandas()
        assert tiles.n.sum() == n * plan.orderings and tiles.n.max() <= plan.tile
        compared = 0
        for _, t in tiles.groupby("curve"):
            assert sorted(t.start) == np.r_[0, np.cumsum(t.sort_values("start").n)][:-1].tolist()
            at = np.concatenate([s + np.flatnonzero(np.frombuffer(ids, "<i8") % 20 == 0) for s, ids in zip(t.start, t.ids)])
            compared += sum(int(((at + plan.window >= s) & (at - plan.window < s + m)).sum()) * m for s, m in zip(t.start, t.n))
        share[name] = compared / (n * n // 20)
    assert share["even"] <= 1.0 and share["clustered"] <= 0.5, share


def test_hilbert_curve_steps_to_neighbours():
    for d, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * d)).reshape(d, -1).T
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(side**d))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
