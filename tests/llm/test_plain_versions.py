"""op2 and op9 against plain Python versions of the whole query, row by row."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemill.llm import quality, queries, substring

SPACES = b"\t\n\x0b\x0c\r "


# ---------------------------------------------------------------- substring dedup

def _plain_cuts(t):
    """Byte by byte: the gear hash of the last 32 bytes, then chunks of 16 to 192 bytes."""
    gear = [int(g) for g in substring.GEAR]
    hits, last_space = set(), -32
    for i, b in enumerate(t):
        h = sum(gear[t[i - j]] << j for j in range(min(32, i + 1))) % (1 << 32)
        if b in SPACES:
            last_space = i
            if h >> 30 == 0:
                hits.add(i + 1)
        elif h < 1 << 27 and i - last_space >= 32:
            c = i + 1
            for _ in range(3):
                c += c < len(t) and t[c] & 0xC0 == 0x80
            hits.add(c)
    cuts, last = [], 0
    for c in [*sorted(h for h in hits if 0 < h < len(t)), len(t)]:
        while c - last > 192:
            space = max(t.rfind(b" ", last + 16, last + 192), t.rfind(b"\n", last + 16, last + 192))
            end = last + 192
            while space < 0 and end > last + 1 and t[end] & 0xC0 == 0x80:
                end -= 1
            last = space + 1 if space >= 0 else end
            cuts.append(last)
        if c - last >= 16 or (c == len(t) and c > last):
            cuts.append(c)
            last = c
    return cuts


def _plain_windows(t):
    pieces, last = [], 0
    for c in _plain_cuts(t):
        words = sum(1 if len(w) <= 20 else math.ceil(len(w) / 8) for w in t[last:c].split())
        if words or not pieces:
            pieces.append([last, c, words])
        else:
            pieces[-1][1] = c
        last = c
    out = set()
    for i in range(len(pieces)):
        for j in range(i, len(pieces)):      # the fewest pieces from i on
            if sum(p[2] for p in pieces[i:j + 1]) >= 16:
                out.add((pieces[i][0], pieces[j][1]))
                break
        for j in range(i, -1, -1):           # and up to i
            if sum(p[2] for p in pieces[j:i + 1]) >= 16:
                out.add((pieces[j][0], pieces[i][1]))
                break
    return out


def test_substring_query_against_plain_python(spark):
    rows = sorted((r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
                  .where("length(text) < 6000").select("doc_id", "text").collect())
    windows = {d: _plain_windows(t) for d, t in rows}
    first = {}
    for d, t in rows:
        for a, b in windows[d]:
            first.setdefault(t[a:b], d)
    want = {}
    for d, t in rows:
        gone = bytearray(len(t))
        for a, b in windows[d]:
            if first[t[a:b]] < d:
                gone[a:b] = b"\1" * (b - a)
        want[d] = bytes(c for c, g in zip(t, gone) if not g).decode()
    docs = spark.createDataFrame([(d, t.decode()) for d, t in rows], "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.text for r in substring.dedup_substrings(docs).collect()}
    assert got == want
    assert sum(len(want[d].encode()) < len(t) for d, t in rows) >= 5      # something was removed


# ---------------------------------------------------------------- quality classifier

def _plain_buckets(text):
    tokens, out = quality._TOKENS.findall(text.lower()), []
    ids = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in tokens]
    ids = [quality._SAME if i and ids[i] == ids[i - 1] else x for i, x in enumerate(ids)]
    mask = (1 << 64) - 1
    out += [(x * 0x94D049BB133111EB & mask) >> 48 for x in ids]
    out += [((a * 0x9E3779B97F4A7C15 + b) * 0xBF58476D1CE4E5B9 & mask) >> 48 for a, b in zip(ids, ids[1:])]
    return Counter(x % quality.BUCKETS for x in out)


def test_quality_query_against_plain_python(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    label = {}
    for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect():
        if r.doc_id is not None and r.quality is not None:
            label[r.doc_id] = min(label.get(r.doc_id, 1), int(r.quality > 0))
    grams = [_plain_buckets(t) for _, t in docs]
    raw, target = Counter(), Counter()
    for (d, _), g in zip(docs, grams):
        raw.update(g)
        if label.get(d) == 1:
            target.update(g)
    share = sum(target.values()) / max(1, sum(raw.values()))

    def weight(g, own=False):
        return sum(n * (math.log(target[b] - own * n + 5.0) - math.log(raw[b] * share + 5.0)) for b, n in g.items())

    held = sorted((weight(g, label[d] == 1), label[d]) for (d, _), g in zip(docs, grams) if d in label)
    wrong = {i: sum(q for _, q in held[:i]) + sum(1 - q for _, q in held[i:]) for i in range(1, len(held)) if held[i][0] > held[i - 1][0]}
    best = min(wrong.values())
    cut_at = max((i for i in wrong if wrong[i] == best), key=lambda i: (held[i][0] - held[i - 1][0], -i))
    cut = (held[cut_at][0] + held[cut_at - 1][0]) / 2
    got = {r.doc_id: r for r in queries.QUERIES["op9_quality_classifier"](spark, SF_SMALL).collect()}
    noise = {r.doc_id: r.g for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
             .select("doc_id", quality._gumbel(11, F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("g")).collect()}
    weights = {d: weight(g) for (d, _), g in zip(docs, grams)}
    k = sum(w >= cut for w in weights.values())
    keys = {d: w + noise[d] for d, w in weights.items()}
    kept = set(sorted(keys, key=lambda d: -keys[d])[:k])
    for d, g in zip((d for d, _ in docs), grams):
        assert got[d].n_ngrams == sum(g.values())
        assert got[d].log_weight == pytest.approx(weights[d], rel=1e-9, abs=1e-9)
        assert got[d].gumbel_key == pytest.approx(keys[d], rel=1e-9, abs=1e-9)
    assert {d for d, r in got.items() if r.kept} == kept and 0 < len(kept) < len(docs)
