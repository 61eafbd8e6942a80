"""Spelling variants against brute force on whole words."""

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np

from tests.conftest import SF_SMALL
from tidemill.llm import queries, spelling

LETTERS = set(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))


def _vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c in LETTERS:
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                n[run] += len(run) >= 6
            run = ""
    return {w: k for w, k in n.items() if k >= 5}


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_force(rows):
    n = _vocabulary(rows)
    near = {w: [x for x in n if _one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_force(rows)
    assert sum(r[1] is not None for r in want) >= 10
    assert _got(queries.QUERIES["op13_spelling_variants"](spark, SF_SMALL)) == want


def test_dense_vocabulary_at_any_alphabet(spark, monkeypatch):
    rng = random.Random(3)
    words = {"".join(rng.choice("abéß÷") for _ in range(rng.choice([6, 6, 7, 7, 8, 30]))) for _ in range(220)}
    words |= {w[:i] + c + w[i + 1:] for w in list(words)[:40] for i in (0, 3, len(w) - 1) for c in "aé"}
    words |= {w[:3] + w[3] + w[3:] for w in list(words)[:40]}
    counts = {w: rng.choice([5, 6, 30, 160, 800]) for w in sorted(words)}
    want = {(a, b) for a in counts for b in counts if _one_edit(a, b)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    for symbols, bits in ((1, 6), (2, 25), (16, 6), (16, 25)):
        pairs = [(r.word, r.near) for r in spelling.near_words(vocab, symbols, bits).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want, (symbols, bits)
    monkeypatch.setattr(spelling, "_CELLS", 64)     # long words in many blocks
    table = spelling.symbol_table(4)
    word = [b"aababbba" * 40]
    small = [c for _, cs in spelling.neighbour_codes(word, table, 4) for c in cs.tolist()]
    monkeypatch.setattr(spelling, "_CELLS", 1 << 20)
    assert sorted(small) == sorted(c for _, cs in spelling.neighbour_codes(word, table, 4) for c in cs.tolist())


def _joins(df):
    """The joins as Spark plans them before it has run anything."""
    return [line for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]


def test_tables_of_words_are_not_broadcast(spark):
    """Neighbours found are many times the words by whose table Spark sizes them."""
    words = ["".join(w) for w in product("ab", repeat=6)]
    near = spelling.near_words(spark.createDataFrame([(w, 9) for w in words], "word string, n bigint"))
    joins = _joins(near)
    assert len(joins) == 1 and "SortMergeJoin" in joins[0], joins
    assert near.count() == 6 * len(words)
    joins = _joins(spelling.spelling_forms(spark.createDataFrame([(1, "colour " * 50 + "colours " * 5)], "doc_id bigint, text string")))
    assert len(joins) == 2 and all("SortMergeJoin" in j for j in joins), joins


def test_neighbourhood_is_full_and_once():
    table = spelling.symbol_table(3)
    letter = {}
    for b in b"abcdefgh":
        letter.setdefault(int(table[b]), bytes([b]))
    assert set(letter) == {1, 2, 3}
    for w in (b"aabbab", b"cccccc", b"abcabcab"):
        sym = [int(table[b]) for b in w]
        made = {tuple(sym)} | {tuple(sym[:i] + sym[i + 1:]) for i in range(len(sym))}
        made |= {tuple(sym[:i] + [a] + sym[i + 1:]) for i in range(len(sym)) for a in (1, 2, 3)}
        made |= {tuple(sym[:i] + [a] + sym[i:]) for i in range(len(sym) + 1) for a in (1, 2, 3)}
        want = spelling.reduced_codes([b"".join(letter[s] for s in m) for m in made], table)
        got = [c for _, cs in spelling.neighbour_codes([w], table, 3) for c in cs.tolist()]
        assert len(got) == len(made) and set(got) == set(want.tolist())


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_BLOCK", 16)
    rows = [(1, "colour " * 50 + "COLOUR"), (2, "color, " * 300), (None, "colour\x00colours " * 9), (3, None), (4, ""), (5, "日本語 colours" * 7),
            (5, "colourſcolours"), (6, "x" * 5000 + " " + ("y" * 3000 + " ") * 6), (6, "ÀÉÏÕÚ× àéïõú÷ " * 8), (7, "ab cd " * 90)]
    rows += [(8, "brown-fox centre center centré " * 6)] * 3
    rows += [(9, "aardvark " * 130 + "aardvarks " * 26 + "aardwarks " * 5)]     # a chain of forms
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, word string")
    want = brute_force(rows)
    assert ("aardwarks", "aardvarks", "aardvark") in {r[:3] for r in want}
    assert _got(spelling.spelling_forms(df)) == want
    assert spelling.spelling_forms(df.limit(0)).count() == 0
    big = "colour" * 3 + " " + "tantrum " * 40
    assert list(spelling._blocks(big.encode())) and b"".join(spelling._blocks(big.encode())) == big.encode()


def test_symbols_take_turns():
    table = spelling.symbol_table(16)
    used = np.bincount(table[ord("a"):ord("z") + 1].astype(int), minlength=17)[1:]
    assert used.min() >= 1 and used.max() <= 2
