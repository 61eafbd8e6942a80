"""Conversation prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from tests.conftest import SF_SMALL
from tidemill.llm import prefix_trie, queries

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _rebuilt(rows, group=5, heads=9):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            tid = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[r[0]].append(((r[1] is not None, r[1] or 0, tid), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_force(rows):
    convs = _rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def _got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def _rows(seed, n=240):
    rng = random.Random(seed)
    rows = []
    for c in range(-12, n):
        if rng.random() < 0.1:
            continue
        k = rng.choice([1, 1, 2, 3, 5, 12])
        if rng.random() < 0.4:      # one conversation holds a large share of all
            rows += [(c, t, "user", f"hot {t}") for t in range(k)]
        else:
            rows += [(c, rng.choice([t, None, 3]), rng.choice(["user", None, "", "bot"]), rng.choice([None, "", "é", f"t{rng.randrange(3)}", f"u{c}"]))
                     for t in range(k)]
    rows += [(None, 1, "user", "nobody's")] + rows[:7]
    rng.shuffle(rows)
    return rows


def test_trie_against_brute_force(spark):
    for seed, cells in ((0, 1 << 20), (1, 40), (2, 1)):   # one tile a shard, some, and one a row
        rows = _rows(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn int, role string, text string, path int").repartition(3)
        assert _got(prefix_trie.conversation_trie(df, cells=cells)) == brute_force(rows), seed


def test_trie_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(queries.QUERIES["op11_conversation_trie"](spark, SF_SMALL)) == brute_force(rows)


def test_trie_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert prefix_trie.conversation_trie(empty).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    turnless = [(c, 0, "u", "x") for c in range(1, 5)]    # no conversation 0: what comes from it is nothing
    assert _got(prefix_trie.conversation_trie(spark.createDataFrame(turnless, schema))) == brute_force(turnless)
    long = [(0, t, "u", f"{t % 7}" * 50) for t in range(900)] + [(5, t, "u", f"{t % 7}" * 50) for t in range(899)]
    long += [(7, 0, "u", "y" * 300_000)]
    assert _got(prefix_trie.conversation_trie(spark.createDataFrame(long, schema))) == brute_force(long)


def test_tile_counts_a_whole_matrix():
    """A single tile holds every node as a part or whole; lengths past the padding make no node."""
    a, b = b"\1" * 16, b"\2" * 16
    paths = [a + b, a, a + b, b, b""]
    nodes, rows, _ = prefix_trie.tile_nodes(np.array([9, 8, 7, 6, 5]), paths, [np.full(len(p) // 16, 3) for p in paths],
                                            np.array([False, True, False, False, False]))
    assert nodes["conv_id"].tolist() == [7, 7] and nodes["depth"].tolist() == [1, 2]
    assert nodes["n_convs"].tolist() == [3, 2] and nodes["n_children"].tolist() == [2, 0]
    parts = {(r["depth"], r["conv_id"]): r for r in rows if r["kind"] == prefix_trie.PART}
    assert set(parts) == {(0, 5), (1, 6)} and parts[0, 5]["n_convs"] == 5
