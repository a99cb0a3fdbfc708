"""Conversation trie: against a plain trie and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from oracle_harness import compare

from tessera.llm import trie
from tessera.llm.queries import ORACLES, QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, group=100, heads=6):
    """Nodes of ``[(conv_id, turn, role, text)]``."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), (r or "", x or "")))
    turns = {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in own.items()}
    members, paths = defaultdict(list), {}
    for c, w in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        paths[c] = tuple(turns.get(base, [])[:h] + w[h:])
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) if children[p] else 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if paths[c] == p).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], digest(p)) for p, m in members.items()), paths


def conversations(n, seed, deep=0):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-150, 400), n):
        hot = rnd.random() < 0.35  # a third of the conversations are one and the same
        turns = [("user", "hi"), ("bot", "hello 日本")] if hot else [(rnd.choice(["user", "bot", None]), rnd.choice(["a", "bb", "", None, "hi"])) for _ in range(rnd.choice([1, 2, 3, 9, deep or 5]))]
        start = rnd.choice([None, 0])
        rows += [(c, start if k == 0 else k, r, x) for k, (r, x) in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


def result(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, path string, base int")
    out = trie.prefix_trie(df, **kw)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))


@pytest.mark.parametrize("seed,deep,width,block", [(1, 0, 16, 100_000), (2, 40, 3, 7), (3, 90, 16, 1)])
def test_trie_matches_plain_version(spark, monkeypatch, seed, deep, width, block):
    monkeypatch.setattr(trie.levels, "__defaults__", (width,))
    monkeypatch.setattr(trie, "BLOCK_ROWS", block)
    rows = conversations(160, seed, deep) + [(None, 1, "user", "no id"), (500, 3, "bot", "same"), (500, 3, "bot", "same")]
    assert result(spark, rows) == sorted(plain(rows)[0], key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))


def test_turnless_conversations_end_at_the_root(spark):
    ids = [c for c in range(101, 190) if zlib.crc32(str(c).encode()) % 6 >= 2][:3]
    rows = [(c, 0, "user", "gone") for c in ids]  # shorter than what they share, without a base
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert result(spark, rows) == [(ids[0], 0, None, 3, 0, 1, 0, want)]


def test_empty_table_and_long_texts(spark):
    assert result(spark, []) == []
    rows = [(100, k, "user", "é" * 50_000) for k in range(3)] + [(c, k, "user", "é" * 50_000) for c in (101, 102) for k in range(3)]
    assert result(spark, rows) == plain(rows)[0]


def test_levels_of_one_row_and_shared_paths():
    ids = np.array([1, 2, 3, 1, 2])
    found, first, last = trie.levels(ids, np.array([0, 3]), np.array([3, 2]), np.array([5, 6, 7, 5, 6]), np.array([4, 9]), np.array([1, 2]))
    assert (first, last) == (1, 0)
    assert [x.count.tolist() for x in found] == [[3], [3], [3], [1]]
    assert [x.end.tolist() for x in found] == [[-1], [-1], [1], [0]] and all(x.shared.all() for x in found)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    r = compare(spark, "op13_trie", QUERIES["op13_trie"](spark, sf), ORACLES["op13_trie"], sf)
    assert r["ok"], r


def test_rebuilding_takes_one_shuffle(spark):
    plan = trie.rebuilt(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "role" not in plan.split("Exchange")[0]
