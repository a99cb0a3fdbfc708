"""Importance resampling: features, selection and draws against plain versions and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import lower
from oracle_harness import compare

from tessera.llm import importance
from tessera.llm.queries import ORACLES, QUERIES

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, ngram):
    w = WORD.findall(lower(text))
    return [b" ".join(w[k : k + n]) for n in range(1, ngram + 1) for k in range(len(w) - n + 1)], len(w)


def plain(docs, target, share=(10, 100), least=20, ngram=1, buckets=10_000, seed="2024"):
    """Rows ``(id, n_features, weight, score, rank)`` in the order of ``docs``."""
    of = lambda texts: Counter(zlib.crc32(f) % buckets for t in texts for f in runs(t, ngram)[0])
    s, t = of(x for _, x in docs), of(target)
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t)))
    out = []
    for i, x in docs:
        found, words = runs(x, ngram)
        weight = sum(gain(zlib.crc32(f) % buckets) for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: share[0] * len(able) // share[1]]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def some_texts(n, seed=3):
    rnd = random.Random(seed)
    return [" ".join("".join(rnd.choice("aAbé1日") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("ngram", [1, 3])
def test_features_match_crc_of_every_run(ngram):
    texts = [*some_texts(200), "x" * 500 + " y " + "Z" * 70, "", "..."]
    row, bucket, words = importance.features(texts, ngram, 9973)
    want = [(i, zlib.crc32(f) % 9973) for i, t in enumerate(texts) for f in runs(t, ngram)[0]]
    assert sorted(zip(row.tolist(), bucket.tolist())) == sorted(want)
    assert words.tolist() == [runs(t, 1)[1] for t in texts]


@pytest.mark.parametrize("ngram", [1, 2])
def test_draw_matches_plain_version_with_odd_rows(spark, ngram):
    texts = some_texts(150)
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[7]), (-5, texts[9]), (None, texts[3]), (None, texts[3] + " more"), (500, None), (501, ""), (502, "word " * 9000)]
    target = [*some_texts(20, 8), None, ""]
    df = spark.createDataFrame([(i, t, 1, "x", 2.0, 3) for i, t in docs], "doc_id long, text string, place int, id string, score double, bucket int")
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), share=(30, 100), least_words=15, ngram=ngram, buckets=300)
    key = lambda r: [(x is None, x or 0) for x in r]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain(docs, target, (30, 100), 15, ngram, 300), key=key)


def test_cutoff_is_the_exact_key_through_many_rounds(spark, monkeypatch):
    """Small blocks and no early end: every k is found, among equal scores and a third of equal ids too."""
    monkeypatch.setattr(importance, "BLOCK", 37)
    rnd = random.Random(1)
    rows = [(rnd.choice([0, 0, 5, rnd.randint(-50, 50)]), rnd.choice([None, 1, 1, rnd.randint(0, 30)]), p) for p in range(900)]
    keys = spark.createDataFrame(rows, "score long, id long, place long").repartition(7)
    order = sorted(rows, key=importance._rank_key)
    for k in (1, 2, 333, 899, 900):
        assert importance.cutoff(keys, k, 900, finish=60) == order[k - 1]
    assert importance.cutoff(keys, 0, 900) is None and importance.cutoff(keys.limit(0), 3, 0) is None


def test_the_pivot_discards_a_quarter(spark, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 50)
    rows = [(s, s, s) for s in range(2000)]  # sorted blocks are the worst case
    found = importance.medians(spark.createDataFrame(rows, "score long, id long, place long").coalesce(1))
    assert sum(n for _, n in found) == 2000 and max(n for _, n in found) <= 50
    below = importance.weighted_median(found)[0]
    assert 500 <= below <= 1500


def test_empty_tables_and_nothing_eligible(spark):
    docs = spark.createDataFrame([(1, "few words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert [r["rank"] for r in importance.resample(docs, none).collect()] == [None, None]
    assert importance.resample(none, docs).count() == 0
    assert {tuple(r) for r in importance.resample(docs, none, least_words=0).collect()} == set(plain([(1, "few words"), (2, None)], [], least=0))


def test_gains_are_whole_numbers_rounded_down():
    g = importance.gains(np.array([9, 0]), np.array([0, 9]))
    assert g.tolist() == [math.floor(1000 * math.log(1 / 10)), math.floor(1000 * math.log(10))]


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    r = compare(spark, "op12_importance", QUERIES["op12_importance"](spark, sf), ORACLES["op12_importance"], sf)
    assert r["ok"], r
