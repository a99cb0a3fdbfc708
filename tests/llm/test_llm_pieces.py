"""SentencePiece coding: against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import pieces
from tessera.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGES = [(1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "▁x ▁▁ y"), (6, "日本語 🎉 don't\r\n x1234"), (6, "日本語 🎉 don't\r\n x1234"),
         (7, "a" * 3000), (8, "<s> </s> <0x41> <unk>"), (9, " " * 500 + "x" + " " * 33), (None, "no id"), (10, "word " * 4000), (11, "\x00é�")]


@pytest.fixture(scope="module")
def real():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def agenda():
    return pieces.Agenda(pieces.read_model(MODEL))


def test_edges_match_the_library(spark, real):
    docs = spark.createDataFrame([(i, t, 3, "x", "y", False) for i, t in EDGES], "doc_id long, text string, n_tokens int, ids string, decoded string, agrees boolean")
    rows = pieces.encode(docs, MODEL, check=True).collect()
    want = [(str(i), real.encode(t or "", add_eos=True)) for i, t in EDGES]
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in rows) == sorted(want)
    for r in rows:
        ids = list(r["ids"])
        assert r["agrees"] and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(real.decode(ids).encode()).hexdigest()
    empty = pieces.encode(docs.limit(0), MODEL)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_random_texts_streams_and_small_cache(real, agenda, monkeypatch):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("aab e▁éit'\n1the ion  日🎉\t") for _ in range(rnd.randint(0, 300))) for _ in range(800)]
    want = real.encode(texts, add_eos=True)
    assert agenda.encode(texts) == want
    monkeypatch.setattr(pieces, "CACHE_WORDS", 40)
    small = pieces.Agenda(pieces.read_model(MODEL))
    assert [small.encode([t])[0] for t in texts] == want
    assert [sum((ids for ids, _ in small.encode_stream(t, words=3)), []) for t in texts[:60]] == want[:60]


def test_any_ids_decode_like_the_library(real, agenda):
    rnd = random.Random(9)
    for _ in range(4000):
        ids = [rnd.choice([0, 1, 2, rnd.randint(3, 258), rnd.randint(3, 258), rnd.randint(259, 275), rnd.randint(259, 31999)]) for _ in range(rnd.randint(0, 7))]
        assert agenda.decode(ids) == real.decode(ids)
        assert "".join(agenda.decode_stream(iter([ids[:2], ids[2:]]))) == real.decode(ids)


def test_long_text_goes_as_a_stream(spark, real, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_TEXT", 1000)
    text = "ab cd " * 60_000
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    r = {r["doc_id"]: r for r in pieces.encode(docs, MODEL, check=True).collect()}
    assert list(r[1]["ids"]) == real.encode(text, add_eos=True) and r[1]["agrees"] and r[2]["agrees"]


def test_a_word_encoded_otherwise_is_noted(agenda, real):
    class Other:
        def encode(self, words, num_threads):
            return [[5] if w == "bad" else real.encode(w) for w in words]

    fresh = pieces.Agenda(agenda.v)
    assert fresh.encode_checked(["good one", "a bad one", "good"], Other())[1] == [True, False, True]
    assert fresh.encode_checked(["a bad end"], Other())[1] == [False]  # from the cache


def test_ties_of_equal_scores_go_left_first():
    v = pieces.Vocabulary(["<unk>", "</s>", "a", "b", "ab", "ba", "aba"], [0, 0, -3, -3, -1, -1, -2], [2, 3, 1, 1, 1, 1, 1], False, False, True, False, "?", 1)
    a = pieces.Agenda(v)
    assert a.encode(["aba", "bab", "x"]) == [[6, 1], [5, 3, 1], [0, 1]]
    assert a.decode([6, 0, 1]) == "aba?"
    assert [a.long_word(w) for w in ("aba", "bab", "x")] == [[6], [5, 3], [0]]
    v.pieces[3] = "bx"  # b occurs in pieces without being one, c in none
    v.byte_fallback, odd = False, pieces.Agenda(v)
    assert odd.encode(["abac", "b"]) == [[6, 0, 1], [0, 1]]


def test_query_whole_table_and_decode(spark, real):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op11_pieces"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows.count() == docs.count() and rows.where("not agrees").count() == 0
    back = pieces.decode(pieces.encode(docs, MODEL, digests=False), MODEL).join(docs.select("doc_id", "text"), "doc_id")
    assert back.where(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
