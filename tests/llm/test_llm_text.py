"""Language model, BPE, language ID, toxicity: against brute force, tiktoken and held-out labels."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import language_model, learned
from pyspark.sql import functions as F

from tessera.llm import bpe, kneser_ney, langid, toxicity
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "doc_id long, text string, n_tokens int, score string, ids string, lang_pred int, lang string"


def odd_docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "x", "y", 3, None) for i, t in rows], ODD)


@pytest.fixture(scope="module")
def real():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "The theater's 日本語 🎉 don't\r\n  x1234 ---"), (5, "The theater's 日本語 🎉 don't\r\n  x1234 ---"),
         (6, "ab" * 3000), (7, "a" * 1500 + "é" * 500), (None, "no id"), (8, "word " * 5000)]


def test_bpe_matches_the_library_on_edges(spark, real):
    got = bpe.encode(odd_docs(spark, EDGES), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((str(i), real.encode_ordinary(t or ""), t or "") for i, t in EDGES)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == [w[:2] for w in want]
    for r, (_, ids, t) in zip(sorted(got, key=lambda r: (str(r["doc_id"]), list(r["ids"]))), want):
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_random_pieces_streams_and_small_cache(real, monkeypatch):
    rnd = random.Random(5)
    coder = bpe.ByteBPE(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    texts = ["".join(rnd.choice("aab eéit'\n1the ion") for _ in range(rnd.randint(0, 400))) for _ in range(300)]
    want = [real.encode_ordinary(t) for t in texts]
    assert coder.encode(texts) == want
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    small = bpe.ByteBPE(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    assert [small.encode([t])[0] for t in texts] == want
    assert [sum(coder.encode_stream(t, 7), []) for t in texts[:40]] == want[:40]
    long = "".join(rnd.choice("abé") for _ in range(bpe.LONG + 200))
    assert coder.encode([long]) == [real.encode_ordinary(long)]


def test_bpe_long_text_decode_and_empty_table(spark, real, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    docs = odd_docs(spark, [(1, "some longer text, é " * 40), (2, None)])
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(ids, RANKS).collect()}
    assert back == {1: ("some longer text, é " * 40).encode(), 2: b""}
    assert bpe.encode(docs.where("false"), RANKS, public_tokenizers.PATTERN).collect() == []


def test_op3_matches_the_library(spark, real):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = bpe.op3_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = real.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def close(got, want):
    for i, (n, known, total, base, score) in want.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_against_brute_force(spark, order, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(900_001, None), (900_002, ""), (900_003, "THE the\x0bthe"), (900_004, "the " * 700)]
    monkeypatch.setattr(kneser_ney, "FLUSH", 2000)
    docs = odd_docs(spark, rows)
    model = kneser_ney.train(spark, docs.where("doc_id % 5 <> 0"), order=order, shards=5)
    want = language_model([(i, t, i % 5 != 0) for i, t in rows], order)
    got = {r["doc_id"]: r for r in kneser_ney.score(docs, model).collect()}
    assert model.total == next(iter(want.values()))[2]
    close(got, want)


def test_language_model_long_text_and_repeats(spark, monkeypatch):
    """A text scored in stretches gets the score of the whole; a repeated row counts twice."""
    rnd = random.Random(3)
    long = " ".join("".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4))) for _ in range(3000))
    rows = [(1, long), (2, "a b a"), (2, "a b a"), (None, "b b")]
    want = language_model([(k, t, True) for k, (_, t) in enumerate(rows)], 2)
    monkeypatch.setattr(kneser_ney, "PIECE", 500)
    model = kneser_ney.train(spark, odd_docs(spark, rows), shards=3)
    got = model.score([t for _, t in rows])
    assert [x.tolist() for x in got[:2]] == [[w[k] for w in want.values()] for k in (0, 1)]
    assert got[3] == pytest.approx([w[4] for w in want.values()], rel=1e-6)


def test_language_model_without_training_text(spark):
    docs = odd_docs(spark, [(1, "a b"), (2, None)])
    model = kneser_ney.train(spark, docs.where("false"))
    rows = {r["doc_id"]: r for r in kneser_ney.score(docs, model).collect()}
    assert (rows[1]["n_tokens"], rows[1]["n_known"], rows[1]["score"], rows[1]["base_score"]) == (3, 0, 0.0, 0.0)
    assert kneser_ney.score(docs.where("false"), model).collect() == []


def test_op1_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in kneser_ney.op1_kneser_ney(spark, SF).collect()}
    want = language_model([(i, t, learned(i, 10, 0)) for i, t in rows], 2)
    close(got, want)
    assert all(r["held_out"] is not learned(i, 10, 0) and r["train_tokens"] == want[i][2] for i, r in got.items())


def test_registered_language_model_is_a_trigram_model(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op1_kneser_ney"](spark, SF).collect()}
    close(got, language_model([(i, t, learned(i, 10, 0)) for i, t in rows], 3))


@pytest.mark.parametrize("words", [3, 70_000])
def test_packed_grams_come_back(words):
    """Also with more words in a shard than two bytes number."""
    rnd = np.random.default_rng(4)
    names = rnd.integers(1, 1 << 63, words, dtype=np.uint64)
    back = [names[rnd.permutation(words)] for _ in range(3)]
    keys, first, (n,) = kneser_ney.summed(kneser_ney.gram(kneser_ney.context_hashes(back[:-1])[-1], back[-1]), np.arange(1, words + 1))
    rows = list(kneser_ney.packed_grams(3, keys, [b[first] for b in back], n.astype(np.uint32), 2))
    got, count = kneser_ney.unpacked_grams(kneser_ney.batch_of(kneser_ney.PACKED_ARROW, list(zip(*rows))), 3)
    assert sorted(zip(*[g.tolist() for g in got], count.tolist())) == sorted(zip(*[b.tolist() for b in back], range(1, words + 1)))


def test_language_id_on_held_out_documents(spark):
    got = langid.op5_langid(spark, MID).toPandas()
    truth = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    assert len(both) == len(truth) and both.score.between(0, 1).all()
    assert (both.held_out == ~both.doc_id.map(lambda i: learned(i, 4, 2))).all()
    held = both[both.held_out & both.lang.notna()]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.95


def test_language_mixture_and_edges(spark):
    learn = spark.createDataFrame([("the cat sat on the mat and that was that " * 5, "en"), ("le chat est sur la table et voilà que nous " * 5, "fr"),
                                   ("der hund und die katze sind nicht im haus " * 5, "de"), (None, "es"), ("otra", None)], "text string, lang string")
    model = langid.train(learn, penalty=5.0)
    assert model.langs == ["de", "en", "fr"]
    rows = [(1, None), (2, ""), (3, "12 !? …"), (4, "the cat and the mat"), (4, "the cat and the mat"), (5, "the cat sat on the mat " * 4 + "le chat est sur la table " * 3), (6, "X" * 300_000)]
    got = {r["doc_id"]: r for r in langid.identify(odd_docs(spark, rows), model).collect()}
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4]["lang_pred"] == "en" and set(got[5]["mixture"]) == {"en", "fr"} and got[5]["lang_pred"] == "en"
    assert got[5]["mixture"]["en"] == pytest.approx(92 / 167, abs=0.1) and sum(got[5]["mixture"].values()) == pytest.approx(1)
    assert got[6]["lang_pred"] in model.langs
    nothing = langid.train(learn.where("false"))
    assert {r["lang_pred"] for r in langid.identify(odd_docs(spark, rows), nothing).collect()} == {"und"}
    kept = langid.accepted(odd_docs(spark, rows), model)
    assert kept.columns == odd_docs(spark, rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 4, 5, 6]
    assert langid.identify(odd_docs(spark, rows).where("false"), model).collect() == []


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    chain = toxicity.train(docs, labels.where(fold != 0), {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    got = toxicity.score(docs, chain, ["low_quality", "toxic"]).toPandas().merge(labels.where(fold == 0).toPandas(), on="doc_id")
    assert len(got) > 80
    assert ((got.toxic_score >= 0.5) == (got.toxic == 1)).mean() > 0.93
    assert ((got.low_quality_score >= 0.5) == (got.quality == 0)).mean() > 0.9


def test_toxicity_edges_and_chain(spark):
    rows = [(i, f"good words here w{i}") for i in range(40)] + [(100 + i, f"bad nasty words w{i}") for i in range(40)] + [(500, None), (501, ""), (0, "good words here w0")]
    docs = odd_docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i >= 100), None if i % 7 == 0 else int(i >= 100 and i % 2)) for i, _ in rows[:80]] + [(3, 0, 0), (None, 1, 1)], "doc_id long, a int, b int")
    chain = toxicity.train(docs, labels, {"a": F.col("a") == 1, "b": F.col("b") == 1}, features=20)
    assert len(chain.models) == 2 and len(chain.models[1].v) == 1
    got = toxicity.score(docs, chain, ["a", "b"]).collect()
    assert len(got) == len(rows) and all(0 < r["a_score"] < 1 and 0 < r["b_score"] < 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[5]["a_score"] < 0.2 < 0.8 < by[105]["a_score"] and by[500]["a_score"] == by[501]["a_score"]
    empty = toxicity.train(docs, labels.where("false"), {"a": F.col("a") == 1})
    assert {round(r["a_score"], 9) for r in toxicity.score(docs, empty, ["a"]).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), chain, ["a", "b"]).collect() == []


def test_out_of_fold_logits_do_not_see_their_row():
    """The second model reads what a model without the row says: pure noise labels must not look predictable."""
    rnd = np.random.default_rng(0)
    n = 200
    row, col = np.arange(n), np.arange(n)  # a feature of its own for each row: only memory could predict
    y = np.column_stack([rnd.integers(0, 2, n), np.zeros(n)]).astype(float)
    y[:, 1] = y[:, 0]
    models = toxicity.fit_chain(row, col, n, y, np.arange(n) % 5)
    assert abs(models[1].v[0]) < 1.5
