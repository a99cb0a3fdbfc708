"""The lookup join beyond the broadcast bounds, and what is built on it."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import joins
from tessera.operators import vocab as vc


@pytest.mark.parametrize("how", ["inner", "left"])
def test_frequent_keys_are_broadcast_and_the_dimension_is_sent_twice_at_most(spark, how):
    """Keys that hold more than a twentieth of the facts, one of them unlisted and one listed twice, rare keys and nulls."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, "unlisted").when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    facts = spark.range(2000).select("id", k.alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 9), *[(f"k{j}", j) for j in range(40)]], "k string, v int")
    want = facts.join(F.broadcast(dim), "k", how)
    got = joins.lookup_join(facts, dim, "k", how, spread="id", max_broadcast_rows=20)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "42), 2) as int) AS _salt" in plan and "LeftAnti" in plan, plan


def test_two_key_columns_beyond_the_bound(spark):
    facts = spark.createDataFrame([(i, "a" if i % 2 else None, f"v{i % 5}") for i in range(100)], "id long, f string, v string")
    dim = spark.createDataFrame([("a", f"v{j}", j) for j in range(4)] + [("b", "v1", 7)], "f string, v string, s int")
    got = joins.lookup_join(facts, dim, ["f", "v"], "left", spread="id", max_broadcast_rows=4)
    assert sorted(map(str, got.collect())) == sorted(map(str, facts.join(dim, ["f", "v"], "left").collect()))


def test_text_vectors_sum_only_tokens_with_a_vector(spark):
    """Zero vectors count in the mean; a text of only such tokens has a zero vector, one of unknown tokens none."""
    docs = spark.createDataFrame([(1, "a b z"), (2, "z z"), (3, "unknown"), (4, None), (None, "a"), (5, "a a b unknown")], "id long, t string")
    matrix = spark.createDataFrame([(None, [0.0, 0.0]), ("a", [1.0, 2.0]), ("b", [3.0, -1.0]), ("z", [0.0, 0.0])], "token string, vec array<float>")
    df = vc.text_vectors(docs, "t", matrix, dim=2)
    got = {r["id"]: r["vec"] for r in df.collect()}
    assert got == {1: [4 / 3, 1 / 3], 2: [0.0, 0.0], 3: None, 4: None, None: [1.0, 2.0], 5: [5 / 3, 1.0]}
    joins_of_vectors = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "exists" in line]
    assert joins_of_vectors


def test_texts_are_dealt_by_their_bytes(spark, monkeypatch):
    """Partitions follow the size of the texts, nulls and repeated keys included, so that tasks don't grow with the corpus."""
    from tessera.operators import ordering
    from tessera.operators import tfidf
    monkeypatch.setattr(ordering, "TEXT_BYTES", 100)
    df = spark.createDataFrame([(i % 50, "some words of a text " * (i % 4)) for i in range(200)] + [(None, "a b"), (3, None)], "id long, t string")
    dealt = ordering.co_locate_texts(df, "id", "t")
    assert dealt.rdd.getNumPartitions() == 1 + (200 // 4 * 6 * 21 + 3) // 100
    assert sorted(map(str, dealt.collect())) == sorted(map(str, df.collect()))
    counts = tfidf.stopword_ngrams(df, "t", 1, 1, stop=[])
    assert counts.rdd.getNumPartitions() > 50  # the sums are made where the texts lie
    assert counts.where("term = 'text' and id = 3").first()["tf"] == sum(i % 4 for i in range(200) if i % 50 == 3)


def test_tokens_are_looked_up_without_sums_by_document_and_token(spark):
    from tessera.operators import lexicon as lx
    toks = spark.createDataFrame([(1, "f", 0, "a"), (1, "f", 1, "a"), (1, "f", 2, "z"), (2, "g", 0, "b"), (None, "g", 0, "a")], "id long, field string, pos int, token string")
    lex = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "token string, class int")
    df = lx.token_class_counts(toks, lex, unknown="none")
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, "f", "1", 2), (1, "f", "2", 2), (1, "f", "none", 1), (2, "g", "1", 1), (None, "g", "1", 1), (None, "g", "2", 1)], key=str)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Aggregate [" in line for line in plan.splitlines()) == 1, plan
