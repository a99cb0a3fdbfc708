"""Physical-plan shape: the scale properties the operators promise, checked on the executed plan.

These guard against regressions that stay correct on small data but would not survive a large cluster:
an exploded relation shuffled where the compact one could be, a window without a partition key over data
rows, a broadcast without a size check.
"""

import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera.operators import joins
from tessera.operators import rollup
from tessera.operators import tfidf as tf
from tessera.operators import vocab as vc
from tessera.operators.ordering import co_locate, global_row_number
from tessera.plans import queries as Q
from tessera.sources import tables as T


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition|RoundRobin)", p)


def test_ngram_counts_shuffle_documents_not_ngrams(spark):
    p = plan(tf.term_stats(tf.stopword_ngrams(Q.all_text(spark, SF_SMALL), "all_text", 1, 2)))
    ex = exchanges(p)
    # One exchange co-locates the documents by id, one combines per-term partial counts. The exploded
    # (id, term) rows are aggregated inside the partition and never shuffled.
    assert any(e.startswith("hashpartitioning(id") for e in ex), ex
    assert any(e.startswith("hashpartitioning(term") for e in ex), ex
    assert not any("term" in e and "id" in e for e in ex), ex


def test_co_locate_is_free_on_co_located_input(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    once = co_locate(df, "k").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    twice = co_locate(once, "k").withColumn("m", F.col("n") + 1)
    assert len(exchanges(plan(twice))) == 1


def test_token_sequences_aggregate_in_partition(spark):
    docs = Q.all_text(spark, SF_SMALL)
    voc = vc.token_vocab((docs, "all_text"))
    p = plan(vc.token_sequences(docs, "all_text", voc, num_words=100000))
    # Besides the vocabulary's per-partition offsets (one row per partition: `_rn_p`, and the single-partition
    # running sum over them), the only exchange co-locates the documents by id; the vocabulary is broadcast
    # after its size check, so the exploded tokens are never shuffled.
    ex = [e for e in exchanges(p) if "_rn_p" not in e and e != "SinglePartition"]
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(id"), ex
    assert "BroadcastHashJoin" in p


def test_rollup_is_one_aggregate_exchange(spark):
    p = plan(rollup.resource_rollup(T.resources_v(spark, SF_SMALL)))
    ex = [e for e in exchanges(p) if e.startswith("hashpartitioning")]
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(id"), ex
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2


def test_global_row_number_has_no_single_task_window_over_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    r = global_row_number(df, [F.asc("v")], out="rn")
    p = plan(r)
    # The only single-partition step is the window over the per-partition counts (one row per partition).
    assert sorted(x["rn"] for x in r.collect()) == list(range(1, 1001))
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert windows and all("_rn_n" in w for w in windows), windows


def test_lookup_join_broadcast_only_within_bound(spark):
    facts = spark.createDataFrame([(i, f"t{i % 5}") for i in range(50)], "id long, token string")
    dim = spark.createDataFrame([(f"t{j}", j) for j in range(5)], "token string, c int")
    small = plan(joins.lookup_join(facts, dim, "token", spread="id"))
    assert "BroadcastHashJoin" in small and "_salt" not in small
    # Past the row bound: a shuffle join on (token, salt), the dimension replicated once per salt value.
    big = plan(joins.lookup_join(facts, dim, "token", spread="id", max_broadcast_rows=4))
    assert "_salt" in big and any(e.startswith("hashpartitioning(token") and "_salt" in e
                                  for e in exchanges(big)), exchanges(big)


def test_global_running_sum_matches_cumulative_sum(spark):
    from tessera.operators.ordering import global_running_sum
    vals = [(i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(vals, "k long, v long").repartition(7)
    got = {r["k"]: r["cum"] for r in global_running_sum(df, [F.asc("k")], "v").collect()}
    total = 0
    for k, v in vals:
        total += v
        assert got[k] == total


def test_lineage_cut_is_a_table_in_the_checkpoint_folder(spark):
    from tessera.session import cut_lineage
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    base = spark.conf.get("spark.checkpoint.dir")
    files = df.inputFiles()
    assert files and all(base.rstrip("/") in f for f in files)
    assert sorted(r["x"] for r in df.collect()) == list(range(0, 20, 2))


def test_keyword_matrix_needs_no_shuffle(spark):
    from tessera.operators import lexicon as lx
    e = T.essays_v(spark, SF_SMALL)
    p = plan(lx.keyword_matrix(e, T.TEXT_COLS, lx.REFERENCE_KEYWORDS))
    assert [e for e in exchanges(p) if e.startswith("hashpartitioning")] == []


def test_text_feature_stage_shuffles_documents_only_by_id(spark):
    from tessera.plans.preprocess import text_features
    p = plan(text_features(T.essays_v(spark, SF_SMALL), T.lexicon_v(spark, SF_SMALL)))
    hashed = [e for e in exchanges(p) if e.startswith("hashpartitioning")]
    # The rows and the lexicon branch are co-located by id; the lexicon table itself is written once and
    # broadcast, so no exchange is keyed by token.
    assert hashed and all(e.startswith("hashpartitioning(id") for e in hashed), hashed
