"""Hand-made cases for joins that keep rows, size checks, thresholds, encoders, scratch folders and the feature pipeline."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import assemble, encoders as enc, ensemble as ens, joins, metrics, tfidf as tf, vocab as vc
from tessera.operators.pipeline import FeaturePipeline


def test_weighted_blend_refuses_a_model_without_weight(spark):
    long = spark.createDataFrame([("a", 1, 0.2), ("b", 1, 0.8)], "model string, id long, score double")
    assert ens.ensemble_weighted(long, ens.power_weights(spark, {"a": 0.5, "b": 0.5})).collect()[0]["score"] == pytest.approx(0.5)
    with pytest.raises(Exception, match="no weight for model b"):
        ens.ensemble_weighted(long, ens.power_weights(spark, {"a": 0.5})).collect()


def test_blocks_keep_every_key_of_the_spine(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.6)], "id long, x double")
    b = spark.createDataFrame([(2, 7.0), (3, 8.0)], "id long, y double")
    rows = lambda df: {r["id"]: list(r["features"]) for r in df.collect()}
    assert rows(assemble.assemble_blocks("id", [(a, ["x"]), (b, ["y"])])[0]) == {1: [0.5, None], 2: [0.6, 7.0]}
    spine = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "id long")
    df, names = assemble.assemble_blocks("id", [(a, ["x"], 0), (b, ["y"], -1)], spine=spine)
    assert names == ["x", "y"] and rows(df) == {1: [0.5, -1.0], 2: [0.6, 7.0], 3: [0.0, 8.0], 4: [0.0, -1.0]}


def test_buckets_just_below_every_threshold(spark):
    scores = [(k, math.nextafter(k / 999, 0)) for k in range(1, 1000)] + [(k + 1, k / 999) for k in range(1000)]
    df = spark.createDataFrame(scores, "want long, s double")
    assert df.where(metrics.score_bucket("s", 1000) != F.col("want") - 1).count() == 0


def test_size_check_moves_no_rows_and_salted_join_is_whole(spark):
    dim = session.cut_lineage(spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    probe = dim.agg(F.count(F.lit(1)), F.sum("v"))
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan and "partial_count" in plan
    assert joins.measured_size(dim)[0] == 5000 and not joins.broadcastable(dim, max_rows=4999)
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 100 < 99, F.lit(7)).otherwise(F.col("id") % 6000).cast("long").alias("k"))
    got = joins.lookup_join(facts, dim, "k", how="left", spread="id", max_broadcast_rows=0)
    want = facts.join(F.broadcast(dim), "k", "left")
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).count() == 0 and got.count() == 20_000


def test_multi_hot_separator_is_plain_text(spark):
    df = spark.createDataFrame([(1, "ab|cd"), (2, "cd"), (3, None)], "id long, c string")
    assert sorted(r["value"] for r in enc.MultiHot(["c"], sep="|").fit(df).vocab.collect()) == ["ab", "cd"]


def test_target_mean_counts_labelled_rows_only(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "b", 0), (4, "b", 1), (5, "c", None)], "id long, c string, y int")
    model = enc.TargetEncode(["c"], "y").fit(df)
    assert {r["value"]: r["n"] for r in model.stats.collect()} == {"a": 1, "b": 2, "c": 0}
    got = {r["id"]: r["encoded"] for r in model.transform(df).collect()}
    assert got[1] == got[5] == pytest.approx(2 / 3)
    folded = enc.TargetEncode(["c"], "y").fit_transform_out_of_fold(df.withColumn("fold", F.col("id") % 2), "fold").collect()
    assert len(folded) == 5 and all(r["encoded"] is not None for r in folded)


def test_vocabulary_limit_is_an_option(spark):
    docs = spark.createDataFrame([(1, "a a a b b c"), (2, "")], "id long, t string")
    voc = vc.token_vocab((docs, "t"))
    seqs = lambda n: {r["id"]: list(r["seq"]) for r in vc.token_sequences(docs, "t", voc, num_words=n).collect()}
    assert seqs(None) == {1: [1, 1, 1, 2, 2, 3], 2: []} and seqs(3) == {1: [1, 1, 1, 2, 2], 2: []}
    vectors = spark.createDataFrame([("a", [1.0])], "word string, vec array<float>")
    assert sorted(r["row"] for r in vc.embedding_matrix(voc, vectors, 1).collect()) == [0, 1, 2, 3]
    assert sorted(r["row"] for r in vc.embedding_matrix(voc, vectors, 1, num_words=3).collect()) == [0, 1, 2]


def test_text_hashing_is_signed_and_normalised(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta", None), (2, "", "alpha")], "id long, a string, b string")
    got = {r["id"]: list(r["vec"]) for r in vc.embed_text(docs, ["a", "b"], dim=16).collect()}
    assert len(got[1]) == 32 and sum(x * x for x in got[1][:16]) == pytest.approx(1) and not any(got[1][16:])
    assert not any(got[2][:16]) and min(got[1]) < 0 < max(got[1] + got[2])


def test_encoder_is_made_in_the_worker(spark):
    docs = spark.createDataFrame([(1, "ab", None), (2, "abc", "x")], "id long, a string, b string")

    def factory():
        return lambda texts: [[float(len(t))] for t in texts]

    assert {r["id"]: list(r["vec"]) for r in vc.embed_text(docs, ["a", "b"], encoder=factory).collect()} == {1: [2.0, 0.0], 2: [3.0, 1.0]}


class FakeSession:
    def __init__(self, master):
        self.sparkContext = self
        self.master, self.applicationId = master, "app"
        self.conf = {}

    def getCheckpointDir(self):
        return None


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.scratch_dir(FakeSession(master))


class OwnFolder(FakeSession):
    """A session with a folder of its own."""

    def __init__(self, spark, folder):
        super().__init__("yarn")
        self.conf, self._jvm, self._jsc = {"spark.checkpoint.dir": folder}, spark._jvm, spark._jsc

    def getCheckpointDir(self):
        return "set"


def test_cleanup_removes_what_was_written(spark, tmp_path):
    own = OwnFolder(spark, f"file://{tmp_path}")
    path = session.scratch_dir(own, "table")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and path.startswith(f"file://{tmp_path}/tessera-app/")
    assert session.cleanup(own) and not list(tmp_path.iterdir()) and not session.cleanup(own)


def test_feature_pipeline_on_unseen_rows(spark):
    train = spark.createDataFrame([(1, "red apple", "x", "p, q", 0.0, 1), (2, "red pear", "y", "q", 10.0, 0), (3, "green apple", "x", None, 5.0, 1)],
                                  "id long, t string, c string, m string, n double, y int")
    spec = FeaturePipeline(text=[tf.TfIdf("t", max_features=None, ngram=(1, 1), min_df=1, max_df=1.0, stop=[])], one_hot=("c",), target=("c",), multi_hot=("m",),
                           continuous=("n",), poly=True, label="y")
    model = spec.fit(train)
    assert [b[0] for b in model.blocks] == ["tfidf:t", "one_hot", "target", "multi_hot:m", "continuous"]
    assert [b[1] for b in model.blocks] == [0, 4, 6, 7, 9] and model.size == 12
    new = spark.createDataFrame([(9, "unknown", "z", "r", 20.0, None), (8, None, None, None, None, None)], train.schema)
    vec = {r["id"]: r["features"] for r in model.vectors(new).collect()}
    assert set(vec) == {8, 9} and all(v.size == 12 for v in vec.values())
    # Unknown words and categories have no slot; the target mean falls back to the prior, numbers aren't clipped.
    assert dict(zip(map(int, vec[9].indices), vec[9].values)) == pytest.approx({6: 2 / 3, 9: 1.0, 10: 2.0, 11: 4.0})
    seen = {r["id"]: r["features"] for r in model.vectors(train, ("y",)).collect()}
    assert sum(v * v for i, v in zip(seen[1].indices, seen[1].values) if i < 4) == pytest.approx(1)


def test_hashed_vectors_are_not_looked_up_slot_by_slot(spark):
    """All slots in order, for rows with no, few and many tokens, without a map that each slot goes through."""
    docs = spark.createDataFrame([(1, "apple pear apple", None), (2, None, None), (3, " ".join(f"word{i}x" for i in range(300)), "plum"), (None, "", "fig figs figs")], "id int, a string, b string")
    df = vc.embed_text(docs, ["a", "b"], dim=16)
    got = {r["id"]: list(r["vec"]) for r in df.collect()}
    for i, *texts in docs.collect():
        want = []
        for text in texts:
            v = [0.0] * 16
            for tok in (t for t in (text or "").split() if len(t) > 2):
                h = hashlib.md5(tok.encode()).hexdigest()
                v[int(h[:8], 16) % 16] += 1.0 if h[8] < "8" else -1.0
            n = math.sqrt(sum(x * x for x in v))
            want += [x / n if n else 0.0 for x in v]
        assert got[i] == want
    assert "element_at" not in df._jdf.queryExecution().optimizedPlan().toString()
