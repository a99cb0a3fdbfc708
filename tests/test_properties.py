"""Property tests on generated inputs."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import encoders as enc
from tessera.operators import ensemble as ens
from tessera.operators import metrics as mt
from tessera.operators import splits as sp
from tessera.operators import tfidf as tf
from tessera.operators import vocab as vc

SET = settings(max_examples=5, deadline=None)


@SET
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=30))
def test_one_hot_at_most_one_per_feature(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, c string")
    out = enc.OneHot(["c"]).fit(df).transform(df)
    per_row = out.groupBy("id", "feature").count().where("count > 1").count()
    assert per_row == 0
    assert out.count() == sum(v is not None for v in values)


@SET
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_minmax_train_in_unit_interval(spark, xs):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "id long, x double")
    out = enc.MinMax(["x"]).fit(df).transform(df).collect()
    for r in out:
        assert -1e-12 <= r["x"] <= 1 + 1e-12


def test_tfidf_rows_have_unit_norm(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["red apple pie", "green apple tart", "red green blue", "apple apple apple", "blue sky red",
         "the and of", ""])], "id long, t string")
    m = tf.TfIdf("t", max_features=None, ngram=(1, 2), min_df=1, max_df=1.0).fit(docs)
    norms = m.transform(docs).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    for r in norms:
        assert abs(r["n"] - 1.0) < 1e-9 or r["n"] == 0


@SET
@given(st.lists(st.integers(1, 9), max_size=12), st.integers(1, 6))
def test_pad_length_constant(spark, seq, maxlen):
    df = spark.createDataFrame([(0, seq)], "id long, seq array<int>")
    out = vc.pad_sequences(df, "seq", maxlen).first()["seq"]
    assert len(out) == maxlen
    kept = seq[-maxlen:] if len(seq) > maxlen else seq
    assert out == [0] * (maxlen - len(kept)) + kept


@SET
@given(st.integers(1, 60), st.integers(2, 7))
def test_folds_disjoint_and_covering(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "id")
    for method in ("contiguous", "hash", "mod"):
        f = sp.kfold(df, k=k, method=method).collect()
        assert len(f) == n and len({r["id"] for r in f}) == n
        assert all(0 <= r["fold"] < k for r in f)
        if method == "contiguous":
            sizes = [sum(1 for r in f if r["fold"] == j) for j in range(k)]
            assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


@SET
@given(st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1), st.floats(0, 1)), min_size=1, max_size=10))
def test_ensembles_within_bounds(spark, rows):
    long = spark.createDataFrame([(m, i, float(s[j])) for i, s in enumerate(rows) for j, m in enumerate("abc")],
                                 "model string, id long, score double")
    w = ens.power_weights(spark, {"a": 0.7, "b": 0.8, "c": 0.75})
    mean = {r["id"]: r["score"] for r in ens.ensemble_mean(long).collect()}
    wmean = {r["id"]: r["score"] for r in ens.ensemble_weighted(long, w).collect()}
    eq = {r["id"]: r["score"] for r in
          ens.ensemble_weighted(long, ens.power_weights(spark, {"a": 1, "b": 1, "c": 1})).collect()}
    for i, s in enumerate(rows):
        assert min(s) - 1e-12 <= wmean[i] <= max(s) + 1e-12
        assert math.isclose(eq[i], mean[i], abs_tol=1e-12)


def test_step_auc_perfect_and_constant(spark):
    perfect = spark.createDataFrame([(1, 1.0), (1, 0.9), (0, 0.1), (0, 0.0)], "y int, s double")
    const = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    assert mt.binned_auc(perfect, "y", "s").first()["auc"] == 1.0
    assert mt.binned_auc(const, "y", "s").first()["auc"] == 0.0
    assert mt.binned_auc(const, "y", "s", method="exact").first()["auc"] == 0.5
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    assert mt.binned_auc(one_class, "y", "s").first()["auc"] is None


def test_lookup_join_paths_agree(spark):
    """The broadcast path and the salted shuffle path give the same rows (hot key included)."""
    from tessera.operators.joins import broadcastable, lookup_join
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)], "id long, token string")
    dim = spark.createDataFrame([("hot", 1), *[(f"k{j}", j) for j in range(7)]], "token string, cls int")
    a = sorted(lookup_join(facts, dim, "token", spread="id").collect())
    b = sorted(lookup_join(facts, dim, "token", spread="id", max_broadcast_rows=1).collect())
    c = sorted(lookup_join(facts, dim, "token", how="left", spread="id", max_broadcast_bytes=1).collect())
    assert a == b == c and len(a) == 300
    wide = spark.createDataFrame([(w, [0.0] * 300) for w in ("a", "b")], "word string, vec array<float>")
    assert broadcastable(wide, max_bytes=1 << 20) and not broadcastable(wide, max_bytes=1000)


@SET
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 1),
                          st.one_of(st.none(), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))),
                min_size=1, max_size=60))
def test_exact_auc_matches_pairwise_count(spark, rows):
    """Distributed rank-sum AUC equals the brute-force pairwise definition per group (ties count half)."""
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in mt.binned_auc(df, "y", "s", group="g", method="exact").collect()}
    for g in {r[0] for r in rows}:
        pos = [s for gg, y, s in rows if gg == g and y == 1 and s is not None]
        neg = [s for gg, y, s in rows if gg == g and y == 0 and s is not None]
        if pos and neg:
            want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
            assert math.isclose(got[g], want, abs_tol=1e-12), (g, got[g], want)
        else:
            assert got.get(g) is None


def test_transform_of_a_row_does_not_depend_on_the_other_rows(spark):
    """Fit/transform separation: fitted on the labelled essays, the encoding of a test row is
    the same whether it is transformed with all test rows or with a subset of them."""
    from conftest import SF_SMALL

    from tessera.plans import queries as Q
    from tessera.sources import tables as T
    e = T.essays_v(spark, SF_SMALL)
    train = e.where(F.col("project_is_approved").isNotNull())
    test = e.where(F.col("project_is_approved").isNull())
    part = test.where(F.col("id") % 3 == 0)

    def same(transform, frame_all, frame_part, cols):
        whole = {tuple(r) for r in transform(frame_all).select(*cols).collect()}
        sub = {tuple(r) for r in transform(frame_part).select(*cols).collect()}
        assert sub and sub <= whole

    oh = enc.OneHot(["lang", "source"]).fit(train)
    same(oh.transform, test, part, ["id", "feature", "slot"])
    te = enc.TargetEncode(["lang", "source"], "project_is_approved").fit(train)
    same(te.transform, test, part, ["id", "feature", "encoded"])
    mm = enc.MinMax(["n_chars"]).fit(train)
    same(mm.transform, test, part, ["id", "n_chars"])
    docs = Q.all_text(spark, SF_SMALL)
    model = tf.TfIdf("all_text", max_features=500, ngram=(1, 2), min_df=2, max_df=0.9).fit(
        docs.where(F.col("project_is_approved").isNotNull()))
    tdocs = docs.where(F.col("project_is_approved").isNull())
    same(lambda d: model.transform(d).withColumn("weight", F.round("weight", 9)), tdocs,
         tdocs.where(F.col("id") % 3 == 0), ["id", "term", "weight"])
