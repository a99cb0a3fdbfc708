"""The sparse network against pyspark.ml's, which makes rows dense."""

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from tessera.operators import models as md
from tessera.operators import network as nw


def frames(spark, n=400):
    rnd = np.random.default_rng(4)
    rows = []
    for i in range(n):
        x = {int(s): float(v) for s, v in zip(rnd.choice(30, 4, replace=False), rnd.normal(size=4))} if i % 9 else {}
        y = int(x.get(0, 0) + x.get(1, 0) - x.get(2, 0) + rnd.normal(0, 0.2) > 0)
        rows.append((i, Vectors.sparse(30, x) if i % 4 else Vectors.dense(Vectors.sparse(30, x).toArray()), y))
    df = spark.createDataFrame(rows, ["id", "features", "y"])
    return df.where("id % 5 > 0"), df.where("id % 5 = 0")


def scored(df):
    return {(r["set"], r["id"]): r["score"] for r in df.collect()}


def test_scores_equal_the_dense_learner(spark, monkeypatch):
    """With all packs in one task, and with a job for each pass."""
    tr, te = frames(spark)
    rows, rest = md._prep(tr, te, "features", "y")
    model = MultilayerPerceptronClassifier(layers=[30, 6, 4, 2], maxIter=8, seed=3).fit(rows)
    p1 = vector_to_array("probability")[1].alias("score")
    want = {(name, r["id"]): r["score"] for name, df in (("train", rows), ("test", rest)) for r in model.transform(df).select("id", p1).collect()}
    for local in (nw.LOCAL_ENTRIES, 0):
        monkeypatch.setattr(nw, "LOCAL_ENTRIES", local)
        monkeypatch.setattr(nw, "PACKED", 300)
        monkeypatch.setattr(nw, "PART", 50)
        got = scored(md.mlp_score(tr, te, "features", "y", hidden=(6, 4), max_iter=8, seed=3))
        assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9, local


def test_only_one_row_gets_dense(spark, monkeypatch):
    tr, te = frames(spark)

    class One(MultilayerPerceptronClassifier):
        def fit(self, dataset, *a):
            assert dataset.count() <= 1
            return super().fit(dataset, *a)

    monkeypatch.setattr(md, "MultilayerPerceptronClassifier", One)
    assert len(scored(md.mlp_score(tr, te, "features", "y", hidden=(3,), max_iter=2))) == 400


def test_minimiser_finds_the_lowest_point():
    a = np.diag([1.0, 10.0, 100.0])
    x = nw.minimised(lambda x: (float(x @ a @ x / 2 + 1), a @ x), np.ones(3), 100, 1e-9)
    assert np.abs(x).max() < 1e-4
