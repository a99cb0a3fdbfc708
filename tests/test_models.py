"""Model jobs: rows, score range, determinism, and signal recovery on a planted label."""

import inspect

from pyspark.sql import functions as F

from tessera.operators import metrics as mt
from tessera.operators import models as md
from tessera.plans import queries


def planted(spark, n=400):
    df = spark.range(n).select(F.col("id"), (F.rand(7)).alias("x1"), F.rand(11).alias("x2"))
    return df.withColumn("y", (F.col("x1") + 0.2 * F.rand(3) > 0.6).cast("int"))


def test_jobs_score_in_range_and_learn(spark):
    df = planted(spark)
    train, test = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    for job, kw in [(md.rf_score, dict(max_depth=4, num_trees=10)), (md.gbt_score, dict(max_iter=5)),
                    (md.linear_score, dict(max_iter=20, l2=1.0)), (md.mlp_score, dict(hidden=(4,), max_iter=50)),
                    (md.gbt_kfold_score, dict(k=3, max_iter=3))]:
        s = job(train, test, ["x1", "x2"], "y", **kw)
        rows = s.collect()
        assert len(rows) == 400
        assert all(0.0 <= r["score"] <= 1.0 for r in rows)
        scored = s.where("set = 'test'").join(df.select("id", "y"), "id")
        auc = mt.binned_auc(scored, "y", "score", method="exact").first()["auc"]
        assert auc > 0.7, (job.__name__, auc)


def test_rf_deterministic_under_seed(spark):
    df = planted(spark, 200)
    a = md.rf_score(df, df, ["x1", "x2"], "y", max_depth=3, num_trees=5).orderBy("set", "id").collect()
    b = md.rf_score(df, df, ["x1", "x2"], "y", max_depth=3, num_trees=5).orderBy("set", "id").collect()
    assert a == b


def test_registered_kfold_job_has_all_rounds(monkeypatch):
    """Early stopping ends a fold, not a number of rounds below the job's 10000."""
    job, seen = inspect.signature(md.gbt_kfold_score), []
    monkeypatch.setattr(queries, "model_frames", lambda spark, sf: (None, None))
    monkeypatch.setattr(md, "gbt_kfold_score", lambda *a, **kw: seen.append(job.bind(*a, **kw)))
    queries.QUERIES["gbt_kfold_score"](None, None)
    seen[0].apply_defaults()
    assert (seen[0].arguments["max_iter"], seen[0].arguments["k"]) == (10_000, 5)
