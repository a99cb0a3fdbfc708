"""Truncated SVD and the text encoder against numpy."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import svd


def matrix_of(spark, a):
    return spark.createDataFrame([(str(i), f"t{j}", float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1]) if a[i, j]], "row string, term string, weight double")


def test_singular_values_and_projections_agree_with_numpy(spark):
    rnd = np.random.default_rng(4)
    u, _ = np.linalg.qr(rnd.normal(size=(40, 12)))
    v, _ = np.linalg.qr(rnd.normal(size=(25, 12)))
    a = (u * np.array([9, 7, 5, 3, 0.4, 0.3, 0.2, 0.1, 0.05, 0.04, 0.03, 0.02])) @ v.T
    m = matrix_of(spark, a)
    factors, sizes = svd.truncated_svd(m, 4, iterations=5)
    want_u, want, want_v = np.linalg.svd(a)
    assert np.allclose(sizes, want[:4], atol=1e-6)
    rows = {r["row"]: [r[c] for c in ("v0", "v1", "v2", "v3")] for r in svd.times(m, factors, "term", "row", 4).collect()}
    got = np.array([rows[str(i)] for i in range(40)])
    for k in range(4):
        ours, theirs = got[:, k], want_u[:, k] * want[k]
        assert np.allclose(ours * np.sign(ours @ theirs), theirs, atol=1e-6)
    g = svd.products(factors, 4)
    assert np.allclose(g, np.eye(4), atol=1e-10)


def test_low_rank_leaves_zero_factors(spark):
    a = np.outer(np.arange(1, 7.0), np.arange(1, 5.0))
    factors, sizes = svd.truncated_svd(matrix_of(spark, a), 3, iterations=2)
    assert abs(sizes[0] - np.linalg.norm(a)) < 1e-8 and np.allclose(sizes[1:], 0, atol=1e-7)


def test_encoder_brings_texts_of_one_topic_together(spark):
    rnd = np.random.default_rng(1)
    topics = [["river", "boat", "water", "fish", "harbour"], ["engine", "piston", "wheel", "gear", "brake"]]
    rows = [(i, " ".join(rnd.choice(topics[i % 2], 4)), " ".join(rnd.choice(topics[i % 2], 4)), "x") for i in range(60)] + [(100, None, "", "x"), (101, "unheard words", "boat", "x")]
    df = spark.createDataFrame(rows, "id long, a string, b string, row string")
    model = svd.SvdEncoder(dim=2, min_df=2, iterations=4).fit(df.where("id < 100"), ["a", "b"])
    got = {r["id"]: np.array(r["vec"]) for r in model.transform(df, ["a", "b"]).collect()}
    assert len(got) == 62 and all(len(v) == 4 for v in got.values())
    assert not got[100].any() and not got[101][:2].any() and got[101][2:].any()
    cos = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    assert min(cos(got[0][:2], got[k][:2]) for k in range(2, 60, 2)) > 0.8 > 0.3 > max(cos(got[0][:2], got[k][:2]) for k in range(1, 60, 2))
    again = {r["id"]: np.array(r["vec"]) for r in model.transform(df.where(F.col("id") < 3), ["a", "b"]).collect()}
    assert all(np.allclose(again[k], got[k]) for k in again)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, a string")
    model = svd.SvdEncoder(dim=2).fit(df, ["a"])
    assert model.transform(df, ["a"]).count() == 0


def test_held_factors_give_what_the_tables_give(spark, monkeypatch):
    """The packed rows' passes, cut into small runs, against the joins; also projections, and that the joins aren't used below the bound."""
    rnd = np.random.default_rng(7)
    a = rnd.normal(size=(60, 15)) * (rnd.random((60, 15)) < 0.4)
    m = matrix_of(spark, a)
    monkeypatch.setattr(svd, "HELD", 0)
    want, sizes = svd.truncated_svd(m, 3, iterations=2)
    monkeypatch.undo()
    monkeypatch.setattr(svd, "ENTRIES", 7)
    monkeypatch.setattr(svd, "times", None)
    got, found = svd.truncated_svd(m, 3, iterations=2)
    assert np.allclose(found, sizes)
    (terms, v), (same, w) = svd.held(got, 3), svd.held(want, 3)
    assert terms == same and np.allclose(v * np.sign((v * w).sum(0)), w, atol=1e-6)
    rows = {r["row"]: r["_v"] for r in svd.projected(svd.packed(m, terms), v).collect()}
    b = a[:, [int(t[1:]) for t in terms]]
    assert all(np.allclose(rows.get(str(i), np.zeros(3)), b[i] @ v) for i in range(60))
