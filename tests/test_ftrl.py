"""FTRL-proximal against a plain run, and its merging of shards."""

import math

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import ftrl
from tessera.operators import metrics as mt
from tessera.operators import models as md

SETTINGS = dict(alpha=0.05, beta=0.1, l1=0.3, l2=5.0)


def rows_of(n=300, slots=40):
    rnd = np.random.default_rng(2)
    out = []
    for i in range(n):
        at = sorted(rnd.choice(slots, 6, replace=False).tolist())
        x = rnd.normal(size=6).tolist()
        out.append((i, at, x, int(sum(v for a, v in zip(at, x) if a < 8) + rnd.normal(0, 0.2) > 0)))
    return out


def frame(spark, rows, slots=40):
    return spark.createDataFrame([(i, Vectors.sparse(slots, at, x), float(y)) for i, at, x, y in rows], ["id", "features", "label"])


def plain(rows, order, passes, alpha, beta, l1, l2):
    """The textbook loop, one number at a time."""
    z, n = {}, {}

    def w(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(passes):
        for k in order:
            _, at, x, y = rows[k]
            pairs = [(-1, 1.0), *zip(at, x)]
            error = min(max(sum(w(i) * v for i, v in pairs) - y, -1.0), 1.0)
            old = {i: w(i) for i, _ in pairs}
            for i, v in pairs:
                g = error * v
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * old[i]
                n[i] = n.get(i, 0.0) + g * g
    return z, n


def order_of(spark, df):
    """The ids in the order in which a single shard learns them."""
    from tessera.operators.boosting import entries
    rows = entries(df).select("id", F.xxhash64("id", "_e", "label").alias("h")).orderBy("h").collect()
    return [r["id"] for r in rows]


def test_one_shard_is_the_plain_online_learner(spark):
    rows = rows_of()
    df = frame(spark, rows).repartition(5)
    got = {r["slot"]: (r["z"], r["n"]) for r in ftrl.fit(df, **SETTINGS, passes=3, shards=1).collect()}
    z, n = plain(rows, order_of(spark, df), 3, **SETTINGS)
    assert got.keys() == z.keys()
    assert all(abs(got[i][0] - z[i]) < 1e-12 * max(1, abs(z[i])) and abs(got[i][1] - n[i]) < 1e-12 * max(1, n[i]) for i in z)


def test_shards_don_t_depend_on_the_layout_and_add_up(spark):
    rows = rows_of()
    df = frame(spark, rows)
    a = ftrl.fit(df.repartition(7), **SETTINGS, shards=4).orderBy("slot").collect()
    b = ftrl.fit(df.coalesce(1), **SETTINGS, shards=4).orderBy("slot").collect()
    assert a == b
    # After one pass, the state is the sum of what each shard learns from nothing.
    from tessera.operators.boosting import entries
    shard = {r["id"]: r["s"] for r in entries(df).select("id", F.pmod(F.xxhash64(F.xxhash64("id", "_e", "label")), F.lit(4)).alias("s")).collect()}
    order = order_of(spark, df)
    want = {}
    for s in range(4):
        z, _ = plain(rows, [k for k in order if shard[k] == s], 1, **SETTINGS)
        for i, v in z.items():
            want[i] = want.get(i, 0.0) + v
    got = {r["slot"]: r["z"] for r in ftrl.fit(df, **SETTINGS, passes=1, shards=4).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_margins_of_more_shards_stay_close(spark):
    """Stated bound: with a few shards the ranking stays, scores move by less than 0.1."""
    df = frame(spark, rows_of(600))
    one, four = ({r["id"]: r["score"] for r in md.linear_score(df, df, "features", "label", **SETTINGS, shards=s).where("set = 'test'").collect()} for s in (1, 4))
    assert max(abs(one[i] - four[i]) for i in one) < 0.1
    assert np.corrcoef([one[i] for i in sorted(one)], [four[i] for i in sorted(one)])[0, 1] > 0.95


def test_l1_makes_weights_zero(spark):
    df = frame(spark, rows_of())
    sizes = []
    for l1 in (0.0, 2.0, 8.0, 1e6):
        s = SETTINGS | {"l1": l1}
        sizes.append(ftrl.weights(ftrl.fit(df, **s), **s).count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == 0


def test_learns_on_left_out_rows_and_odd_input(spark):
    df = frame(spark, rows_of(900))
    tr, te = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    s = md.linear_score(tr, te, "features", "label", alpha=0.5, l2=0.1, max_iter=5).where("set = 'test'").join(te.select("id", "label"), "id")
    assert mt.binned_auc(s, "label", "score", method="exact").first()["auc"] > 0.9
    none = md.linear_score(tr.limit(0), te, "features", "label")
    assert {r["score"] for r in none.collect()} == {0.5}
    empty = spark.createDataFrame([(1, Vectors.sparse(40, [], []), 1.0), (1, Vectors.sparse(40, [], []), 1.0)], ["id", "features", "label"])
    assert [r["score"] > 0.5 for r in md.linear_score(empty, empty, "features", "label", l2=1.0).collect()] == [True] * 4
