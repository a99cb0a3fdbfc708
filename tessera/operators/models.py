"""Training and scoring jobs on ``pyspark.ml`` (#71-78, #84).

Every job takes a train frame (with the label) and a test frame, whose ``features`` are either named numeric columns
(assembled into a vector, missing values filled with 0) or one column of ml vectors, such as
:meth:`tessera.operators.pipeline.FeatureModel.vectors` gives; it fits, and returns long scores ``(set, id, score)`` with ``set`` in
``{'train', 'test'}`` and ``score`` = P(class 1). Fitting is the distributed ml implementation (tree
statistics, gradients and L-BFGS steps are aggregated across partitions); the only driver-side loop is over
the k folds of the k-fold job, a count fixed by the caller. The assembled train and test frames are
written once to the shared folder (compact: id, vector, label), so the iterations and the folds never re-run the feature
plan.

Defaults are the reference's settings as far as the learners have them; scores differ from its libraries by
construction. The k-fold, the linear and the network job have learners of their own
(:mod:`tessera.operators.boosting`, :mod:`tessera.operators.ftrl`, :mod:`tessera.operators.network`).
"""

from __future__ import annotations

from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.nulls import nan_safe_sigmoid
from tessera.operators import ftrl, network
from tessera.operators.assemble import split_by_presence
from tessera.operators.boosting import Settings, kfold_boosting
from tessera.operators.splits import hash_split
from tessera.session import cut_lineage


def to_vector(df: DataFrame, cols, out: str = "features", fill: float = 0.0) -> DataFrame:
    """Assemble numeric columns (in the given, recorded order) into an ml vector; nulls and NaN -> ``fill``."""
    filled = df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(fill)), F.lit(fill))
                             for c in cols})
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(filled)


def _p1(col: str = "probability"):
    return vector_to_array(F.col(col))[1]


def _score_both(model, train: DataFrame, test: DataFrame, key: str, score_expr=None) -> DataFrame:
    score_expr = score_expr if score_expr is not None else _p1()
    tr = model.transform(train).select(F.lit("train").alias("set"), F.col(key).alias("id"),
                                       score_expr.alias("score"))
    te = model.transform(test).select(F.lit("test").alias("set"), F.col(key).alias("id"),
                                      score_expr.alias("score"))
    return tr.unionByName(te)


def _prep(train, test, features, label, key: str = "id", keep=()):
    """Assembled, compact frames ``(key, features, label, *keep)`` and ``(key, features)``, written once as
    tables in the shared checkpoint folder: iterative fitting, the k-fold loop and scoring then read them
    instead of recomputing the feature plan, and a lost executor re-reads the written table, not the raw
    tables.

    Seeded ml sampling (bagging, row subsampling) depends on which partition a row is in and on its position
    there. A table read back from files comes in file-listing order, which the file system does not fix, so
    the training rows are put into a layout that depends on the data only: hash-partitioned and sorted by key.
    """
    if isinstance(features, str):
        named = lambda df: df.withColumnRenamed(features, "features")
    else:
        named = lambda df: to_vector(df, features)
    tr = named(train).withColumn("label", F.col(label).cast("double")).select(key, "features", "label", *keep)
    te = named(test).select(key, "features")
    tr = cut_lineage(tr)
    # A partition count that follows the number of rows: AQE does not coalesce it, so the layout cannot follow shuffle
    # byte sizes, and the many short jobs of a boosting run don't pay for partitions that hold next to nothing.
    n = min(int(tr.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + tr.count() // 20_000)
    return tr.repartition(n, key).sortWithinPartitions(key), cut_lineage(te)


def rf_score(train: DataFrame, test: DataFrame, features, label: str, key: str = "id", max_depth: int = 20,
             num_trees: int = 100, impurity: str = "entropy", feature_subset: str = "sqrt",
             seed: int = 233) -> DataFrame:
    """Random forest (entropy, depth 20, 100 trees, sqrt features, seed 233)."""
    tr, te = _prep(train, test, features, label, key)
    m = RandomForestClassifier(impurity=impurity, maxDepth=max_depth, numTrees=num_trees,
                               featureSubsetStrategy=feature_subset, seed=seed).fit(tr)
    return _score_both(m, tr, te, key)


def _gbt(max_iter, step, depth, subsample, colsample, seed, **kw):
    return GBTClassifier(maxIter=max_iter, stepSize=step, maxDepth=depth, subsamplingRate=subsample,
                         featureSubsetStrategy=str(colsample), seed=seed, **kw)


def gbt_score(train: DataFrame, test: DataFrame, features, label: str, key: str = "id", max_iter: int = 30,
              step: float = 0.05, max_depth: int = 4, subsample: float = 0.85, colsample: float = 0.25,
              seed: int = 0) -> DataFrame:
    """Boosted trees (30 rounds, step 0.05, depth 4, row subsample 0.85, feature subsample 0.25)."""
    tr, te = _prep(train, test, features, label, key)
    m = _gbt(max_iter, step, max_depth, subsample, colsample, seed).fit(tr)
    return _score_both(m, tr, te, key)


def gbt_kfold_score(train: DataFrame, test: DataFrame, features, label: str, key: str = "id", k: int = 5,
                    seed: int = 0, max_iter: int = 10000, step: float = 0.025, leaves: int = 31, max_depth: int = 14,
                    subsample: float = 0.85, bag_every: int = 5, colsample: float = 0.85, l2: float = 1.0, min_rows: int = 20,
                    patience: int = 100, max_bins: int = 63, out_of_fold: bool = False) -> DataFrame:
    """k models of :mod:`tessera.operators.boosting`, each with one fold as its validation set: a model stops when ``patience``
    rounds haven't raised the validation AUC and predicts at its best round. Test scores and (like the
    reference) in-sample train scores are averaged over the k models. ``out_of_fold=True`` instead scores
    each training row only by the model that did not train on it."""
    tr, te = _prep(train, test, features, label, key)
    s = Settings(step, leaves, max_depth, l2, min_rows, subsample=subsample, bag_every=bag_every, colsample=colsample, seed=seed)
    u, _ = kfold_boosting(tr, te, key, k, max_iter, patience, max_bins, s)
    u = cut_lineage(u)
    if out_of_fold:
        u = u.where("set = 'test' or fold = own")
    return u.groupBy("set", "id").agg(F.avg("score").alias("score"))


def linear_score(train: DataFrame, test: DataFrame, features, label: str, key: str = "id", alpha: float = 0.01, beta: float = 0.1,
                 l1: float = 0.1, l2: float = 1000.0, max_iter: int = 2, fill: str = "zero", shards: int | None = None) -> DataFrame:
    """FTRL-proximal with the identity link, ``max_iter`` passes (:mod:`tessera.operators.ftrl`); the margin goes through the NaN-safe
    sigmoid (#18), whose ``fill`` says what a NaN margin becomes: zero, or the mean margin of its set."""
    tr, te = _prep(train, test, features, label, key)
    w = cut_lineage(ftrl.weights(ftrl.fit(tr, alpha, beta, l1, l2, max_iter, shards=shards), alpha, beta, l1, l2))
    parts = [nan_safe_sigmoid(ftrl.margins(df, key, w), "margin", fill=fill).select(F.lit(name).alias("set"), "id", F.col("margin").alias("score"))
             for name, df in (("train", tr), ("test", te))]
    return parts[0].unionByName(parts[1])


def mlp_score(train: DataFrame, test: DataFrame, features, label: str, key: str = "id", hidden=(64, 32),
              max_iter: int = 100, seed: int = 0) -> DataFrame:
    """Feed-forward network with sigmoid hidden layers and a softmax output over two classes (:mod:`tessera.operators.network`)."""
    tr, te = _prep(train, test, features, label, key)
    layers = [tr.select("features").first()[0].size if isinstance(features, str) else len(features), *hidden, 2]
    # The start weights alone: that learner makes rows dense, and thousands of slots would be multiplied for each.
    start = MultilayerPerceptronClassifier(layers=layers, maxIter=0, seed=seed).fit(tr.limit(1)).weights.toArray()
    w = network.fit(tr, layers, start, max_iter)
    parts = [network.scores(df, key, layers, w).select(F.lit(name).alias("set"), "id", "score") for name, df in (("train", tr), ("test", te))]
    return parts[0].unionByName(parts[1])


def softmax_score(df: DataFrame, features_col: str | list[str], label: str, key: str = "id", train_frac: float = 0.9,
                  seed: int = 0, reg: float = 0.01, max_iter: int = 100) -> DataFrame:
    """Multinomial logistic regression on one array column, or on several put end to end (dropout replaced by L2).
    Fitted on a hash split of ``train_frac`` of the rows; returns ``(set, id, probs array<double>)``."""
    from pyspark.ml.functions import array_to_vector
    blocks = [features_col] if isinstance(features_col, str) else features_col
    d = df.withColumn("features", array_to_vector(F.concat(*[F.col(c).cast("array<double>") for c in blocks]))) \
        .withColumn("label", F.col(label).cast("double"))
    tr, va = hash_split(d, train_frac, seed=seed, key=key)
    m = LogisticRegression(family="multinomial", regParam=reg, elasticNetParam=0.0, maxIter=max_iter).fit(tr)
    probs = vector_to_array(F.col("probability"))
    return (m.transform(tr).select(F.lit("train").alias("set"), F.col(key).alias("id"), probs.alias("probs"))
            .unionByName(m.transform(va).select(F.lit("valid").alias("set"), F.col(key).alias("id"),
                                                probs.alias("probs"))))


def split_train_merge(train: DataFrame, test: DataFrame, presence_col: str, job, prepare=None, **kw) -> DataFrame:
    """Fit and score the rows where ``presence_col`` is present and those where it is absent separately
    (each part with its own job), then union the scores. ``prepare(train, test, present)`` encodes a part, so that
    each has feature lists and encoders of its own."""
    parts = zip(split_by_presence(train, presence_col), split_by_presence(test, presence_col), (True, False))
    present, absent = (job(*(prepare(tr, te, has) if prepare else (tr, te)), **kw) for tr, te, has in parts)
    return present.unionByName(absent)


def score_checks(scores: DataFrame, labels: DataFrame | None = None, on: str = "train") -> DataFrame:
    """``(set, id, ok)``: whether each score is a probability. With ``labels(id, label)``, one more row ``('auc', -1, ok)`` says
    whether the scores of the set ``on`` rank the labelled rows better than a constant would."""
    from tessera.operators.metrics import binned_auc
    ok = F.coalesce(F.col("score").between(0.0, 1.0) & ~F.isnan("score"), F.lit(False))
    out = scores.select("set", F.col("id").cast("long").alias("id"), ok.alias("ok"))
    if labels is None:
        return out
    ranked = scores.where(F.col("set") == on).join(labels, "id")
    auc = binned_auc(ranked, "label", "score", method="exact")
    return out.unionByName(auc.select(F.lit("auc").alias("set"), F.lit(-1).cast("long").alias("id"), F.coalesce(F.col("auc") > 0.5, F.lit(False)).alias("ok")))


def ensemble_stack(train_long: DataFrame, labels: DataFrame, test_long: DataFrame, models: list[str],
                   label: str = "label", key: str = "id", max_iter: int = 400, max_depth: int = 4,
                   step: float = 0.01, train_frac: float = 0.8, seed: int = 233, subsample: float = 0.4,
                   colsample: float = 0.45) -> DataFrame:
    """Stacked model: per-model scores (min-max scaled, train and test each with their own bounds as in
    the reference) become the features of a boosted-tree model fitted on a hash split of ``train_frac``
    of the labelled ids (the reference only reports errors on the rest); returns ``(set, id, score)`` for the test ids."""
    from tessera.operators.ensemble import pivot_scores, score_minmax
    tr = pivot_scores(score_minmax(train_long), models).join(labels.select(key, label), key)
    te = pivot_scores(score_minmax(test_long), models)
    fit_part, _ = hash_split(tr, train_frac, seed=seed, key=key)
    fit_v, _ = _prep(fit_part, te, models, label, key)
    m = _gbt(max_iter, step, max_depth, subsample, colsample, seed).fit(fit_v)
    return m.transform(to_vector(te, models)).select(F.lit("test").alias("set"), F.col(key).alias("id"),
                                                     _p1().alias("score"))
