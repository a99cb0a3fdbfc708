"""Prediction tables and ensembles (#23, #33, #77, #80-85).

All blends work on the long form ``(model, id, score)``: one ``groupBy(id)`` with partial aggregation per
blend. Per-model tables (weights, bounds) have one row per model, a size fixed by the caller, and are
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scores_long(tables: dict, key: str = "id", score: str = "project_is_approved") -> DataFrame:
    """``{model name: (id, score) frame}`` -> long ``(model, id, score)``."""
    parts = [df.select(F.lit(name).alias("model"), F.col(key).alias("id"), F.col(score).cast("double").alias("score"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_mean(scores: DataFrame, key: str = "id", score: str = "score") -> DataFrame:
    """Average of the k fold models' scores per id."""
    return scores.groupBy(key).agg(F.avg(score).alias(score))


def ensemble_mean(long: DataFrame) -> DataFrame:
    """Equal-weight mean per id."""
    return long.groupBy("id").agg(F.avg("score").alias("score"))


def power_weights(spark, leaderboard: dict, power: float = 75.0) -> DataFrame:
    """``(model, w)`` with w proportional to (10 s)^power / 10000; returned divided by the largest weight, i.e.
    (s / s_max)^power, which leaves every normalised blend unchanged and cannot overflow."""
    smax = max(leaderboard.values())
    rows = [(m, float((s / smax) ** power)) for m, s in leaderboard.items()]
    return spark.createDataFrame(rows, "model string, w double")


def ensemble_weighted(long: DataFrame, weights: DataFrame) -> DataFrame:
    """sum(w * score) / sum(w) per id; ``weights`` is ``(model, w)`` with one row per model. A model without a
    weight is an error, raised when the plan runs."""
    missing = F.raise_error(F.concat(F.lit("no weight for model "), F.col("model"))).cast("double")
    j = long.join(F.broadcast(weights), "model", "left").withColumn("w", F.coalesce(F.col("w"), missing))
    return j.groupBy("id").agg((F.sum(F.col("w") * F.col("score")) / F.sum("w")).alias("score"))


def score_minmax(long: DataFrame) -> DataFrame:
    """Min-max scale each model's scores with that model's own bounds (constant model -> 0)."""
    b = long.groupBy("model").agg(F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    j = long.join(F.broadcast(b), "model")
    rng = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))
    return j.select("model", "id", ((F.col("score") - F.col("_lo")) / rng).alias("score"))


def pivot_scores(long: DataFrame, models: list[str]) -> DataFrame:
    """One row per id, one score column per model (model list given, so no discovery pass)."""
    return long.groupBy("id").pivot("model", models).agg(F.first("score"))


def fill_template(template: DataFrame, scores: DataFrame, key: str = "id", col: str = "project_is_approved",
                  score: str = "score") -> DataFrame:
    """Replace the template's score column by the blended score of the same id (null when missing).
    Key-based, so row order of either side does not matter."""
    s = scores.select(F.col(key), F.col(score).alias("_new"))
    return template.join(s, key, "left").withColumn(col, F.col("_new")).drop("_new")


def wide_from_array(df: DataFrame, classes: list[str], key: str = "id", probs: str = "probs") -> DataFrame:
    """``(id, probs array)`` with probs[i] for class i -> one column per class (a projection, no shuffle)."""
    return df.select(key, *[F.col(probs)[i].alias(c) for i, c in enumerate(classes)])
