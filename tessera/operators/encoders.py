"""Feature encoders (#27-29, #56-60): ``fit`` on one frame returns a small model, ``transform`` applies it to
any frame with joins and projections, so rows never seen at fit time are encoded the same way.

Categorical work is done in long form ``(id, feature, value)`` (one ``stack`` per row, no shuffle), so
the number of categorical columns never widens a plan. ``fit`` is an action: the model tables it returns
(dictionaries, per-category statistics) are written once as tables in the shared checkpoint folder, so each ``transform`` and
each size check reads them instead of re-running the fit over the training rows. Model tables that grow with the data (category
dictionaries, per-category statistics) are joined through the size-checked lookup join; models that are a
fixed handful of numbers per column (min/max bounds, the prior) are collected and inlined as literals.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.operators.ordering import dense_index_within
from tessera.session import cut_lineage


def to_long(df: DataFrame, cols, key: str = "id", extra: tuple = ()) -> DataFrame:
    """``(key, *extra, feature, value)``: one row per (row, categorical column); values as strings."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return df.select(key, *extra, F.inline(pairs))


# ------------------------------------------------------------------ category dictionary (#29) + one-hot (#56)

def category_index(df: DataFrame, cols, key: str = "id") -> DataFrame:
    """Fit: ``(feature, value, index)``, distinct non-null values of each column, index 0.. in value order."""
    distinct = to_long(df, cols, key).where(F.col("value").isNotNull()).select("feature", "value").distinct()
    return dense_index_within(distinct, "feature", ["value"], out="index")


@dataclass
class OneHotModel:
    dictionary: DataFrame  # (feature, value, index, slot)
    cols: tuple

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        """Sparse one-hot rows ``(key, feature, slot)``: one per known value; unknown and null -> no row
        (all zeros). ``slot`` numbers the columns of all features in order: feature order, then value order."""
        long = to_long(df, self.cols, key).where(F.col("value").isNotNull())
        j = lookup_join(long, self.dictionary.select("feature", "value", "slot"), ["feature", "value"],
                        spread=key)
        return j.select(key, "feature", "slot")


class OneHot:
    def __init__(self, cols):
        self.cols = tuple(cols)

    def fit(self, df: DataFrame, key: str = "id") -> OneHotModel:
        idx = category_index(df, self.cols, key)
        # Offset of each feature = number of values of the features before it (one row per feature).
        sizes = idx.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
        order = F.create_map(*[x for i, c in enumerate(self.cols) for x in (F.lit(c), F.lit(i))])
        from pyspark.sql import Window
        before = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (sizes.withColumn("pos", order[F.col("feature")])
                   .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
                   .select("feature", "offset"))
        d = idx.join(F.broadcast(offsets), "feature").withColumn("slot", (F.col("offset") + F.col("index"))
                                                                  .cast("int")).drop("offset")
        return OneHotModel(cut_lineage(d), self.cols)


# ------------------------------------------------------------------ multi-hot of comma lists (#58)

def split_list(col, sep: str = ",") -> "F.Column":
    """Lowercase, split on ``sep``, trim each item; empty items are kept as ''. Distinct items."""
    return F.array_distinct(F.transform(F.split(F.lower(F.col(col)), re.escape(sep)), lambda t: F.trim(t)))


@dataclass
class MultiHotModel:
    vocab: DataFrame  # (feature, value, index)
    cols: tuple
    sep: str

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        """Presence rows ``(key, feature, index)`` for every known item of each list (binary)."""
        items = F.array(*[F.struct(F.lit(c).alias("feature"), split_list(c, self.sep).alias("items"))
                          for c in self.cols])
        long = (df.select(key, F.inline(items)).select(key, "feature", F.explode("items").alias("value")))
        return lookup_join(long, self.vocab, ["feature", "value"], spread=key).select(key, "feature", "index")


class MultiHot:
    def __init__(self, cols, sep: str = ","):
        self.cols, self.sep = tuple(cols), sep

    def fit(self, df: DataFrame, key: str = "id") -> MultiHotModel:
        items = F.array(*[F.struct(F.lit(c).alias("feature"), split_list(c, self.sep).alias("items"))
                          for c in self.cols])
        distinct = (df.select(F.inline(items)).select("feature", F.explode("items").alias("value"))
                    .distinct())
        vocab = cut_lineage(dense_index_within(distinct, "feature", ["value"], out="index"))
        return MultiHotModel(vocab, self.cols, self.sep)


# ------------------------------------------------------------------ target mean encoding (#28, #57)

@dataclass
class TargetEncodeModel:
    stats: DataFrame  # (feature, value, n, mean[, fold, ...])
    prior: float
    cols: tuple
    method: str
    m: float
    min_samples_leaf: int
    smoothing: float

    def _encode(self, n, mean):
        prior = F.lit(self.prior)
        if self.method == "m":
            return (n * mean + F.lit(self.m) * prior) / (n + F.lit(self.m))
        w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(self.min_samples_leaf)) / F.lit(self.smoothing)))
        return F.when(n == 1, prior).otherwise(prior * (F.lit(1.0) - w) + mean * w)

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        """``(key, feature, encoded)``: smoothed category mean; unknown or null category -> prior."""
        long = to_long(df, self.cols, key)
        j = lookup_join(long, self.stats.select("feature", "value", "n", "mean"), ["feature", "value"],
                        how="left", spread=key)
        enc = F.coalesce(self._encode(F.col("n"), F.col("mean")), F.lit(self.prior))
        return j.select(key, "feature", enc.alias("encoded"))


class TargetEncode:
    """``method='logistic'``: w = 1/(1+exp(-(n - min_samples_leaf)/smoothing)), value = prior(1-w) + mean w,
    a category seen once takes the prior. ``method='m'``: (n mean + m prior)/(n + m)."""

    def __init__(self, cols, label: str, method: str = "logistic", m: float = 1.0, min_samples_leaf: int = 1,
                 smoothing: float = 1.0):
        if method not in ("logistic", "m"):
            raise ValueError("method must be 'logistic' or 'm'")
        self.cols, self.label, self.method = tuple(cols), label, method
        self.m, self.min_samples_leaf, self.smoothing = m, min_samples_leaf, smoothing

    def fit(self, df: DataFrame, key: str = "id") -> TargetEncodeModel:
        y = F.col(self.label).cast("double")
        prior = df.select(F.avg(y)).first()[0]
        long = to_long(df, self.cols, key, extra=(self.label,)).where(F.col("value").isNotNull())
        stats = long.groupBy("feature", "value").agg(F.count(self.label).alias("n"),  # labelled rows only
                                                     F.avg(F.col(self.label).cast("double")).alias("mean"))
        return TargetEncodeModel(cut_lineage(stats), float(prior if prior is not None else math.nan), self.cols,
                                 self.method, self.m, self.min_samples_leaf, self.smoothing)

    def fit_transform_out_of_fold(self, df: DataFrame, fold_col: str, key: str = "id") -> DataFrame:
        """Encode each training row with statistics from the other folds only (no label leakage).

        Per-(category, fold) sums are subtracted from the per-category totals; both are aggregates, so a
        hot category is combined map-side and never collected into one task.
        """
        y = F.col(self.label).cast("double")
        long = to_long(df, self.cols, key, extra=(self.label, fold_col)).where(F.col("value").isNotNull())
        per_fold = long.groupBy("feature", "value", fold_col).agg(F.count(y).alias("nf"),
                                                                  F.coalesce(F.sum(y), F.lit(0.0)).alias("sf"))
        totals = per_fold.groupBy("feature", "value").agg(F.sum("nf").alias("nt"), F.sum("sf").alias("st"))
        fold_tot = df.groupBy(fold_col).agg(F.count(y).alias("rows"), F.coalesce(F.sum(y), F.lit(0.0)).alias("ysum"))
        oof = (per_fold.join(totals, ["feature", "value"])
               .select("feature", "value", fold_col, (F.col("nt") - F.col("nf")).alias("n"),
                       F.try_divide(F.col("st") - F.col("sf"), F.col("nt") - F.col("nf")).alias("mean")))
        all_rows = fold_tot.agg(F.sum("rows").alias("R"), F.sum("ysum").alias("Y")).first()
        priors = fold_tot.select(fold_col, F.try_divide(F.lit(all_rows["Y"]) - F.col("ysum"),
                                                        F.lit(all_rows["R"]) - F.col("rows")).alias("prior"))
        rows = to_long(df, self.cols, key, extra=(fold_col,)).join(F.broadcast(priors), fold_col)  # k rows
        # Per-(category, fold) statistics grow with the categories: written once, then the size-checked,
        # salted lookup join (a category holding a third of the rows does not land in one task).
        j = lookup_join(rows, cut_lineage(oof), ["feature", "value", fold_col], how="left", spread=key)
        n, mean, prior = F.col("n"), F.col("mean"), F.col("prior")
        if self.method == "m":
            enc = (n * mean + F.lit(self.m) * prior) / (n + F.lit(self.m))
        else:
            w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(self.min_samples_leaf)) / F.lit(self.smoothing)))
            enc = F.when(n == 1, prior).when(n > 1, prior * (F.lit(1.0) - w) + mean * w)
        return j.select(key, "feature", F.coalesce(enc, prior).alias("encoded"))


# ------------------------------------------------------------------ min-max scaling (#27, #59)

@dataclass
class MinMaxModel:
    bounds: dict  # column -> (min, max)

    def table(self, spark) -> DataFrame:
        rows = [(c, lo, hi) for c, (lo, hi) in self.bounds.items()]
        return spark.createDataFrame(rows, "feature string, min_value double, max_value double")

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - min) / (max - min) with the fitted bounds; a zero range divides by 1; no clipping; NaN and
        null pass through."""
        out = {}
        for c, (lo, hi) in self.bounds.items():
            rng = (hi - lo) if (lo is not None and hi is not None and hi != lo) else 1.0
            base = lo if lo is not None else math.nan
            out[c] = (F.col(c).cast("double") - F.lit(base)) / F.lit(rng)
        return df.withColumns(out)


def minmax_bounds(df: DataFrame, cols) -> DataFrame:
    """Fit as a table ``(feature, min_value, max_value)``: one aggregate over all columns, NaN ignored."""
    def ok(c):
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x)
    aggs = []
    for c in cols:
        aggs += [F.min(ok(c)).alias(f"{c}__min"), F.max(ok(c)).alias(f"{c}__max")]
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min_value"),
                               F.col(f"{c}__max").alias("max_value")) for c in cols])
    return one.select(F.inline(pairs))


class MinMax:
    def __init__(self, cols):
        self.cols = tuple(cols)

    def fit(self, df: DataFrame) -> MinMaxModel:
        row = minmax_bounds(df, self.cols).collect()  # one row per column
        return MinMaxModel({r["feature"]: (r["min_value"], r["max_value"]) for r in row})


# ------------------------------------------------------------------ degree-2 polynomial (#60)

def poly2(x) -> "F.Column":
    """``[1, x_1..x_k, x_i * x_j for i <= j]`` (bias first, then the linear terms, then the products in
    i-major order) from an array column."""
    x = F.col(x) if isinstance(x, str) else x
    prods = F.flatten(F.transform(x, lambda a, i: F.transform(F.slice(x, i + 1, F.size(x) - i),
                                                               lambda b: a * b)))
    return F.concat(F.array(F.lit(1.0)), x, prods)


class Poly2:
    def __init__(self, cols, out: str = "poly"):
        self.cols, self.out = tuple(cols), out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.out, poly2(F.array(*[F.col(c).cast("double") for c in self.cols])))
