"""Classifier chain for categories of toxic and unwanted text.

Categories are predicted one after the other by linear models over words; each model also reads the log-odds that the
earlier ones give. In training, those are out-of-fold: they come from models that haven't seen the row, so that a
later model learns how far an earlier one can be trusted. A fold's model takes the intercept of the model of all folds, for
its own says what the rate among the rows left out is.

Which words serve as features is decided over all labelled documents: tasks count, for each word hash, the documents
of every category that hold it, Spark sums the counts, and the ``FEATURES`` words with the largest
log-likelihood ratio for each category are taken. The chain is then fitted in one task on at most ``SAMPLE``
labelled rows (those of the smallest id hashes), each reduced to the feature words it holds; both bounds are
parameters. Prediction is a map over all documents, without a shuffle.

Null and empty texts hold no words and get the rate that the intercepts say. A null label leaves its row out
for that category alone. Rows of labels that repeat an id count once, with the largest label; repeated
documents get equal answers. Without labelled rows, or with one class only, a category's probability is
its smoothed rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import batch_of, packs, table
from tessera.llm.kneser_ney import word_hashes
from tessera.llm.langid import PLAIN
from tessera.operators.joins import broadcastable
from tessera.session import cut_lineage

FEATURES, SAMPLE, FOLDS = 1000, 20_000, 5
#: The least log-likelihood ratio of a feature word; chance gives less but for one word in some thousands.
LEAST = 4.0
U = np.uint64
#: What is no ASCII punctuation counts as a space.
MARKS = bytes(c if 33 <= c < 127 and not chr(c).isalnum() else 32 for c in range(256))


def document_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, word hash)``, distinct, sorted by row. Words are runs of letters, lower-cased, their beginnings (which
    inflected forms share), and runs of marks."""
    rows, found = [], []
    for kept, most, salt in ((PLAIN, None, U(0)), (PLAIN, 5, U(1)), (PLAIN, 6, U(1)), (MARKS, None, U(2))):
        raw = [t.lower().encode().translate(kept) for t in texts]
        h, first = word_hashes(b"\n".join(raw), most)
        rows.append(np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), first, "right"))
        found.append(h ^ salt)
    row, hashes = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])) if len(row) else np.empty(0, bool)
    return row[new], hashes[new]


def word_counts(rows: DataFrame, categories: int) -> DataFrame:
    """``(word, seen array<long>, with array<long>)`` over ``rows(text, y array<int>)``: for each category, documents that hold
    the word, and those among them that belong to it. Rows without a label for a category don't count for it."""
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.int64()), *[(f"n{k}", pa.int64()) for k in range(2 * categories)]])
        held: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            words = np.concatenate([h[0] for h in held])
            marks = np.concatenate([h[1] for h in held])
            word, at = np.unique(words, return_inverse=True)
            sums = [np.bincount(at, marks[:, k], len(word)).astype(np.int64) for k in range(2 * categories)]
            return batch_of(schema, [word.view(np.int64), *sums])

        for batch in source:
            for ys, texts in packs(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                row, words = document_words(texts)
                marks = np.array([[int(y is not None) for y in r] + [int(y == 1) for y in r] for r in ys], np.int8)
                held.append((words, marks[row]))
                size += len(words)
                if size > 2_000_000:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    names = ", ".join(f"n{k} long" for k in range(2 * categories))
    return rows.select("text", "y").mapInArrow(run, f"word long, {names}").groupBy("word").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(2 * categories)])


def ratio(seen: Column, with_: Column, total: int, positive: int) -> Column:
    """Log-likelihood ratio of a word against a category."""
    def term(o: Column, e: Column) -> Column:
        return F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    n, p = float(max(1, total)), float(positive)
    cells = [(with_, seen * p / n), (seen - with_, seen * (n - p) / n), (p - with_, (n - seen) * p / n), (n - seen - p + with_, (n - seen) * (n - p) / n)]
    return sum((term(o.cast("double"), e) for o, e in cells), F.lit(0.0))


class Linear:
    """Logistic regression over sparse binary columns and a few dense ones."""

    def __init__(self, width: int, dense: int):
        self.w, self.v, self.b = np.zeros(width), np.zeros(dense), 0.0

    def logit(self, row: np.ndarray, col: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return self.b + np.bincount(row, self.w[col], len(dense)) + dense @ self.v

    def fit(self, row: np.ndarray, col: np.ndarray, dense: np.ndarray, y: np.ndarray, decay: float = 1e-4, steps: int = 300, rate: float = 0.3) -> Linear:
        """Full-batch Adam from a start at the class rate."""
        n = len(y)
        rate_of = (y.sum() + 0.5) / (n + 1)
        self.b = float(np.log(rate_of / (1 - rate_of)))
        if not 0 < y.sum() < n:
            return self
        theta = np.concatenate([self.w, self.v, [self.b]])
        width, m, s = len(self.w), np.zeros(len(theta)), np.zeros(len(theta))
        for t in range(1, steps + 1):
            self.w, self.v, self.b = theta[:width], theta[width:-1], theta[-1]
            err = (1 / (1 + np.exp(-np.clip(self.logit(row, col, dense), -30, 30))) - y) / n
            g = np.concatenate([np.bincount(col, err[row], width), dense.T @ err, [err.sum()]])
            g[:-1] += decay * theta[:-1]
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            theta = theta - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        self.w, self.v, self.b = theta[:width], theta[width:-1], float(theta[-1])
        return self


class Chain:
    """Linear models in the order of the categories; ``words`` are the sorted hashes of the feature words."""

    def __init__(self, words: np.ndarray, models: list[Linear]):
        self.words, self.models = words, models

    def logits(self, row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for m in self.models:
            out = np.column_stack([out, m.logit(row, col, np.clip(out, -30, 30))])
        return out

    def columns(self, row: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return row[:0], row[:0]
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        hit = self.words[at] == words
        return row[hit], at[hit]

    def predict(self, texts: list[str]) -> np.ndarray:
        row, words = document_words(texts)
        return 1 / (1 + np.exp(-np.clip(self.logits(*self.columns(row, words), len(texts)), -30, 30)))


def fit_chain(row: np.ndarray, col: np.ndarray, width: int, y: np.ndarray, fold: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """``y``: (rows, categories) with NaN for no label."""
    n, models = len(y), []
    dense = np.zeros((n, 0))

    def fitted(mask: np.ndarray, target: np.ndarray) -> Linear:
        place = np.cumsum(mask) - 1
        mine = mask[row]
        return Linear(width, dense.shape[1]).fit(place[row[mine]], col[mine], dense[mask], target[mask])

    for k in range(y.shape[1]):
        known = ~np.isnan(y[:, k])
        models.append(fitted(known, y[:, k]))
        if k + 1 < y.shape[1]:
            out = np.zeros(n)
            for f in range(folds):
                here = fold == f
                model = fitted(known & ~here, y[:, k])
                # The intercept tells the rate of the other folds, hence this fold's own: the whole model's stands in.
                out[here] = model.logit(row, col, dense)[here] - model.b + models[-1].b
            dense = np.column_stack([dense, np.clip(out, -30, 30)])
    return models


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], text: str = "text", id_col: str = "doc_id",
          features: int = FEATURES, sample: int = SAMPLE, folds: int = FOLDS) -> Chain:
    """Fit the chain. ``categories``: in chain order, a boolean column of ``labels`` for each."""
    k = len(categories)
    marked = labels.select(F.col(id_col).alias("id"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
    marked = cut_lineage(marked.where("id is not null").groupBy("id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(k)]))
    side = F.broadcast(marked) if broadcastable(marked, 1_000_000, 64 << 20) else marked
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(side, "id").select("id", F.coalesce("text", F.lit("")).alias("text"), F.array(*[f"y{i}" for i in range(k)]).alias("y"))
    counts = cut_lineage(word_counts(rows, k))
    totals = marked.join(docs.select(F.col(id_col).alias("id")).distinct(), "id").agg(
        *[F.count(f"y{i}").alias(f"n{i}") for i in range(k)], *[F.coalesce(F.sum(f"y{i}"), F.lit(0)).alias(f"p{i}") for i in range(k)]).first()
    picked: set[int] = set()
    for i in range(k):
        value = ratio(F.col(f"n{i}"), F.col(f"n{k + i}"), totals[f"n{i}"], totals[f"p{i}"])
        # A word of one document says nothing about others.
        picked |= {r["word"] for r in counts.where(F.col(f"n{i}") > 1).where(value >= LEAST).orderBy(F.desc(value), "word").limit(features).select("word").collect()}
    words = np.sort(np.array(sorted(picked), np.int64).view(U))
    chain = Chain(words, [])

    def reduce_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("y", pa.list_(pa.int32())), ("fold", pa.int32()), ("columns", pa.list_(pa.int32()))])
        for batch in source:
            ys, fold = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for at, texts in packs(list(range(batch.num_rows)), batch.column(0).to_pylist()):
                row, col = chain.columns(*document_words(texts))
                cuts = np.searchsorted(row, np.arange(len(texts) + 1))
                yield batch_of(schema, [[ys[a] for a in at], [fold[a] for a in at], [col[cuts[j]:cuts[j + 1]] for j in range(len(texts))]])

    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(sample)
    some = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    some = some.select(F.coalesce("text", F.lit("")).alias("text"), F.array(*[f"y{i}" for i in range(k)]).alias("y"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(folds)).cast("int").alias("fold"))
    reduced = some.mapInArrow(reduce_rows, "y array<int>, fold int, columns array<int>")

    def fit(group: pa.Table) -> pa.Table:
        lists = group.column("columns").to_pylist()
        row = np.repeat(np.arange(len(lists)), [len(c) for c in lists])
        col = np.array([c for l in lists for c in l], np.int64)
        y = np.array([[np.nan if v is None else v for v in r] for r in group.column("y").to_pylist()], np.float64)
        models = fit_chain(row, col, len(words), y, group.column("fold").to_numpy(), folds)
        return pa.table([pa.array([m.w.tolist() for m in models], pa.list_(pa.float64())), pa.array([m.v.tolist() for m in models], pa.list_(pa.float64())),
                         pa.array([float(m.b) for m in models], pa.float64()), pa.array(range(len(models)), pa.int32())], names=["w", "v", "b", "k"])

    got = sorted(reduced.groupBy(F.lit(0).alias("_all")).applyInArrow(fit, "w array<double>, v array<double>, b double, k int").collect(), key=lambda r: r["k"])
    for i in range(k):
        m = Linear(len(words), i)
        if got:
            m.w, m.v, m.b = np.array(got[i]["w"]), np.array(got[i]["v"]), got[i]["b"]
        chain.models.append(m)
    return chain


def score(docs: DataFrame, chain: Chain, names: list[str], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, <name>_score double for each category)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # bounded: FEATURES words and weights for each category

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            schema = pa.schema([batch.schema.field(0), *[(f"{n}_score", pa.float64()) for n in names]])
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield batch_of(schema, [keys, *sent.value.predict(texts).T])

    kinds = [T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(f"{n}_score", T.DoubleType()) for n in names]]
    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, T.StructType(kinds))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Probability of each category for every document; toxic documents are marked."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = train(docs, labels, {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    return score(docs, chain, ["low_quality", "toxic"]).withColumn("toxic", F.col("toxic_score") >= 0.5)
