"""A learned text encoder: truncated SVD of the TF-IDF matrix (#69).

The matrix stays the long table ``(row, term, weight)``, the term factors a table ``(term, v0, v1, ...)`` and the row factors the result of
a join. Subspace iteration multiplies the factors by the transposed matrix times the matrix: one join on the term with sums by row, one join on the
row with sums by term (sums are combined before each shuffle, so a term that is in every row is no hot spot). Before each
step the factors are made orthonormal like a tall-skinny QR: their k x k products are summed in tasks and by Spark, the driver inverts that small root, and the
factors are multiplied by it row by row; after the last step this is done twice, for the second time removes what rounding left. At last the
products of the row factors turn the basis to the singular vectors.

Where the term factors have at most ``HELD`` numbers, counted on the terms (an encoder limits its vocabulary), they are sent to the tasks as one array, and each row of the
matrix is packed with its own terms: a step is then one pass over the packed rows, which adds up its task's share of the product, and Spark adds the shares.
Beyond, the factors stay a table and the driver holds no more than k x k numbers.

A rank below k leaves the last factors zero. Rows without a known term have the zero vector.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.operators.tfidf import TfIdf
from tessera.session import cut_lineage

#: Numbers of term factors that the driver and every task may hold (8 bytes each).
HELD = 8 << 20
#: Entries of the packed matrix that are multiplied at once.
ENTRIES = 1 << 15


def _cols(k: int) -> list[str]:
    return [f"v{i}" for i in range(k)]


def products(factors: DataFrame, k: int) -> np.ndarray:
    """The k x k matrix of the factors' products: a sum of each task's, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            v = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)])
            total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k), pa.int32()), pa.array(total.ravel())], names=["p", "x"])

    out = np.zeros(k * k)
    for r in factors.select(*_cols(k)).mapInArrow(run, "p int, x double").groupBy("p").agg(F.sum("x").alias("x")).collect():
        out[r["p"]] = r["x"]
    return out.reshape(k, k)


def rotated(factors: DataFrame, m: np.ndarray, key: str) -> DataFrame:
    """Every row of the factors times the small matrix ``m``."""
    k = m.shape[0]
    v = F.array(*_cols(k))
    table = F.from_json(F.lit(json.dumps(m.T.tolist())), "array<array<double>>")  # folded to one literal
    new = F.transform(table, lambda c: F.aggregate(F.zip_with(v, c, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x))
    return factors.select(key, new.alias("_v")).select(key, *[F.col("_v")[j].alias(c) for j, c in enumerate(_cols(k))])


def root_of(factors: DataFrame | np.ndarray, k: int) -> np.ndarray:
    """The small matrix that makes the factors' columns orthonormal; columns beyond their rank become zero."""
    size, q = np.linalg.eigh(factors.T @ factors if isinstance(factors, np.ndarray) else products(factors, k))
    keep = size > 1e-12 * max(size.max(), 1e-300)
    return (q * np.where(keep, 1 / np.sqrt(np.where(keep, size, 1.0)), 0.0))[:, ::-1]


def orthonormal(factors: DataFrame, k: int, key: str) -> DataFrame:
    """Twice: the second time removes what rounding has left."""
    for _ in range(2):
        factors = cut_lineage(rotated(factors, root_of(factors, k), key))
    return factors


def times(matrix: DataFrame, factors: DataFrame, on: str, by: str, k: int) -> DataFrame:
    """``(by, v0, ...)``: the matrix (or its transpose) times factors keyed by ``on``."""
    joined = lookup_join(matrix, factors, on, spread=by) if on == "term" else matrix.join(factors, on)
    return joined.groupBy(by).agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in _cols(k)])


def held(factors: DataFrame, k: int) -> tuple[list[str], np.ndarray] | None:
    """The terms in order and their factors as an array; None where there are too many to hold."""
    if factors.count() * k > HELD:
        return None
    rows = factors.orderBy("term").collect()
    return [r["term"] for r in rows], np.array([[r[c] for c in _cols(k)] for r in rows], np.float64).reshape(-1, k)


def packed(matrix: DataFrame, terms: list[str]) -> DataFrame:
    """``(row, e)``: each row of ``matrix(row, term, weight)`` with the numbers and weights of its terms."""
    numbers = matrix.sparkSession.createDataFrame(list(zip(terms, range(len(terms)))), "term string, i int")
    return matrix.join(F.broadcast(numbers), "term").groupBy("row").agg(F.collect_list(F.struct("i", "weight")).alias("e"))


def _runs(e: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """A batch's packed rows, about ``ENTRIES`` entries at a time: first and last row, where each row starts, terms and weights. No row is empty."""
    at = e.offsets.to_numpy()
    i, w = (e.values.field(n).to_numpy(zero_copy_only=False) for n in (0, 1))
    first = 0
    while first < len(e):
        last = max(first + 1, int(np.searchsorted(at, at[first] + ENTRIES, "right")) - 1)
        part = slice(at[first], at[last])
        yield first, last, at[first:last] - at[first], i[part], w[part]
        first = last


def _rows_times(v: np.ndarray, starts: np.ndarray, i: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.add.reduceat(v[i] * w[:, None], starts, axis=0)


def twice(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """The transposed matrix times the matrix (packed ``rows``) times ``v``."""
    k = v.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        total, seen = np.zeros(v.shape), np.zeros(len(v), bool)
        for batch in batches:
            for _, _, starts, i, w in _runs(batch.column(0)):
                u = _rows_times(v, starts, i, w)
                row = np.repeat(np.arange(len(starts)), np.diff([*starts, len(i)]))
                order = np.argsort(i, kind="stable")
                i = i[order]
                new = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
                total[i[new]] += np.add.reduceat(u[row[order]] * w[order][:, None], new, axis=0)
                seen[i] = True
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(total[at, j]) for j in range(k)]], names=["i", *_cols(k)])

    shares = rows.select("e").mapInArrow(run, ", ".join(["i int", *[f"{c} double" for c in _cols(k)]]))
    out = np.zeros(v.shape)
    for r in shares.groupBy("i").agg(*[F.sum(c).alias(c) for c in _cols(k)]).collect():
        out[r[0]] = r[1:]
    sent.unpersist()
    return out


def projected(rows: DataFrame, v: np.ndarray) -> DataFrame:
    """``(row, _v)``: the packed rows times ``v``."""
    k = v.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, starts, i, w in _runs(batch.column(1)):
                u = _rows_times(sent.value, starts, i, w)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * k, pa.int32()), pa.array(u.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], lists], names=["row", "_v"])

    return rows.select("row", "e").mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, _v array<double>")


def _noise(terms: DataFrame, k: int) -> DataFrame:
    """The factors to begin with."""
    return terms.select("term", *[(F.pmod(F.xxhash64("term", F.lit(j)), F.lit(2_000_003)) / F.lit(1_000_001.5) - 1).alias(c) for j, c in enumerate(_cols(k))])


def truncated_svd(matrix: DataFrame, k: int, iterations: int = 4) -> tuple[DataFrame, np.ndarray]:
    """``((term, v0, ...), singular values)`` of ``matrix(row, term, weight)``, largest first."""
    matrix = cut_lineage(matrix)
    v = cut_lineage(_noise(matrix.select("term").distinct(), k))
    small = held(v, k)
    if small is not None:
        return _held_svd(cut_lineage(packed(matrix, small[0])), *small, k, iterations)
    for _ in range(iterations):
        # Nearly orthonormal is enough between the steps, so the small matrix is applied as the factors are read.
        v = rotated(v, root_of(v, k), "term")
        v = cut_lineage(times(matrix, times(matrix, v, "term", "row", k), "row", "term", k))
    v = orthonormal(v, k, "term")
    size, q = np.linalg.eigh(products(times(matrix, v, "term", "row", k), k))
    order = np.argsort(-size)
    return cut_lineage(rotated(v, q[:, order], "term")), np.sqrt(np.maximum(size[order], 0.0))


def _held_svd(rows: DataFrame, terms: list[str], v: np.ndarray, k: int, iterations: int) -> tuple[DataFrame, np.ndarray]:
    """:func:`truncated_svd` of packed rows, with factors that fit an array."""
    for _ in range(iterations):
        v = twice(rows, v @ root_of(v, k))
    for _ in range(2):
        v = v @ root_of(v, k)
    g = v.T @ twice(rows, v)
    size, q = np.linalg.eigh((g + g.T) / 2)
    order = np.argsort(-size)
    v = v @ q[:, order]
    kinds = ", ".join(["term string", *[f"{c} double" for c in _cols(k)]])
    found = rows.sparkSession.createDataFrame([(t, *x) for t, x in zip(terms, v.tolist())], kinds)
    return cut_lineage(found), np.sqrt(np.maximum(size[order], 0.0))


@dataclass
class SvdEncoder:
    """One model for several text columns: each column of a row is a text of its own in the fit."""
    dim: int = 64
    max_features: int = 5000
    min_df: int = 5
    max_df: float = 0.9
    iterations: int = 4

    def fit(self, df: DataFrame, cols: list[str], key: str = "id") -> SvdModel:
        return self._fitted(df, cols, key)[0]

    def fit_transform(self, df: DataFrame, cols: list[str], key: str = "id", out: str = "vec") -> tuple[SvdModel, DataFrame]:
        """The model and the vectors of the rows that it is fitted on, whose terms are weighed once for both."""
        model, rows = self._fitted(df, cols, key)
        return model, model.transform(df, cols, key, out) if rows is None else model.ends_joined(df, cols, key, out, projected(rows, held(model.factors, self.dim)[1]))

    def _fitted(self, df: DataFrame, cols: list[str], key: str) -> tuple[SvdModel, DataFrame | None]:
        texts = _texts(df, cols, key)
        tfidf = TfIdf("text", max_features=self.max_features, ngram=(1, 1), min_df=self.min_df, max_df=self.max_df).fit(texts, key="row")
        matrix = tfidf.transform(texts, "row").select("row", "term", "weight")
        rows = None
        start = held(_noise(tfidf.vocabulary, self.dim), self.dim)
        if start is None:
            factors, sizes = truncated_svd(matrix, self.dim, self.iterations)
        else:
            rows = cut_lineage(packed(matrix, start[0]))
            factors, sizes = _held_svd(rows, *start, self.dim, self.iterations)
        return SvdModel(tfidf, factors, sizes, self.dim), rows


@dataclass
class SvdModel:
    tfidf: object
    factors: DataFrame  # (term, v0, v1, ...)
    sizes: np.ndarray
    dim: int

    def transform(self, df: DataFrame, cols: list[str], key: str = "id", out: str = "vec") -> DataFrame:
        """``(key, out)``: the projections of all columns put end to end, for every row of ``df``."""
        matrix = self.tfidf.transform(_texts(df, cols, key), "row").select("row", "term", "weight")
        small = held(self.factors, self.dim)
        if small is None:
            found = times(matrix, self.factors, "term", "row", self.dim).select("row", F.array(*_cols(self.dim)).alias("_v"))
        else:
            found = projected(packed(matrix, small[0]), small[1])
        return self.ends_joined(df, cols, key, out, found)

    def ends_joined(self, df: DataFrame, cols: list[str], key: str, out: str, found: DataFrame) -> DataFrame:
        """``(key, out)`` from the projections ``found(row, _v)`` of the columns."""
        kind = df.schema[key].dataType
        part = F.element_at(F.split("row", ":"), -1)
        named = found.select(F.expr("left(row, length(row) - instr(reverse(row), ':'))").cast(kind).alias(key), part.cast("int").alias("_c"), "_v")
        by = named.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_c", "_v"))).alias("_m"))  # one entry for each column
        zero = F.array_repeat(F.lit(0.0), self.dim)
        whole = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(len(cols) - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), zero)))
        return df.select(key).distinct().join(by, key, "left").select(key, F.coalesce(whole, F.array_repeat(F.lit(0.0), self.dim * len(cols))).alias(out))


def _texts(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """``(row, text)``: every column of every row; ``row`` is the key and the column's number."""
    fields = F.array(*[F.struct(F.lit(i).alias("c"), F.coalesce(F.col(c), F.lit("")).alias("text")) for i, c in enumerate(cols)])
    return df.select(F.col(key).cast("string").alias("_k"), F.inline(fields)).select(F.concat_ws(":", "_k", F.col("c").cast("string")).alias("row"), "text")
