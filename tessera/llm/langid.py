"""Language identification by mixture inference.

A document is a mixture of languages: each of its byte trigrams (lower-cased, hashed into ``BINS`` bins) comes
from one language's trigram distribution, drawn with the document's proportions. Expectation-maximisation
finds the proportions for a set of languages; the set grows greedily from the best single language, by the
language that raises the likelihood most, as long as the rise exceeds a penalty for the added parameter.

The distributions are counted by Spark over all training documents: a task sums its documents per language and
bin, Spark adds those sums up. What reaches the driver and the workers is one count for each language and bin,
bounded by ``MAX_LANGS * BINS``; more languages raise an error rather than being dropped. Prediction is a
map over Arrow batches without a shuffle.

A text that is null or holds no letter is ``und`` with score 0. If nothing can be learned (an empty table, no
labels), every document is ``und``. Repeated rows get equal answers; ties between languages go to the first
in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import batch_of, id_remainder, packs, table

BINS = 1 << 16
MAX_LANGS = 400
UND = "und"
LETTER = regex.compile(r"\p{L}")
#: Other ASCII than letters counts as a space.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def bins(text: str) -> np.ndarray:
    """The bin of each byte trigram of a text, as uint16."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(PLAIN) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def trigram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, bin, n)`` over all rows with a text and a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for langs, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, t in zip(langs, texts):
                    if name not in sums:
                        sums[name] = np.zeros(BINS, np.int64)
                    if t:
                        found = bins(t)
                        if len(found) < 4096:
                            np.add.at(sums[name], found, 1)
                        else:
                            sums[name] += np.bincount(found, minlength=BINS)
        schema = pa.schema([("lang", pa.string()), ("bin", pa.int32()), ("n", pa.int64())])
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield batch_of(schema, [[name] * len(at), at, n[at]])

    some = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    parts = some.mapInArrow(run, "lang string, bin int, n long")
    return parts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


class Model:
    """Smoothed trigram distributions; ``predict`` works on a run of texts at once."""

    def __init__(self, langs: list[str], probs: np.ndarray, penalty: float, steps: int):
        self.langs, self.probs, self.penalty, self.steps = langs, probs, penalty, steps

    def fit_sets(self, p: np.ndarray, c: np.ndarray, start: np.ndarray, total: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for each document over its own set of languages. ``p``: (features, langs), ``c``: counts, ``start``:
        each document's first feature, ``member``: (documents, langs). Returns proportions and log-likelihoods."""
        size = np.diff(np.append(start, len(c)))
        share = member / member.sum(1, keepdims=True)
        for step in range(self.steps + 1):
            each = np.repeat(share, size, axis=0)
            each *= p
            mix = each.sum(1)
            if step == self.steps:
                return share, np.add.reduceat(c * np.log(mix), start)
            each *= (c / mix)[:, None]
            share = np.add.reduceat(each, start, axis=0) / total[:, None]

    def predict(self, texts: list[str]) -> list[tuple[str, float, dict[str, float]]]:
        out: list = [(UND, 0.0, {})] * len(texts)
        docs = [k for k, t in enumerate(texts) if self.langs and LETTER.search(t)]
        if not docs:
            return out
        codes, counts, sizes = [], [], []
        for k in docs:
            found = np.sort(bins(texts[k]), kind="stable")
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            codes.append(found[first])
            counts.append(np.diff(np.append(first, len(found))))
            sizes.append(len(first))
        p, c, size = self.probs[np.concatenate(codes)], np.concatenate(counts).astype(np.float64), np.array(sizes)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        total = np.add.reduceat(c, start)
        single = np.add.reduceat(c[:, None] * np.log(p), start, axis=0)
        best = single.argmax(1)
        rows = np.arange(len(docs))
        share = np.zeros(single.shape)
        share[rows, best] = 1
        like = single[rows, best]
        cost = self.penalty + np.log(total)
        live = rows
        for _ in range(len(self.langs) - 1):
            # Where the likelihood falls as a language enters, it has no maximum there: no need to fit that set.
            each = np.repeat(share[live], size[live], axis=0)
            at = np.concatenate([np.arange(start[d], start[d] + size[d]) for d in live])
            sub = np.concatenate([[0], np.cumsum(size[live])[:-1]])
            rise = np.add.reduceat((c[at] / (each * p[at]).sum(1))[:, None] * p[at], sub, axis=0) > total[live][:, None] * 1.001
            rise &= share[live] == 0
            top_like, top_share = like[live] + cost[live], share[live].copy()
            for lang in range(len(self.langs)):
                try_ = np.flatnonzero(rise[:, lang])
                if not len(try_):
                    continue
                d = live[try_]
                at = np.concatenate([np.arange(start[x], start[x] + size[x]) for x in d])
                sub = np.concatenate([[0], np.cumsum(size[d])[:-1]])
                member = (share[d] > 0).astype(np.float64)
                member[:, lang] = 1
                new_share, new_like = self.fit_sets(p[at], c[at], sub, total[d], member)
                win = new_like > top_like[try_]
                top_like[try_[win]], top_share[try_[win]] = new_like[win], new_share[win]
            grown = np.flatnonzero(top_like > like[live] + cost[live])
            if not len(grown):
                break
            like[live[grown]], share[live[grown]] = top_like[grown], top_share[grown]
            live = live[grown]
        top = share.argmax(1)
        for i, k in enumerate(docs):
            has = np.flatnonzero(share[i] > 0)
            out[k] = (self.langs[top[i]], min(1.0, float(share[i, top[i]])), {self.langs[x]: float(share[i, x]) for x in has})
        return out


def train(df: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5, penalty: float = 20.0, steps: int = 12) -> Model:
    """Count all rows of ``df`` and smooth. ``penalty``: the least rise in log-likelihood, beside log(trigrams),
    that a further language must bring."""
    rows = trigram_counts(df, text, lang).limit(MAX_LANGS * BINS + 1).toPandas()
    langs = sorted(rows["lang"].unique())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} languages")
    n = np.full((BINS, max(1, len(langs))), smoothing)
    if len(rows):
        np.add.at(n, (rows["bin"].to_numpy(), np.searchsorted(langs, rows["lang"].to_numpy().astype(str))), rows["n"].to_numpy())
    return Model(langs, n / n.sum(0), penalty, steps)


def identify(df: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, lang_pred, score, mixture map<string,double>)`` for every row."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded: see train

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("lang_pred", pa.string()), ("score", pa.float64()),
                                ("mixture", pa.map_(pa.string(), pa.float64()))])
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 1_000_000):
                got = sent.value.predict(texts)
                yield batch_of(schema, [keys, [g[0] for g in got], [g[1] for g in got], [list(g[2].items()) for g in got]])

    kinds = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
             T.StructField("score", T.DoubleType()), T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType()))]
    return df.select(F.col(id_col), F.col(text)).mapInArrow(run, T.StructType(kinds))


def accepted(df: DataFrame, model: Model, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``df``, with all their columns, whose language is known with a score of at least ``least``."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            for _, texts in packs([None] * batch.num_rows, batch.column(at).to_pylist(), 1_000_000):
                keep += [name != UND and score >= least for name, score, _ in sent.value.predict(texts)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def op5_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents of the other three quarters."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(id_remainder(F.col("doc_id"), 4) != 2))
    return identify(docs, model).select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "mixture")
