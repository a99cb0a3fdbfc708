"""From raw documents to token ids: language ID, line dedup, near-duplicate removal, decontamination, BPE.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and returns a DataFrame, which is
written as Parquet and reread as the next one's ``docs``. All stages but the last return the columns of ``documents``.

* Documents without a recognisable language (no letter, null text) go.
* Of near-duplicate lines the first stays; a document that loses all its lines goes, and ``n_chars`` follows the text.
* Of documents whose fingerprints are linked, the one with the smallest id stays; rows that repeat an id stand or fall together, as
  do rows whose id is null.
* Contaminated documents go.
* The rest is encoded; the ids decode to the text, which the digests attest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tessera.llm import bpe, decontam, langid, linededup, simhash
from tessera.llm.common import table
from tessera.operators.joins import broadcastable
from tessera.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(docs).where("_dropped is null or size(_dropped) < _lines")
    return found.select(*[F.col("_clean").alias(c) if c == "text" else F.length("_clean").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs.select("doc_id", "text"), shingle=3, radius=2)
    gone = cut_lineage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
    side = F.broadcast(gone) if broadcastable(gone, 1_000_000, 64 << 20) else gone
    return docs.join(side, docs["doc_id"] == side["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe", encode)]

#: SQL has neither mixtures of languages nor XXH64 nor byte pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
