"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame`` and, where SQL can
express the result, the DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import op3_bpe
from tessera.llm.covertree import OP8_SQL, op8_covertree
from tessera.llm.decontam import OP9_SQL, op9_decontam
from tessera.llm.importance import OP12_SQL, op12_importance
from tessera.llm.kneser_ney import op1_kneser_ney
from tessera.llm.langid import op5_langid
from tessera.llm.linededup import op2_linededup
from tessera.llm.pieces import op11_pieces
from tessera.llm.pii import op6_pii
from tessera.llm.simhash import op4_simhash
from tessera.llm.toxicity import op7_toxicity
from tessera.llm.trie import OP13_SQL, op13_trie
from tessera.llm.warc import OP10_SQL, op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": partial(op1_kneser_ney, order=3),
    "op2_linededup": op2_linededup,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_langid": op5_langid,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_covertree": op8_covertree,
    "op9_decontam": op9_decontam,
    "op10_warc": op10_warc,
    "op11_pieces": op11_pieces,
    "op12_importance": op12_importance,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {"op8_covertree": OP8_SQL, "op9_decontam": OP9_SQL, "op10_warc": OP10_SQL, "op12_importance": OP12_SQL,
                           "op13_trie": OP13_SQL}
