"""Vocabularies, token-id sequences, word-vector lookup and document vectors (#2, #21, #31, #35, #65-69).

Tokenizer rule (the sequence tokenizer of the reference's network jobs): lowercase, replace each filter
character by a space, split on spaces, drop empty pieces. Vocabulary rank: 1.. by corpus count descending,
ties by token (first-seen order is not defined on a distributed table).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.operators.ordering import co_locate, co_locate_texts, global_row_number

# The filter characters of the sequence tokenizer (replaced by a space before splitting).
SEQUENCE_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def seq_tokens(col) -> "F.Column":
    """Token array of a text under the sequence tokenizer rule."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), SEQUENCE_FILTERS, " " * len(SEQUENCE_FILTERS))
    return F.filter(F.split(t, " "), lambda x: x != "")


def token_counts(*frames_and_cols) -> DataFrame:
    """Corpus counts ``(token, count)`` over several (frame, column) pairs (e.g. train and test texts).
    Partial aggregation means a frequent token costs one row per task in the shuffle."""
    parts = [df.select(F.explode(seq_tokens(c)).alias("token")) for df, c in frames_and_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def token_vocab(*frames_and_cols) -> DataFrame:
    """``(token, count, rank)``: rank 1.. by count descending, then token, over the whole vocabulary."""
    return global_row_number(token_counts(*frames_and_cols), [F.desc("count"), F.asc("token")], out="rank")


def token_sequences(df: DataFrame, col: str, vocab: DataFrame, num_words: int | None = None,
                    key: str = "id") -> DataFrame:
    """``(key, seq)``: the ranks of the known tokens of each text, in text order. Tokens not in the vocabulary,
    and ranks ``>= num_words``, are skipped. A text without known tokens gives an empty array.

    Texts are co-located by key first, so the exploded tokens, the lookup and the ordered collection per
    text stay inside one partition (an outer explode keeps texts without tokens, no join back needed)."""
    docs = co_locate_texts(df.select(key, col), key, col)
    toks = docs.select(key, F.posexplode_outer(seq_tokens(col)).alias("pos", "token"))
    v = vocab.select("token", "rank")
    if num_words is not None:
        v = v.where(F.col("rank") < num_words)
    j = lookup_join(toks, v, "token", how="left", spread=key)
    hit = F.when(F.col("rank").isNotNull(), F.struct("pos", F.col("rank").cast("int").alias("rank")))
    seqs = j.groupBy(key).agg(F.array_sort(F.collect_list(hit)).alias("_s"))
    return seqs.select(key, F.transform("_s", lambda s: s["rank"]).alias("seq"))


def pad_sequences(df: DataFrame, col: str = "seq", maxlen: int = 300, out: str | None = None) -> DataFrame:
    """Fixed length ``maxlen``: keep the last ``maxlen`` ids (truncate at the front) and left-pad with 0."""
    s = F.col(col)
    n = F.size(s)
    kept = F.when(n > maxlen, F.slice(s, n - maxlen + 1, maxlen)).otherwise(s)
    padded = F.concat(F.array_repeat(F.lit(0), F.greatest(F.lit(maxlen) - F.size(kept), F.lit(0))), kept)
    return df.withColumn(out or col, padded)


def embedding_matrix(vocab: DataFrame, vectors: DataFrame, dim: int, num_words: int | None = None) -> DataFrame:
    """``(row, token, vec)``: row i holds the vector of the token ranked i; row 0 and tokens without a
    vector hold zeros. Rows 0 .. vocabulary size, or 0 .. ``num_words`` - 1 when that is given and smaller."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    if num_words is not None:
        vocab = vocab.where(F.col("rank") < num_words)
    v = vocab.select(F.col("rank").alias("row"), "token")
    j = lookup_join(v, vectors.select(F.col("word").alias("token"), "vec"), "token", how="left", spread="row")
    body = j.select("row", "token", F.coalesce(F.col("vec"), zeros).alias("vec"))
    row0 = vocab.limit(1).select(F.lit(0).cast("long").alias("row"), F.lit(None).cast("string").alias("token"),
                                 zeros.alias("vec"))
    return row0.unionByName(body)


def doc_vectors(seqs: DataFrame, vectors_by_rank: DataFrame, key: str = "id", seq_col: str = "seq",
                dim: int | None = None) -> DataFrame:
    """``(key, vec)``: mean of the token vectors of each sequence (tokens without a vector count as zeros;
    an empty sequence gives null). ``vectors_by_rank`` is ``(rank, vec)``; ``dim`` is read from it when not
    given.

    One aggregate per sequence: the ranks are exploded (an outer explode keeps empty sequences), looked up,
    and summed as ml vectors by a JVM aggregate (Summarizer), so dimensions are never exploded into rows. A
    rank without a vector contributes a zero vector (Summarizer takes no nulls). Sequences are co-located by
    key, so the token rows and their sums stay inside one partition.
    """
    if dim is None:
        dim = int(vectors_by_rank.select(F.size("vec")).first()[0])
    s = co_locate(seqs.select(key, seq_col), key)
    toks = s.select(key, F.size(seq_col).alias("_n"), F.explode_outer(seq_col).alias("rank"))
    vec = vectors_by_rank.select("rank", array_to_vector(F.col("vec")).alias("_v"))
    j = lookup_join(toks, vec, "rank", how="left", spread=key)
    zero = array_to_vector(F.array_repeat(F.lit(0.0), dim))
    sums = j.groupBy(key).agg(F.max("_n").alias("_n"),
                              Summarizer.sum(F.coalesce(F.col("_v"), zero)).alias("_sum"))
    total = vector_to_array(F.col("_sum"))
    mean = F.when(F.col("_n") > 0, F.transform(total, lambda x: x / F.col("_n")))
    return sums.select(key, mean.alias("vec"))


def text_vectors(df: DataFrame, col: str, matrix: DataFrame, dim: int, key: str = "id") -> DataFrame:
    """``(key, vec)`` as :func:`doc_vectors` of the texts' sequences, straight from the texts: tokens are looked up in the
    embedding ``matrix(token, vec)`` and summed as streams, without collecting a sequence in between. The
    partial sums leave one row for each text and task, so nothing larger is shuffled."""
    toks = df.select(key, F.explode_outer(seq_tokens(col)).alias("token"))
    known = matrix.where(F.col("token").isNotNull())
    # Most tokens of a large vocabulary have no vector: their zeros count, but only vectors that aren't zero are carried and summed.
    counts = lookup_join(toks, known.select("token", F.lit(1).alias("_in")), "token", how="left", spread=key).groupBy(key).agg(F.count("_in").alias("_n"))
    real = known.where(F.exists("vec", lambda x: x != 0)).select("token", "vec")
    # One sum a dimension: they stay in a hash table, where vectors as objects would be sorted with all token rows, and spilled.
    sums = lookup_join(toks, real, "token", spread=key).groupBy(F.col(key).alias("_own")).agg(*[F.sum(F.get("vec", F.lit(i)).cast("double")).alias(f"_s{i}") for i in range(dim)])
    sums = sums.select("_own", F.array(*[f"_s{i}" for i in range(dim)]).alias("_sum"))
    both = counts.join(sums, F.col(key).eqNullSafe(F.col("_own")), "left")
    total = F.coalesce(F.col("_sum"), F.array_repeat(F.lit(0.0), dim))
    mean = F.when(F.col("_n") > 0, F.transform(total, lambda x: x / F.col("_n")))
    return both.select(key, mean.alias("vec"))


# ------------------------------------------------------------------ word-vector text files (#2)

def parse_vector_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(word, vec array<float>)`` from lines ``word f1 f2 ...``. A leading ``count dim`` header line (two
    integer fields) is dropped instead of becoming a bogus one-dimensional entry."""
    parts = F.split(F.rtrim(F.col(col)), " ")
    header = (F.size(parts) == 2) & F.get(parts, 0).rlike(r"^\d+$") & F.get(parts, 1).rlike(r"^\d+$")
    return (lines.where(~header)
            .select(F.get(parts, 0).alias("word"),
                    F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("float")).alias("vec")))


def read_vectors(spark, path: str) -> DataFrame:
    """Word-vector text file(s) → ``(word, vec)``; read in parallel as plain text."""
    return parse_vector_lines(spark.read.text(path))


def format_vector_lines(df: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """Inverse of :func:`parse_vector_lines`: one ``value`` line per word."""
    return df.select(F.concat_ws(" ", F.col(word), F.array_join(F.transform(vec, lambda x: x.cast("string")), " "))
                     .alias("value"))


# ------------------------------------------------------------------ text embedding (#69)

def embed_text(df: DataFrame, cols, encoder=None, dim: int = 64, key: str = "id", out: str = "vec") -> DataFrame:
    """One vector per text column, concatenated per row (column order kept).

    ``encoder=None``: the native encoder, signed hashed term counts of the cleaned tokens: the first eight hex
    digits of a token's MD5 give its bucket (modulo ``dim``), the ninth its sign; l2-normalised per column.
    Otherwise ``encoder`` is a factory: called once in each worker, it returns a callable
    ``list[str] -> list[list[float]]`` (e.g. a local sentence encoder), run over Arrow batches.
    """
    if encoder is None:
        from tessera.functions.text import clean_tokens
        fields = F.array(*[F.struct(F.lit(i).alias("col"), clean_tokens(c).alias("tokens")) for i, c in enumerate(cols)])
        docs = co_locate(df.select(key, *cols), key).select(key, F.inline(fields))
        toks = docs.select(key, "col", F.explode_outer("tokens").alias("_t")).withColumn("_h", F.md5("_t"))
        slot = F.col("col") * dim + F.pmod(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")
        sign = F.when(F.substring("_h", 9, 1) < "8", 1.0).otherwise(-1.0)
        sums = toks.groupBy(key, "col", slot.alias("_s")).agg(F.sum(sign).alias("_v"))
        per_col = sums.groupBy(key, "col").agg(F.collect_list(F.when(F.col("_s").isNotNull(), F.struct("_s", "_v"))).alias("_e"),
                                               F.sqrt(F.sum(F.when(F.col("_s").isNotNull(), F.col("_v") * F.col("_v")))).alias("_l2"))
        scaled = F.transform("_e", lambda x: F.struct(x["_s"].alias("_s"), F.when(F.col("_l2") > 0, x["_v"] / F.col("_l2")).otherwise(0.0).alias("_v")))
        # At most ``dim`` entries per column: the collected lists are bounded by the vector they become. Zeros are set between the entries in order of
        # slot; a look-up of every slot in a map would go through all entries each time.
        rows = per_col.select(key, scaled.alias("_e")).groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("_e"))).alias("_e"))
        place = lambda i: F.coalesce(F.get("_e", i)["_s"], F.lit(-1))
        filled = F.transform("_e", lambda x, i: F.concat(F.array_repeat(F.lit(0.0), x["_s"] - place(i - 1) - 1), F.array(x["_v"])))
        dense = F.flatten(F.concat(filled, F.array(F.array_repeat(F.lit(0.0), dim * len(cols) - 1 - place(F.size("_e") - 1)))))
        return rows.select(key, dense.alias(out))
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<float>")
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for texts in batches:
            yield pd.Series([list(map(float, v)) for v in encode(texts.fillna("").tolist())])

    return df.select(key, F.concat(*[_enc(F.col(c)) for c in cols]).alias(out))
