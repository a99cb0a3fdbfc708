"""Driver tables and the derived test views (see FIXTURES.md, part B).

Every view is a lazy DataFrame over the parquet tables, so its work grows with them.
Corpus tokens for ``word_vectors_v`` and ``lexicon_v`` are the cleaned tokens (runs of three or more
Unicode word characters, lowercased) of the seven essay text columns of ``essays_v``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# The seven text columns of a parent row, in the order the features are built.
TEXT_COLS = ["project_title", "project_essay_1", "project_essay_2", "project_essay_3",
             "project_essay_4", "project_resource_summary", "description"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def resources_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows: one line item with its part name and retail price."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("seq"),
                    F.col("p_name").alias("description"), F.col("l_quantity").alias("quantity"),
                    F.col("p_retailprice").alias("price")))


def projects_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent rows: orders with customer segment and nation as categoricals."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("teacher_id"),
                    F.col("c_mktsegment").alias("teacher_prefix"), F.col("n_name").alias("school_state"),
                    F.col("o_orderpriority").alias("project_grade_category"),
                    F.concat(F.col("c_mktsegment"), F.lit(", "), F.col("o_orderpriority"))
                    .alias("project_subject_categories"),
                    F.col("o_orderdate").alias("project_submitted_datetime"),
                    F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("project_is_approved")))


def essays_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text parents: line k of a document becomes text column k for the first six columns, and the last
    column (``description``) holds the rest of the document (lines 7 to the end, joined by newlines), so
    the seven columns together carry the whole text. A column past the end of a document is null. Label
    from ``labels.quality``."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("project_is_approved"))
    lines = F.split(F.col("text"), "\n")
    last = len(TEXT_COLS) - 1
    rest = F.when(F.size(lines) > last, F.array_join(F.slice(lines, last + 1, F.size(lines) - last), "\n"))
    return (d.join(lab, "doc_id", "left")
            .select(F.col("doc_id").alias("id"), "lang", "source", "n_chars", "project_is_approved",
                    *[F.get(lines, k).alias(c) for k, c in enumerate(TEXT_COLS[:last])],
                    rest.alias(TEXT_COLS[last])))


def scores_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deterministic model score tables over ``documents``, long form ``(model, id, score)``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    m1 = d.select(F.lit("m1").alias("model"), F.col("doc_id").alias("id"),
                  ((F.col("n_chars") % 1000) / F.lit(1000.0)).cast("double").alias("score"))
    m2 = d.select(F.lit("m2").alias("model"), F.col("doc_id").alias("id"),
                  (((F.col("doc_id") * 7919) % 1000) / F.lit(1000.0)).cast("double").alias("score"))
    m3 = d.select(F.lit("m3").alias("model"), F.col("doc_id").alias("id"),
                  (((F.col("doc_id") * 104729 + F.col("n_chars")) % 997) / F.lit(997.0)).cast("double")
                  .alias("score"))
    return m1.unionByName(m2).unionByName(m3)


def corpus_tokens(spark: SparkSession, sf_dir: str, by_key: bool = True) -> DataFrame:
    """``(id, field, pos, token)`` over the seven text columns of ``essays_v`` (cleaned tokens). Corpus-wide
    counts pass ``by_key=False`` (no co-location by id: they aggregate per token only)."""
    from tessera.operators.lexicon import tokens
    return tokens(essays_v(spark, sf_dir), TEXT_COLS, by_key=by_key)


def lexicon_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test lexicon: the distinct corpus tokens, but for some lengths (so that look-ups also miss), with a class and two
    scores derived from the length."""
    n = F.length("token")
    toks = corpus_tokens(spark, sf_dir, by_key=False).select("token").distinct().where(n % 7 != 6)
    # Written once, like the lexicon file it stands for: the size check and the join then read the table
    # instead of re-deriving it from the whole corpus.
    return cut_lineage(toks.select("token", (n % 8).alias("class"), ((n % 5 - 2) / F.lit(2.0)).alias("polarity"),
                                   ((n % 3) / F.lit(2.0)).alias("subjectivity")))


def tag_lexicon_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test lexicon for the tagger: the tokens of :func:`lexicon_v` with their class, those of even length with a second one."""
    base = lexicon_v(spark, sf_dir)
    n = F.length("token")
    every = F.when(n % 2 == 0, F.array("class", (n + 3) % 8)).otherwise(F.array("class"))
    return base.select("token", F.explode(every.cast("array<string>")).alias("class"))


def modifier_lexicon_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test lexicon with roles: of the tokens of :func:`lexicon_v`, those of length 3 negate, those of lengths 4 and 8 intensify or weaken."""
    base = lexicon_v(spark, sf_dir)
    n = F.length("token")
    return base.select("token", "polarity", "subjectivity", F.when(n == 4, 1.5).when(n == 8, 0.5).alias("intensity"), (n == 3).alias("negates"))


def word_vectors_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test word vectors ``(word, vec)``: corpus tokens ranked by count (desc) then token; the token of rank r
    takes ``embeddings.vec_id = r - 1`` (so only the most frequent tokens have a vector)."""
    from tessera.operators.ordering import global_row_number
    counts = corpus_tokens(spark, sf_dir, by_key=False).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    ranked = global_row_number(counts, [F.desc("count"), F.asc("token")], out="rank")
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # Written once, like the word-vector file it stands for.
    return cut_lineage(ranked.join(emb, ranked["rank"] - 1 == emb["vec_id"])
                       .select(F.col("token").alias("word"), F.col("embedding").alias("vec")))
