"""

Every query reads the driver tables (or views Spark derives from them) in full. Computed doubles are
rounded to 6 places so the DuckDB oracle compares exact values.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import rollup
from tessera.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c):
    return F.round(F.col(c), 6).alias(c)


# ---------------------------------------------------------------- rollup (#8, 19-20, 24-26)

@query("line_total")
def q_line_total(spark, sf):
    df = rollup.line_total(T.resources_v(spark, sf))
    return df.select("id", "seq", "description", r6("total_price"))


@query("resource_rollup")
def q_resource_rollup(spark, sf):
    r = rollup.resource_rollup(T.resources_v(spark, sf))
    return r.select("id", "description", "total_price", "max_price", "min_price", r6("mean_price"), "quantity")


@query("resource_rollup_split")
def q_resource_rollup_split(spark, sf):
    """The rollup with its descriptions joined in two levels, so that no task sorts a whole parent."""
    r = rollup.resource_rollup(T.resources_v(spark, sf), split=True)
    return r.select("id", "description", "total_price", "max_price", "min_price", r6("mean_price"), "quantity")


@query("project_enrich")
def q_project_enrich(spark, sf):
    p = T.projects_v(spark, sf)
    df = rollup.project_enrich(p, rollup.resource_rollup(T.resources_v(spark, sf)))
    return df.select("id", "teacher_prefix", "school_state", "project_grade_category",
                     "project_subject_categories", "project_is_approved", "description", "total_price",
                     r6("mean_price"), "quantity")


# ---------------------------------------------------------------- scalars (#6, 9-15, 17-18, 44-50, 62)

from tessera.config import Flags, feature_set  # noqa: E402
from tessera.functions import calendar as cal  # noqa: E402
from tessera.functions import nulls  # noqa: E402
from tessera.functions import text as tx  # noqa: E402
from tessera.operators import assemble  # noqa: E402

ESSAYS = ["project_essay_1", "project_essay_2", "project_essay_3", "project_essay_4"]


@query("calendar_labels")
def q_calendar_labels(spark, sf):
    p = T.projects_v(spark, sf).select("id", "project_submitted_datetime")
    return cal.calendar_labels(p, "project_submitted_datetime", drop=True)


@query("clean_text")
def q_clean_text(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", *[tx.clean_text(c).alias(c) for c in T.TEXT_COLS])


def cleaned_essays(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", "project_is_approved", *[tx.clean_text(c).alias(c) for c in T.TEXT_COLS])


@query("concat_text")
def q_concat_text(spark, sf):
    e = cleaned_essays(spark, sf).withColumn("all_essays", tx.concat_text(ESSAYS))
    return e.select("id", "all_essays", tx.concat_text(["project_title", "all_essays", "project_resource_summary",
                                                        "description"]).alias("all_text"))


@query("concat_raw")
def q_concat_raw(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", tx.concat_raw(["lang", "source", "project_title", "project_resource_summary",
                                         *ESSAYS]).alias("project_desc"))


@query("sentence_count")
def q_sentence_count(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", *[tx.sentence_count(c).alias(f"{c}_sent_len") for c in ESSAYS])


@query("word_count")
def q_word_count(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", *[tx.word_count(c).alias(f"{c}_word_len") for c in ESSAYS])


@query("null_fill")
def q_null_fill(spark, sf):
    e = T.essays_v(spark, sf).select("id", *T.TEXT_COLS)
    return nulls.null_fill(e, {c: "" for c in T.TEXT_COLS})


@query("null_literal")
def q_null_literal(spark, sf):
    e = T.essays_v(spark, sf).select("id", "project_essay_3", "description")
    return nulls.null_literal(e, ["project_essay_3", "description"])


@query("numeric_coerce")
def q_numeric_coerce(spark, sf):
    e = T.essays_v(spark, sf).select("id", "n_chars", F.col("project_title").alias("title_num"))
    e = nulls.numeric_coerce(e, ["n_chars"], strict=True)
    return nulls.numeric_coerce(e, ["title_num"], strict=False)


@query("split_by_presence")
def q_split_by_presence(spark, sf):
    e = T.essays_v(spark, sf).select("id", "project_is_approved", "project_essay_3")
    present, absent = assemble.split_by_presence(e, "project_essay_3")
    return (present.select("id", "project_is_approved", F.lit("present").alias("part"))
            .unionByName(absent.select("id", "project_is_approved", F.lit("absent").alias("part"))))


@query("feature_select")
def q_feature_select(spark, sf):
    p = cal.calendar_labels(T.projects_v(spark, sf), "project_submitted_datetime", drop=True)
    df = rollup.project_enrich(p.drop("teacher_id"), rollup.resource_rollup(T.resources_v(spark, sf)))
    df = nulls.null_fill(df, {"teacher_prefix": "Teacher"})
    fs = feature_set(Flags(max_price=True))
    return assemble.feature_select(df, fs, target="project_is_approved")


@query("nan_safe_sigmoid")
def q_nan_safe_sigmoid(spark, sf):
    s = T.scores_v(spark, sf).withColumn("margin", (F.col("score") - 0.5) * 10.0)
    s = nulls.nan_safe_sigmoid(s, "margin", out="prob")
    return s.select("model", "id", r6("prob"))


@query("strip_accents")
def q_strip_accents(spark, sf):
    d = T.table(spark, sf, "documents")
    return d.select("doc_id", tx.strip_accents("text").alias("text"))


@query("path_label")
def q_path_label(spark, sf):
    p = T.table(spark, sf, "pages")
    return p.select("page_id", tx.url_first_segment("url").alias("label"))


TEXT_FEATURES = ["id", *[f"{c}_sent_len" for c in ESSAYS], *[f"{c}_word_len" for c in ESSAYS], *T.TEXT_COLS,
                 "all_essays", "all_text",
                 *[f"{a}_{b}_common" for i, a in enumerate(T.TEXT_COLS[:-1]) for b in T.TEXT_COLS[i + 1:]],
                 "polarity", "subjectivity"]


@query("text_features")
def q_text_features(spark, sf):
    """The text stage of the preprocessing plan end to end (raw counts before cleaning, cleaning,
    concatenation, pairwise overlaps, lexicon scores), one row per document."""
    from tessera.plans.preprocess import text_features
    return text_features(T.essays_v(spark, sf), T.lexicon_v(spark, sf)).select(*TEXT_FEATURES)


# ---------------------------------------------------------------- token relations (#43, 51-53)

from tessera.operators import lexicon as lx  # noqa: E402


@query("keyword_counts")
def q_keyword_counts(spark, sf):
    e = T.essays_v(spark, sf)
    return lx.keyword_counts(e, T.TEXT_COLS, lx.REFERENCE_KEYWORDS + lx.TEST_CORPUS_KEYWORDS)


@query("keyword_matrix")
def q_keyword_matrix(spark, sf):
    e = T.essays_v(spark, sf)
    return lx.keyword_matrix(e, T.TEXT_COLS, lx.REFERENCE_KEYWORDS + lx.TEST_CORPUS_KEYWORDS)


@query("token_class_counts")
def q_token_class_counts(spark, sf):
    return lx.token_class_counts(T.corpus_tokens(spark, sf), T.lexicon_v(spark, sf))


@query("token_class_matrix")
def q_token_class_matrix(spark, sf):
    e = T.essays_v(spark, sf)
    return lx.token_class_matrix(e, T.TEXT_COLS, T.lexicon_v(spark, sf), [str(k) for k in range(8)])


def tagged_essays(spark, sf):
    """The essay texts, and their sentences with the tags of a model learned on all of them."""
    from tessera.operators import tagger
    e = T.essays_v(spark, sf)
    classes = [str(k) for k in range(8)]
    sents = cut_lineage(tagger.sentences(e, T.TEXT_COLS, T.tag_lexicon_v(spark, sf), classes))
    return e, tagger.tag(sents, tagger.fit(sents, classes)), classes


@query("tag_counts")
def q_tag_counts(spark, sf):
    from tessera.operators import tagger
    return tagger.tag_counts(tagged_essays(spark, sf)[1])


@query("tag_matrix")
def q_tag_matrix(spark, sf):
    from tessera.operators import tagger
    e, tagged, classes = tagged_essays(spark, sf)
    return tagger.tag_matrix(e, tagged, T.TEXT_COLS, classes)


@query("tag_counts_check")
def q_tag_counts_check(spark, sf):
    """For each text and field: its tokens, those that the lexicon knows, and those whose tag the lexicon doesn't allow."""
    _, tagged, _ = tagged_essays(spark, sf)
    n = F.length("token")
    second = F.when(n % 2 == 0, (n + 3) % 8).otherwise(n % 8)
    one = tagged.select("id", "field", F.explode(F.arrays_zip("toks", "tags")).alias("x")).select("id", "field", F.col("x.toks").alias("token"), F.col("x.tags").cast("int").alias("tag"))
    listed = n % 7 != 6
    return one.groupBy("id", "field").agg(F.count(F.lit(1)).alias("n_tokens"), F.count(F.when(listed, 1)).alias("n_listed"),
                                          F.count(F.when(listed & (F.col("tag") != n % 8) & (F.col("tag") != second), 1)).alias("n_wrong"))


@query("abbreviations")
def q_abbreviations(spark, sf):
    """Every type that has ever had a full stop, and how much its occurrences speak for an abbreviation."""
    from tessera.operators import sentences as st
    seen = st.observations(T.essays_v(spark, sf), T.TEXT_COLS)
    return st.abbreviation_scores(seen).select("typ", "n_stop", "n_plain", r6("score"))


@query("sentence_breaks")
def q_sentence_breaks(spark, sf):
    """Sentences of each text, by boundaries learned from all texts."""
    from tessera.operators import sentences as st
    e = T.essays_v(spark, sf)
    return st.sentence_counts(e, T.TEXT_COLS, st.learn(st.observations(e, T.TEXT_COLS)))


@query("treebank_count")
def q_treebank_count(spark, sf):
    """Treebank tokens of each text, sentence by learned sentence."""
    from tessera.operators import sentences as st
    e = T.essays_v(spark, sf)
    return st.treebank_counts(e, T.TEXT_COLS, st.learn(st.observations(e, T.TEXT_COLS)))


@query("modified_score")
def q_modified_score(spark, sf):
    """Polarity and subjectivity of the essays under negation and intensifiers."""
    from tessera.operators import modifiers
    return modifiers.modified_score(T.essays_v(spark, sf), ESSAYS, T.modifier_lexicon_v(spark, sf))


@query("lexicon_score")
def q_lexicon_score(spark, sf):
    return lx.lexicon_score(T.essays_v(spark, sf), ESSAYS, T.lexicon_v(spark, sf))


@query("pairwise_overlap")
def q_pairwise_overlap(spark, sf):
    return lx.pairwise_overlap(cleaned_essays(spark, sf), T.TEXT_COLS)


# ---------------------------------------------------------------- encoders (#27-29, 56-60)

from tessera.operators import encoders as enc  # noqa: E402

PROJECT_CATS = ["teacher_prefix", "school_state", "project_grade_category", "project_subject_categories",
                "dayofweek", "monthofyear"]
ROLLUP_CONT = ["total_price", "quantity", "mean_price"]


def labelled_projects(spark, sf):
    return cal.calendar_labels(T.projects_v(spark, sf), "project_submitted_datetime", drop=True)


def enriched(spark, sf):
    return rollup.project_enrich(T.projects_v(spark, sf), rollup.resource_rollup(T.resources_v(spark, sf)))


@query("category_index")
def q_category_index(spark, sf):
    return enc.category_index(labelled_projects(spark, sf), PROJECT_CATS)


@query("one_hot")
def q_one_hot(spark, sf):
    p = labelled_projects(spark, sf)
    return enc.OneHot(PROJECT_CATS).fit(p).transform(p)


@query("multi_hot")
def q_multi_hot(spark, sf):
    p = T.projects_v(spark, sf)
    cols = ["project_subject_categories", "teacher_prefix"]
    return enc.MultiHot(cols).fit(p).transform(p)


@query("target_encode")
def q_target_encode(spark, sf):
    e = T.essays_v(spark, sf)
    train = e.where(F.col("project_is_approved").isNotNull())
    model = enc.TargetEncode(["lang", "source"], "project_is_approved").fit(train)
    return model.transform(e).select("id", "feature", r6("encoded"))


@query("minmax_fit")
def q_minmax_fit(spark, sf):
    return enc.minmax_bounds(enriched(spark, sf), ["total_price", "max_price", "min_price", "mean_price",
                                                   "quantity"])


def essay_numeric(spark, sf):
    e = T.essays_v(spark, sf)
    return e.select("id", "project_is_approved", F.col("n_chars").cast("double").alias("n_chars"),
                    *[tx.word_count(c).cast("double").alias(f"{c}_word_len") for c in ESSAYS])


ESSAY_NUM = ["n_chars"] + [f"{c}_word_len" for c in ESSAYS]


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    df = essay_numeric(spark, sf)
    model = enc.MinMax(ESSAY_NUM).fit(df.where(F.col("project_is_approved").isNotNull()))
    return model.transform(df).select("id", *[r6(c) for c in ESSAY_NUM])


@query("poly2")
def q_poly2(spark, sf):
    df = enriched(spark, sf).select("id", *ROLLUP_CONT)
    scaled = enc.MinMax(ROLLUP_CONT).fit(df).transform(df)
    p = enc.Poly2(ROLLUP_CONT).transform(scaled)
    return p.select("id", F.posexplode("poly").alias("slot", "value")).select("id", "slot", r6("value"))


# ---------------------------------------------------------------- vocabularies and text models (#2-3, 21, 30-31, 35-36, 61-69)

from tessera.operators import tfidf as tf  # noqa: E402
from tessera.operators import vocab as vc  # noqa: E402
from tessera.session import cut_lineage  # noqa: E402


def all_text(spark, sf):
    e = cleaned_essays(spark, sf).withColumn("all_essays", tx.concat_text(ESSAYS))
    return e.select("id", "project_is_approved", tx.concat_text(
        ["project_title", "all_essays", "project_resource_summary", "description"]).alias("all_text"))


def vec_text(c):
    return F.array_join(F.transform(c, lambda x: F.format_string("%.6f", x.cast("double"))), " ")


@query("token_vocab")
def q_token_vocab(spark, sf):
    return vc.token_vocab((all_text(spark, sf), "all_text"))


def corpus(spark, sf):
    """The cleaned texts and their ranked vocabulary, each written once: the text is cleaned in one pass."""
    docs = cut_lineage(all_text(spark, sf))
    return docs, cut_lineage(vc.token_vocab((docs, "all_text")))


def sequences(spark, sf, num_words=None):
    docs, voc = corpus(spark, sf)
    return vc.token_sequences(docs, "all_text", voc, num_words=num_words), voc


@query("token_sequences")
def q_token_sequences(spark, sf):
    s, _ = sequences(spark, sf)
    return s.select("id", F.array_join("seq", " ").alias("seq"))


@query("pad_sequences")
def q_pad_sequences(spark, sf):
    s, _ = sequences(spark, sf)
    return vc.pad_sequences(s, "seq", maxlen=300).select("id", F.array_join("seq", " ").alias("seq"))


@query("embedding_matrix")
def q_embedding_matrix(spark, sf):
    voc = vc.token_vocab((all_text(spark, sf), "all_text"))
    m = vc.embedding_matrix(voc, T.word_vectors_v(spark, sf), dim=64)
    return m.select("row", "token", vec_text(F.col("vec")).alias("vec"))


@query("doc_vectors")
def q_doc_vectors(spark, sf):
    docs, voc = corpus(spark, sf)
    m = cut_lineage(vc.embedding_matrix(voc, T.word_vectors_v(spark, sf), dim=64))
    dv = vc.text_vectors(docs, "all_text", m, dim=64)
    return dv.select("id", F.posexplode("vec").alias("dim", "value")).select("id", "dim", r6("value"))


@query("vec_text_scan")
def q_vec_text_scan(spark, sf):
    lines = vc.format_vector_lines(T.word_vectors_v(spark, sf))
    parsed = vc.parse_vector_lines(lines)
    return parsed.select("word", vec_text(F.col("vec")).alias("vec"))


@query("embedding_scan")
def q_embedding_scan(spark, sf):
    e = T.table(spark, sf, "embeddings")
    return e.select("vec_id", "label", vec_text(F.col("embedding")).alias("vec"))


@query("embedding_store")
def q_embedding_store(spark, sf):
    """Store the embeddings as ``(key, vector)`` in the shared scratch folder and load them again (#3-4)."""
    from tessera.session import scratch_dir
    from tessera.sources import files
    path = scratch_dir(spark, "embeddings")
    files.write_embeddings(T.table(spark, sf, "embeddings"), path, key="vec_id", vec="embedding")
    return files.read_embeddings(spark, path).select("vec_id", vec_text(F.col("embedding")).alias("vec"))


@query("stopword_ngrams")
def q_stopword_ngrams(spark, sf):
    return tf.stopword_ngrams(all_text(spark, sf), "all_text", 1, 2)


@query("term_stats")
def q_term_stats(spark, sf):
    return tf.term_stats(tf.stopword_ngrams(all_text(spark, sf), "all_text", 1, 2))


@query("top_terms")
def q_top_terms(spark, sf):
    docs = all_text(spark, sf)
    n = docs.count()
    st = tf.term_stats(tf.stopword_ngrams(docs, "all_text", 1, 3))
    st = st.where((F.col("df") >= 5) & (F.col("df") <= 0.9 * n))
    return tf.top_terms(st, 400)


@query("tfidf")
def q_tfidf(spark, sf):
    docs = all_text(spark, sf)
    train = docs.where(F.col("project_is_approved").isNotNull())
    model = tf.TfIdf("all_text", max_features=10000, ngram=(1, 3), min_df=5, max_df=0.9).fit(train)
    return model.transform(docs).select("id", "term", r6("weight"))


TEXT_LIMITS = {"project_title": 400, "all_essays": 5000, "project_resource_summary": 400}


def text_columns(spark, sf):
    """The labelled and the other essays with their three TF-IDF columns."""
    e = cleaned_essays(spark, sf).withColumn("all_essays", tx.concat_text(ESSAYS))
    return e.select("id", "project_is_approved", *TEXT_LIMITS)


def text_models():
    return [tf.TfIdf(c, max_features=n, ngram=(1, 3), min_df=5, max_df=0.9) for c, n in TEXT_LIMITS.items()]


@query("tfidf_columns")
def q_tfidf_columns(spark, sf):
    """TF-IDF of each column under limits of its own, fitted on the rows to train on and those to score."""
    e = text_columns(spark, sf)
    known = F.col("project_is_approved").isNotNull()
    parts = [t.fit(e.where(known), e.where(~known)).transform(e).select("id", F.lit(t.col).alias("column"), "term", r6("weight")) for t in text_models()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("embed_text")
def q_embed_text(spark, sf):
    v = vc.embed_text(T.essays_v(spark, sf), T.TEXT_COLS, dim=64)
    return v.select("id", F.posexplode("vec").alias("slot", "value")).where("value <> 0").select("id", "slot", r6("value"))


def svd_encoder(spark, sf):
    """An encoder learned from all text columns of the essays, and their vectors."""
    from tessera.operators.svd import SvdEncoder
    return SvdEncoder(dim=64).fit_transform(T.essays_v(spark, sf).select("id", *T.TEXT_COLS), T.TEXT_COLS)


@query("embed_text_svd")
def q_embed_text_svd(spark, sf):
    """The seven text columns through the learned encoder (#69)."""
    _, vectors = svd_encoder(spark, sf)
    return vectors.select("id", F.transform("vec", lambda x: F.round(x, 6)).alias("vec"))


@query("embed_text_svd_check")
def q_embed_text_svd_check(spark, sf):
    """Every essay has a vector of seven blocks, each no longer than the unit vector that it projects (id -1: the factors are orthonormal)."""
    from tessera.operators.svd import products
    model, vectors = svd_encoder(spark, sf)
    block = lambda i: F.aggregate(F.slice("vec", i * 64 + 1, F.lit(64)), F.lit(0.0), lambda a, x: a + x * x) <= 1 + 1e-9
    ok = (F.size("vec") == 64 * 7) & F.forall(F.sequence(F.lit(0), F.lit(6)), block)
    g = products(model.factors, 64)
    sound = bool(abs(g - np.eye(64)).max() < 1e-8 and (np.diff(model.sizes) <= 1e-9).all())
    one = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(sound).alias("ok"))
    return vectors.select("id", ok.alias("ok")).unionByName(one)


# ---------------------------------------------------------------- splits, metric, union, ensembles (#22-23, 32-33, 37-42, 77, 80-83)

from tessera.operators import ensemble as ens  # noqa: E402
from tessera.operators import metrics as mt  # noqa: E402
from tessera.operators import splits as sp  # noqa: E402

LEADERBOARD = {"m1": 0.76208, "m2": 0.80257, "m3": 0.81640}


@query("quick_sample")
def q_quick_sample(spark, sf):
    p = T.projects_v(spark, sf).select("id", "teacher_prefix", "school_state")
    return sp.quick_sample(p, 4000)


@query("kfold_contiguous")
def q_kfold_contiguous(spark, sf):
    return sp.kfold(T.projects_v(spark, sf).select("id"), k=5, method="contiguous")


@query("kfold_hash")
def q_kfold_hash(spark, sf):
    return sp.kfold(T.projects_v(spark, sf).select("id"), k=5, method="hash", seed=0, repeats=1)


@query("hash_split")
def q_hash_split(spark, sf):
    a, b = sp.hash_split(T.projects_v(spark, sf).select("id"), 0.8, seed=233)
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("valid")))


@query("union_by_name")
def q_union_by_name(spark, sf):
    e = T.essays_v(spark, sf)
    train = e.where(F.col("project_is_approved").isNotNull()).select("id", "project_is_approved", "lang")
    test = e.where(F.col("project_is_approved").isNull()).select("id", "source")
    return sp.union_by_name(train, test)


@query("sorted_scores")
def q_sorted_scores(spark, sf):
    return T.scores_v(spark, sf).orderBy("model", "id").select("model", "id", r6("score"))


def labelled_scores(spark, sf):
    lab = T.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return T.scores_v(spark, sf).join(lab, "id")


@query("binned_auc")
def q_binned_auc(spark, sf):
    return mt.binned_auc(labelled_scores(spark, sf), "label", "score", bins=1000, group="model") \
        .select("model", r6("auc"))


@query("fold_mean")
def q_fold_mean(spark, sf):
    s = T.scores_v(spark, sf).withColumnRenamed("model", "fold")
    return ens.fold_mean(s).select("id", r6("score"))


def model_tables(spark, sf):
    s = T.scores_v(spark, sf)
    return {m: s.where(F.col("model") == m).select("id", F.col("score").alias("project_is_approved"))
            for m in ("m1", "m2", "m3")}


@query("scores_long")
def q_scores_long(spark, sf):
    return ens.scores_long(model_tables(spark, sf)).select("model", "id", r6("score"))


@query("ensemble_mean")
def q_ensemble_mean(spark, sf):
    return ens.ensemble_mean(ens.scores_long(model_tables(spark, sf))).select("id", r6("score"))


@query("ensemble_weighted")
def q_ensemble_weighted(spark, sf):
    w = ens.power_weights(spark, LEADERBOARD, 75)
    return ens.ensemble_weighted(ens.scores_long(model_tables(spark, sf)), w).select("id", r6("score"))


@query("score_minmax")
def q_score_minmax(spark, sf):
    return ens.score_minmax(T.scores_v(spark, sf)).select("model", "id", r6("score"))


@query("fill_template")
def q_fill_template(spark, sf):
    e = T.essays_v(spark, sf)
    template = e.where(F.col("project_is_approved").isNull()).select(
        "id", F.lit(0.5).alias("project_is_approved"))
    w = ens.power_weights(spark, LEADERBOARD, 75)
    blend = ens.ensemble_weighted(ens.scores_long(model_tables(spark, sf)), w)
    return ens.fill_template(template, blend).select("id", r6("project_is_approved"))


CLASSES = [f"class_{i}" for i in range(10)]


@query("wide_probs")
def q_wide_probs(spark, sf):
    """Ten class probabilities per stored embedding row: the logit of class i sums the dimensions j with
    j mod 10 = i (every dimension contributes), softmax, then one column per class."""
    e = T.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    logit = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.aggregate(
        F.filter(F.col("v"), lambda x, j: j % 10 == i), F.lit(0.0), lambda acc, x: acc + x))
    ex = e.select("vec_id", F.transform(logit, lambda x: F.exp(x)).alias("ex"))
    tot = ex.select("vec_id", "ex", F.aggregate("ex", F.lit(0.0), lambda a, x: a + x).alias("t"))
    probs = tot.select("vec_id", F.transform("ex", lambda x: x / F.col("t")).alias("probs"))
    wide = ens.wide_from_array(probs, CLASSES, key="vec_id")
    return wide.select("vec_id", *[r6(c) for c in CLASSES])


@query("assemble_blocks")
def q_assemble_blocks(spark, sf):
    num = essay_numeric(spark, sf)
    lex = lx.lexicon_score(T.essays_v(spark, sf), ESSAYS, T.lexicon_v(spark, sf))
    df, names = assemble.assemble_blocks("id", [(num, ESSAY_NUM), (lex, ["polarity", "subjectivity"])])
    return df.select("id", F.posexplode("features").alias("slot", "value")).select("id", "slot", r6("value"))


from tessera.operators.pipeline import FeaturePipeline  # noqa: E402


def feature_frame(spark, sf):
    """Cleaned text, categories and numbers of every essay, written once: fits and transforms read it many times."""
    e = T.essays_v(spark, sf).select("id", "lang", "source", F.concat_ws(", ", "lang", "source").alias("tags"), "project_essay_3")
    return cut_lineage(text_columns(spark, sf).join(e, "id").join(essay_numeric(spark, sf).drop("project_is_approved"), "id"))


def feature_pipeline():
    return FeaturePipeline(text=text_models(), one_hot=("lang", "source"), target=("lang", "source"), multi_hot=("tags",),
                           continuous=tuple(ESSAY_NUM), poly=True, label="project_is_approved")


@query("feature_matrix")
def q_feature_matrix(spark, sf):
    """Text, categorical and continuous features of every essay in one slot space."""
    df = feature_frame(spark, sf)
    known = F.col("project_is_approved").isNotNull()
    model = feature_pipeline().fit(df.where(known), df.where(~known))
    return model.transform(df).select("id", "slot", r6("value"))


# ---------------------------------------------------------------- models (#71-78, 84)

from tessera.operators import models as md  # noqa: E402

LABEL = "project_is_approved"


def model_frames(spark, sf):
    """Labelled essays to train on and the others to score, as sparse vectors over text, categories and numbers."""
    df = feature_frame(spark, sf)
    return encoded(df.where(f"{LABEL} is not null"), df.where(f"{LABEL} is null"))


def encoded(train, test, present: bool = True):
    """Both frames through a pipeline of their own; without the column that splits them when that is absent."""
    model = feature_pipeline().fit(train, test)
    return model.vectors(train, (LABEL,)), model.vectors(test, (LABEL,))


def essay_labels(spark, sf):
    return T.essays_v(spark, sf).where(F.col(LABEL).isNotNull()).select("id", F.col(LABEL).alias("label"))


def stack_parts(spark, sf):
    s = T.scores_v(spark, sf)
    lab = T.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return s.join(lab.select("id"), "id"), lab, s.join(lab.select("id"), "id", "left_anti")


@query("rf_score")
def q_rf_score(spark, sf):
    return md.rf_score(*model_frames(spark, sf), "features", LABEL)


@query("gbt_score")
def q_gbt_score(spark, sf):
    return md.gbt_score(*model_frames(spark, sf), "features", LABEL)


@query("gbt_kfold_score")
def q_gbt_kfold_score(spark, sf):
    return md.gbt_kfold_score(*model_frames(spark, sf), "features", LABEL, k=5)


@query("linear_score")
def q_linear_score(spark, sf):
    return md.linear_score(*model_frames(spark, sf), "features", LABEL)


@query("mlp_score")
def q_mlp_score(spark, sf):
    return md.mlp_score(*model_frames(spark, sf), "features", LABEL)


def two_blocks(spark, sf):
    """The embeddings as they are, and their second halves' squares as another block."""
    e = T.table(spark, sf, "embeddings")
    return e.withColumn("squares", F.transform(F.slice("embedding", 33, 32), lambda x: x * x))


@query("softmax_score")
def q_softmax_score(spark, sf):
    s = md.softmax_score(two_blocks(spark, sf), ["embedding", "squares"], "label", key="vec_id")
    return s.select("set", "id", F.array_position("probs", F.array_max("probs")).alias("pred_class"),
                    F.array_max("probs").alias("max_prob"))


@query("split_train_merge")
def q_split_train_merge(spark, sf):
    df = feature_frame(spark, sf)
    return md.split_train_merge(df.where(f"{LABEL} is not null"), df.where(f"{LABEL} is null"), "project_essay_3", md.linear_score, prepare=encoded, features="features", label=LABEL)


@query("ensemble_stack")
def q_ensemble_stack(spark, sf):
    return md.ensemble_stack(*stack_parts(spark, sf), ["m1", "m2", "m3"])


def checked(name: str, labelled: bool = True):
    """A query that says of each score of a job whether it is a probability, and whether the training rows are ranked."""
    @query(f"{name}_check")
    def q(spark, sf):
        return md.score_checks(QUERIES[name](spark, sf), essay_labels(spark, sf) if labelled else None)


for _job in ("linear_score", "gbt_score", "mlp_score"):
    checked(_job)


@query("gbt_kfold_score_check")
def q_gbt_kfold_score_check(spark, sf):
    """The k-fold job, whose ranking is judged on scores of the model that each row was left out of."""
    return md.score_checks(md.gbt_kfold_score(*model_frames(spark, sf), "features", LABEL, out_of_fold=True), essay_labels(spark, sf))


def held_out(spark, sf):
    """Features of the labelled essays but every fourth id, and of all the others; the labels of those left out."""
    df = feature_frame(spark, sf)
    known = F.col(LABEL).isNotNull() & (F.col("id") % 4 != 0)
    return df.where(known), df.where(~known), essay_labels(spark, sf).where("id % 4 = 0")


@query("rf_score_check")
def q_rf_score_check(spark, sf):
    """The forest, judged on labelled essays that it hasn't seen."""
    tr, te, left = held_out(spark, sf)
    return md.score_checks(md.rf_score(*encoded(tr, te), "features", LABEL), left, on="test")


@query("split_train_merge_check")
def q_split_train_merge_check(spark, sf):
    """Both parts' models together, judged on labelled essays that they haven't seen."""
    tr, te, left = held_out(spark, sf)
    return md.score_checks(md.split_train_merge(tr, te, "project_essay_3", md.linear_score, prepare=encoded, features="features", label=LABEL), left, on="test")


@query("ensemble_stack_check")
def q_ensemble_stack_check(spark, sf):
    return md.score_checks(md.ensemble_stack(*stack_parts(spark, sf), ["m1", "m2", "m3"]))


@query("softmax_wide_check")
def q_softmax_wide_check(spark, sf):
    """Class probabilities of the two-block softmax in wide form: a row for each vector, whose probabilities sum to one."""
    s = md.softmax_score(two_blocks(spark, sf), ["embedding", "squares"], "label", key="vec_id")
    classes = [f"c{i}" for i in range(len(s.select("probs").first()[0]))]
    wide = ens.wide_from_array(s, classes, key="id", probs="probs")
    total = sum((F.col(c) for c in classes), F.lit(0.0))
    return wide.select("id", (F.abs(total - 1) < 1e-9).alias("ok"))


# ---------------------------------------------------------------- sources and sinks, column map (#1, #4-5, #55)

from tessera.session import scratch_dir  # noqa: E402
from tessera.sources import files as fs  # noqa: E402

ESSAY_CSV_SCHEMA = "id long, lang string, project_title string, description string"


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """Write the essays (multi-line-safe quoting) to CSV in the shared scratch folder and read them back."""
    e = T.essays_v(spark, sf).select("id", "lang", "project_title", "description")
    path = scratch_dir(spark, "csv")
    fs.write_csv(e, path)
    return fs.read_csv(spark, path, ESSAY_CSV_SCHEMA)


@query("label_lookup")
def q_label_lookup(spark, sf):
    """File listing labelled from a path segment (#6) and joined to a label table on the file stem (#7).
    The paths are derived from ``documents`` (``/corpus/<source>/<doc_id>.txt``); labels from ``labels``."""
    d = T.table(spark, sf, "documents")
    paths = d.select(F.concat_ws("/", F.lit(""), F.lit("corpus"), F.col("source"),
                                 F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
    listing = fs.label_paths(paths, "path", segment=3)
    lab = T.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("breed"))
    return fs.attach_labels(listing, lab).select("path", "stem", "label", "class")


@query("path_label_drop")
def q_path_label_drop(spark, sf):
    """Label from the last but one path segment without its first three characters (#6)."""
    d = T.table(spark, sf, "documents")
    paths = d.select("doc_id", F.concat_ws("/", F.lit(""), F.lit("corpus"), F.upper("source"),
                                           F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
    return fs.label_paths(paths, "path", segment=-2, drop=3).select("doc_id", "stem", "label")


@query("map_column")
def q_map_column(spark, sf):
    e = T.essays_v(spark, sf).select("id", "project_title")
    return tx.map_column(e, len, "project_title", "title_len", "long").select("id", "title_len")
