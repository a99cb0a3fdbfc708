"""Hand-made edge rows (FIXTURES.md part C) with hand-computed expected values."""

import math

from pyspark.sql import functions as F

from tessera.functions import calendar as cal
from tessera.functions import nulls
from tessera.functions import text as tx
from tessera.operators import encoders as enc
from tessera.operators import lexicon as lx
from tessera.operators import rollup
from tessera.operators import tfidf as tf
from tessera.operators import vocab as vc


def one(spark, expr, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_clean_text_edges(spark):
    c = tx.clean_text("t")
    assert one(spark, c, "") == ""
    assert one(spark, c, None) == ""
    assert one(spark, c, "!!! ... ??") == ""
    assert one(spark, c, "nan") == "nan"
    assert one(spark, c, "an ox ate Äpfel, naïve café") == "ate äpfel naïve café"
    assert one(spark, c, "x_y_z ab") == "x_y_z"


def test_counts(spark):
    assert one(spark, tx.sentence_count("t"), "Hello world. How are you? Fine") == 3
    assert one(spark, tx.sentence_count("t"), "") == 0
    assert one(spark, tx.sentence_count("t"), "...") == 1
    assert one(spark, tx.word_count("t"), "Hi, there!") == 4
    assert one(spark, tx.word_count("t"), None) == 0


def test_strip_accents_combining_and_precomposed(spark):
    assert one(spark, tx.strip_accents("t"), "Crème brûlée é") == "Creme brulee e"
    assert one(spark, tx.strip_accents("t"), "straße") == "straße"
    # Beyond Latin-1: Greek tonos, Cyrillic short i, Vietnamese stacked marks.
    assert one(spark, tx.strip_accents("t"), "Ελληνικά й Tiếng Việt") == "Ελληνικα и Tieng Viet"


def test_pairwise_overlap_empty_pair_counts_one(spark):
    df = spark.createDataFrame([(1, "", ""), (2, "abc def", "def xyz abc"), (3, "abc", "")],
                               "id long, a string, b string")
    got = {r["id"]: r["a_b_common"] for r in lx.pairwise_overlap(df, ["a", "b"]).collect()}
    assert got == {1: 1, 2: 2, 3: 0}


def test_calendar_labels(spark):
    df = spark.createDataFrame([(1,)], "id int").select(F.lit("2016-04-27 10:00:00").cast("timestamp").alias("ts"))
    r = cal.calendar_labels(df, "ts").first()
    assert (r["monthofyear"], r["dayofweek"]) == ("Apr_2016", "Wednesday")


def test_rollup_edges(spark):
    res = spark.createDataFrame(
        [(1, 1, "b", 2.0, 1.5), (1, 1, "a", 1.0, 2.0), (1, 2, None, 1.0, None), (2, 1, "x", None, None)],
        "id long, seq int, description string, quantity double, price double")
    par = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    out = {r["id"]: r for r in rollup.project_enrich(par, rollup.resource_rollup(res)).collect()}
    assert out[1]["description"] == "a\nb\nnan"
    assert out[1]["total_price"] == 2.0 + 3.0
    assert (out[1]["max_price"], out[1]["min_price"], out[1]["mean_price"]) == (2.0, 1.5, 1.75)
    assert out[2]["total_price"] == 0.0 and out[2]["max_price"] is None  # all-null group
    assert out[3]["description"] is None and out[3]["total_price"] is None  # parent without child


def test_target_encoding_unseen_and_seen_once(spark):
    train = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "a", 1), (4, "b", 0)], "id long, c string, y int")
    test = spark.createDataFrame([(9, "a"), (10, "b"), (11, "zzz"), (12, None)], "id long, c string")
    model = enc.TargetEncode(["c"], "y").fit(train)
    got = {r["id"]: r["encoded"] for r in model.transform(test).collect()}
    prior = 0.5
    w = 1 / (1 + math.exp(-(3 - 1)))
    assert math.isclose(got[9], prior * (1 - w) + (2 / 3) * w)
    assert got[10] == prior and got[11] == prior and got[12] == prior
    m = enc.TargetEncode(["c"], "y", method="m", m=2.0).fit(train)
    got_m = {r["id"]: r["encoded"] for r in m.transform(test).collect()}
    assert math.isclose(got_m[9], (3 * (2 / 3) + 2 * 0.5) / 5)


def test_minmax_constant_and_unseen(spark):
    train = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id long, k double, x double")
    test = spark.createDataFrame([(3, 7.0, 4.0), (4, float("nan"), None)], "id long, k double, x double")
    m = enc.MinMax(["k", "x"]).fit(train)
    tr = {r["id"]: r for r in m.transform(train).collect()}
    te = {r["id"]: r for r in m.transform(test).collect()}
    assert tr[1]["k"] == 0.0 and tr[2]["x"] == 1.0
    assert te[3]["k"] == 2.0 and te[3]["x"] == 1.5  # no clipping; zero range divides by 1
    assert math.isnan(te[4]["k"]) and te[4]["x"] is None


def test_poly2_order(spark):
    assert one(spark, enc.poly2(F.col("v")), [2.0, 3.0], "v array<double>") == [1.0, 2.0, 3.0, 4.0, 6.0, 9.0]


def test_multi_hot_items(spark):
    df = spark.createDataFrame([(1, "Math, Art ,math,"), (2, None)], "id long, c string")
    m = enc.MultiHot(["c"]).fit(df)
    vocab = [r["value"] for r in m.vocab.orderBy("index").collect()]
    assert vocab == ["", "art", "math"]
    assert sorted(r["index"] for r in m.transform(df).collect()) == [0, 1, 2]


def test_ngrams_shorter_than_n(spark):
    df = spark.createDataFrame([(1, "solo"), (2, "one two three")], "id long, t string")
    got = {(r["id"], r["term"]) for r in tf.stopword_ngrams(df, "t", 2, 3, stop=[]).collect()}
    assert got == {(2, "one two"), (2, "two three"), (2, "one two three")}


def test_tfidf_weights_hand_computed(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a"), (3, "b b")], "id long, t string")
    m = tf.TfIdf("t", max_features=None, ngram=(1, 1), min_df=1, max_df=1.0, stop=[]).fit(docs)
    w = {(r["id"], r["term"]): r["weight"] for r in m.transform(docs).collect()}
    idf = math.log(4 / 3) + 1
    assert math.isclose(w[(2, "a")], 1.0) and math.isclose(w[(3, "b")], 1.0)
    assert math.isclose(w[(1, "a")], idf / math.sqrt(2 * idf * idf))


def test_sequences_vocab_ties_and_unknown(spark):
    docs = spark.createDataFrame([(1, "b a c"), (2, "a, c!"), (3, "")], "id long, t string")
    voc = vc.token_vocab((docs, "t"))
    ranks = {r["token"]: r["rank"] for r in voc.collect()}
    assert ranks == {"a": 1, "c": 2, "b": 3}
    seqs = {r["id"]: r["seq"] for r in vc.token_sequences(docs, "t", voc, num_words=3).collect()}
    assert seqs == {1: [1, 2], 2: [1, 2], 3: []}


def test_nan_safe_sigmoid(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (2.0,), (None,)], "x double")
    z = [r["x"] for r in nulls.nan_safe_sigmoid(df, "x").collect()]
    assert z[0] == 0.5 and z[1] == 0.5 and math.isclose(z[2], 1 / (1 + math.exp(-2))) and z[3] == 0.5
    m = [r["x"] for r in nulls.nan_safe_sigmoid(df, "x", fill="mean").collect()]
    assert math.isclose(m[0], 1 / (1 + math.exp(-1.0)))


def test_numeric_coerce_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([("1.5",), ("oops",)], "v string")
    assert [r["v"] for r in nulls.numeric_coerce(df, ["v"], strict=False).collect()] == [1.5, None]
    with pytest.raises(Exception):
        nulls.numeric_coerce(df, ["v"], strict=True).collect()


def test_strip_accents_is_the_decomposition_of_every_character(spark):
    import unicodedata as u

    def plain(t):
        return "".join(c for c in u.normalize("NFKD", t) if not u.category(c).startswith("M"))
    chars = [chr(cp) for cp in range(1, 0x10000) if u.category(chr(cp)) not in ("Cs", "Co", "Cn")]
    texts = chars + ["".join(chars[k:k + 50]) for k in range(0, len(chars), 50)] + ["ﬁn ½ cup \U0001F389 ﷺ 한국어 Ǆ", "\U0001F389 é", "plain", ""]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").repartition(8)
    got = {r["t"]: r["s"] for r in df.select("t", tx.strip_accents("t").alias("s")).collect()}
    assert got.pop(None) is None
    assert [t for t, v in got.items() if v != plain(t)] == []


def test_keyword_counts_exact_tokens(spark):
    df = spark.createDataFrame([(1, "book book computer my students")], "id long, t string")
    got = {(r["keyword"], r["count"]) for r in lx.keyword_counts(df, ["t"], lx.REFERENCE_KEYWORDS).collect()}
    assert got == {("book", 2), ("computer", 1)}


def test_stop_words_are_the_reference_list(spark):
    stop = tf.default_stop_words()
    assert len(stop) == 318 and len(set(stop)) == 318 and list(stop) == sorted(stop)
    # Words of this list that Spark ML's shorter English list does not have are removed too.
    df = spark.createDataFrame([(1, "Amongst the hereafter Zebras, we found nothing thereafter")], "id long, t string")
    got = {r["term"] for r in tf.stopword_ngrams(df, "t", 1, 1).collect()}
    assert got == {"zebras"}


def test_keyword_matrix_wide_with_zeros(spark):
    df = spark.createDataFrame([(1, "book book computer", None), (2, "", "Laptop and a laptop")],
                               "id long, a string, b string")
    out = lx.keyword_matrix(df, ["a", "b"], ["book", "laptop", "my students"])
    assert out.columns == ["id", "a_book_count", "a_laptop_count", "a_my students_count",
                           "b_book_count", "b_laptop_count", "b_my students_count"]
    rows = {r["id"]: tuple(r)[1:] for r in out.collect()}
    assert rows == {1: (2, 0, 0, 0, 0, 0), 2: (0, 0, 0, 0, 2, 0)}


def test_token_class_matrix_keeps_rows_without_tokens(spark):
    df = spark.createDataFrame([(1, "red apple red"), (2, "zz"), (3, None)], "id long, t string")
    lex = spark.createDataFrame([("red", "ADJ"), ("apple", "NOUN")], "token string, class string")
    out = lx.token_class_matrix(df, ["t"], lex, ["ADJ", "NOUN", "VERB"])
    rows = {r["id"]: (r["t_ADJ_count"], r["t_NOUN_count"], r["t_VERB_count"]) for r in out.collect()}
    assert rows == {1: (2, 1, 0), 2: (0, 0, 0), 3: (0, 0, 0)}


def test_target_encoding_out_of_fold_hand_computed(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 0, 1), (3, "a", 1, 1), (4, "b", 0, 0)],
                               "id long, c string, y int, fold int")
    te = enc.TargetEncode(["c"], "y", method="m", m=1.0)
    got = {r["id"]: r["encoded"] for r in te.fit_transform_out_of_fold(df, "fold").collect()}
    # id 1 (fold 0) sees fold 1: a has n=2, mean 0.5, prior 0.5 -> (1 + 0.5) / 3. ids 2, 3 (fold 1) see
    # fold 0: a has n=1, mean 1, prior 0.5 -> 1.5 / 2. id 4: b never occurs outside its fold -> prior 0.5.
    assert got == {1: 0.5, 2: 0.75, 3: 0.75, 4: 0.5}
