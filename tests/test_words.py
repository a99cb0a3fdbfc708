"""Treebank tokens, and scores under negation and intensifiers, on hand-made texts."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.treebank import treebank_tokens
from tessera.operators import modifiers as md
from tessera.operators import sentences as st

CASES = [
    (None, []), ("", []), (" \n\t ", []), ("Hello.", ["Hello", "."]),
    ("They'll save and invest more.", ["They", "'ll", "save", "and", "invest", "more", "."]),
    ("hi, my name can't hello,", ["hi", ",", "my", "name", "ca", "n't", "hello", ","]),
    ("Good muffins cost $3.88 in New York.", ["Good", "muffins", "cost", "$", "3.88", "in", "New", "York", "."]),
    ("1,000 at 10:30", ["1,000", "at", "10:30"]),
    ('He said, "Stop!"', ["He", "said", ",", "``", "Stop", "!", "''"]),
    ('"We beat some good teams," she said.', ["``", "We", "beat", "some", "good", "teams", ",", "''", "she", "said", "."]),
    ("The boys' books (all of them) -- gone...", ["The", "boys", "'", "books", "(", "all", "of", "them", ")", "--", "gone", "..."]),
    ("I cannot; we're gonna go", ["I", "can", "not", ";", "we", "'re", "gon", "na", "go"]),
    ("'Tis Mary's dog", ["'T", "is", "Mary", "'s", "dog"]),
    ("Dr. Smith isn't here.", ["Dr.", "Smith", "is", "n't", "here", "."]),
]


def test_treebank_cases(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "id int, t string")
    got = [list(r["x"]) for r in df.select("id", treebank_tokens("t").alias("x")).orderBy("id").collect()]
    for (text, want), x in zip(CASES, got, strict=True):
        assert x == want, text


def test_word_counts_follow_the_sentences(spark):
    df = spark.createDataFrame([(1, "The dog ran. The cat didn't.", 0), (2, None, 0), (None, "a b", 0)], "id int, t string, field int")
    model = st.learn(st.observations(df, ["t"]))
    got = {r["id"]: r["t_word_len"] for r in st.treebank_counts(df, ["t"], model).collect()}
    assert got == {1: 9, 2: 0, None: 2}


LEXICON = [("good", .7, .6, None, False), ("bad", -.7, .6, None, False), ("very", None, None, 1.3, False), ("slightly", None, None, .5, False),
           ("not", None, None, None, True), ("never", 0.0, 0.0, 9.0, True), ("fine", .4, None, None, None), ("void", None, None, None, None)]


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, polarity double, subjectivity double, intensity double, negates boolean")


def scores(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return [(r["polarity"], r["subjectivity"]) for r in md.modified_score(df, ["t"], lexicon(spark), digits=6).orderBy("id").collect()]


def test_negation_and_intensity(spark):
    good, very, not_very, not_, double, far, cut, nothing = scores(
        spark, "It is good", "VERY good", "not very good", "not good", "never not good", "not a b c d good", "not. Good", "void nothing")
    assert not_very[0] < 0 < good[0] < very[0]
    assert good == (.7, .6) and very == (.91, .78) and not_very == (-.455, .78) and not_ == (-.35, .6)
    assert double == good and far == good and cut == good and nothing == (0, 0)


def plain(text):
    import re
    total = [0.0, 0.0, 0]
    lex = {t: row for t, *row in LEXICON}
    for s in re.split(md.END, text):
        neg, factor, last = False, 1.0, None
        for k, w in enumerate(re.findall(r"\w+", s.lower())):
            if w not in lex or w == "void":
                continue
            p, q, i, n = lex[w]
            if last is not None and k - last > md.REACH:
                neg, factor = False, 1.0
            last = k
            if n:
                neg = not neg
            elif i is not None:
                factor *= i
            else:
                total[0] += max(-1, min(1, p * factor * (md.NEGATED if neg else 1)))
                total[1] += max(0, min(1, (q or 0) * factor))
                total[2] += 1
                neg, factor = False, 1.0
    return (total[0] / total[2], total[1] / total[2]) if total[2] else (0.0, 0.0)


def test_fold_equals_a_plain_loop(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice([*(t for t, *_ in LEXICON), "a", "b", "c.", "d\n"]) for _ in range(r.randrange(1, 60))) for _ in range(120)]
    for (a, b), t in zip(scores(spark, *texts), texts, strict=True):
        assert (a, b) == pytest.approx(plain(t), abs=1e-6), t


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, "very good", "not bad"), (3, "", " "), (4, "good " * 20000, None)], "id int, t string, token string")
    got = {r["id"]: (r["polarity"], r["subjectivity"]) for r in md.modified_score(df, ["t", "token"], lexicon(spark)).collect()}
    assert got == {1: (0, 0), None: (.63, .69), 3: (0, 0), 4: (.7, .6)}
    assert md.modified_score(df.where("false"), ["t"], lexicon(spark)).count() == 0
    assert md.modified_score(df, ["t"], lexicon(spark).where("false")).select(F.sum("polarity")).first()[0] == 0


def test_character_class_is_exact_and_guarded(spark):
    """Characters outside are told by the ranges that hold the groups, not by walking all ranges."""
    from tessera.functions import text as tx
    some = {chr(c) for c in [*range(0xBC, 0xBF), *range(0x1F1, 0x1F4), *range(0x2460, 0x2500, 2), *range(0xFB00, 0xFB07), 0xFFFC]}
    pattern = tx._char_class(some)
    df = spark.range(0x80, 0x10000).where("id not between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("t"))
    assert {r["t"] for r in df.where(F.col("t").rlike(pattern)).collect()} == some
    assert pattern.count("&&") > 1 and pattern.startswith("[[\\x{BC}-\\x{FFFC}]&&[")
