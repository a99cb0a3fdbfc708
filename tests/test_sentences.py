"""Learned sentence boundaries: hand-made texts, and a plain version of the statistics."""

import collections
import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import sentences as st

NAMES = ["Smith", "Jones", "Brown", "Miller", "Young"]
VERBS = ["walks", "reads", "sleeps", "writes", "sings", "waits"]
PLACES = ["home", "school", "town", "church", "market"]


def corpus(n=400, seed=3):
    """Texts of four sentences and a fragment each; (text, its number of sentences)."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        ss = []
        for _ in range(4):
            who = r.choice([f"Dr. {r.choice(NAMES)}", f"Mrs. {r.choice(NAMES)}", "The man", "The child", "She"])
            how = r.choice(["", ", e.g. daily,", " often", " (i.e. always)"])
            ss.append(f"{who} {r.choice(VERBS)}{how} near the {r.choice(PLACES)}{r.choice('...!?')}")
        out.append((" ".join(ss) + r.choice([" ", "\n"]) + "and so on", None))
    return [t for t, _ in out]


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame(list(enumerate(corpus())), "id int, t string")
    return st.learn(st.observations(df, ["t"]))


def test_abbreviations_are_found(model):
    got = {r["typ"] for r in model.abbreviations.collect()}
    assert {"dr", "mrs", "e.g", "i.e"} <= got
    assert not got & {p for p in PLACES} and "man" not in got


def split(spark, model, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    return [r["sentences"] for r in st.split_sentences(df, ["t"], model).orderBy("id").collect()]


def test_abbreviations_end_no_sentence(spark, model):
    got = split(spark, model, "Dr. Smith walks near the town. She reads, e.g. daily, near the home.", "She waits! The man sings near the market", 'The man said "She walks near town." She reads.')
    assert got[0] == ["Dr. Smith walks near the town.", "She reads, e.g. daily, near the home."]
    assert got[1] == ["She waits!", "The man sings near the market"]
    assert got[2] == ['The man said "She walks near town."', "She reads."]


def test_an_abbreviation_may_end_a_sentence(spark, model):
    # "She" is written small nowhere, but starts sentences often; a name after a title doesn't.
    got = split(spark, model, "The child waits near Mrs. She walks home.")
    assert got[0] == ["The child waits near Mrs.", "She walks home."]


def test_odd_texts(spark, model):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \n\t ", "z"), (4, "...", "w"), (5, "One. . Two!? Three", "v"), (None, "No id here. None at all.", "u"), (6, "word " * 30000 + "end. The man sings.", "t")]
    df = spark.createDataFrame(rows, "id int, t string, at string")
    got = {r["id"]: r["t_sent_len"] for r in st.sentence_counts(df, ["t"], model).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 4, None: 2, 6: 2}
    parts = {r["id"]: r["sentences"] for r in st.split_sentences(df, ["t"], model).collect()}
    assert parts[1] == parts[2] == parts[3] == [] and parts[5] == ["One.", ".", "Two!?", "Three"] and len(parts[6]) == 2
    empty = df.where("false")
    bare = st.learn(st.observations(empty, ["t"]))
    assert st.sentence_counts(empty, ["t"], bare).count() == 0
    assert st.sentence_counts(df, ["t"], bare).count() == 7


def test_scores_equal_a_plain_count(spark):
    texts = corpus(60, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    seen = st.observations(df, ["t"])
    stop, plain = Counter(), Counter()
    for t in texts:
        for w in t.split():
            w = w.strip("\"'()")
            typ = w.rstrip(".!?,;:").lower()
            (stop if w.endswith(".") else plain)[typ] += 1
    n, s = sum(stop.values()) + sum(plain.values()), sum(stop.values())
    got = {r["typ"]: r for r in st.abbreviation_scores(seen).collect()}
    assert set(got) == set(stop)
    for typ in stop:
        a, b = stop[typ], plain[typ]
        ratio = 2 * (a * math.log(.99) + b * math.log(.01) - a * math.log(s / n) - b * math.log(1 - s / n))
        size = len(typ.replace(".", ""))
        want = ratio * math.exp(-size) * (len(typ) - size + 1) * size ** -b
        assert got[typ]["n_stop"] == a and got[typ]["n_plain"] == b
        assert got[typ]["score"] == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_association_is_the_ratio_of_binomials(spark):
    ab, a, b, n = 7, 20, 30, 500
    ll = spark.range(1).select(st._association(F.lit(ab), F.lit(a), F.lit(b), n).alias("x")).first()["x"]

    def log(k, m, p):
        return k * math.log(p) + (m - k) * math.log(1 - p)
    want = 2 * (log(ab, a, ab / a) + log(b - ab, n - a, (b - ab) / (n - a)) - log(ab, a, b / n) - log(b - ab, n - a, b / n))
    assert ll == pytest.approx(want)


def test_salted_and_broadcast_joins_agree(spark, model, monkeypatch):
    df = spark.createDataFrame(list(enumerate(corpus(50, 9))), "id int, t string")
    near = sorted(map(tuple, st.breaks(df, ["t"], model).collect()))
    monkeypatch.setattr("tessera.operators.joins.broadcastable", lambda *a, **k: False)
    assert sorted(map(tuple, st.breaks(df, ["t"], model).collect())) == near and near


def test_passes_over_a_text_keep_the_rules_of_its_tokens(spark):
    """Cores, types, marks and cases of odd tokens as each token has them by itself."""
    r = random.Random(8)
    toks = ["".join(r.choice("aZ9.,!?…;:'\"([{)]}*_«»“”¿éÉßΣİ+-\x0b ") for _ in range(r.randint(1, 6))) for _ in range(900)]
    texts = [r.choice(["", " ", "\n"]) + "".join(t + r.choice([" ", "  ", "\t", "\r\n"]) for t in toks[i : i + 9]) for i in range(0, 900, 9)] + ["", " \n", '"', "((( ***"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")

    def rules(t):
        core = re.sub(r"""["')\]}»”’*_]+\Z""", "", re.sub(r"""^["'(\[{«“‘„¿¡*_]+""", "", t))
        typ = re.sub(r"[.!?…,;:]+\Z", "", core).lower()
        typ = "##" if re.fullmatch(r"[+-]?[.,]?[0-9][0-9.,-]*", typ) else typ
        mark = "end" if re.search(r"[!?][.!?]*\Z", core) or core == "." else "dots" if re.search(r"\.\.\Z|…\Z", core) else "stop" if core.endswith(".") else "none"
        kind = unicodedata.category(core[0]) if core else ""
        return typ, mark, {"Lu": "u", "Ll": "l"}.get(kind, "o")

    want = collections.Counter()
    for t in texts:
        before = ("", "start", "")
        for tok in re.findall(r"[^ \t\n\f\r]+", t):
            now = rules(tok)
            want[(*now, before[1], before[0] if before[1] == "stop" else None)] += 1
            before = now
    got = {(x["typ"], x["mark"], x["letter"], x["before"], x["left"]): x["n"] for x in st.observations(df, ["t"]).collect()}
    assert got == want


def test_tokens_are_not_worked_on_one_by_one_in_arrays(spark, model):
    """A regex in a lambda over an array of tokens runs outside compiled code, several for every token."""
    df = spark.createDataFrame([(1, "He waits. She reads.")], "id int, t string")
    assert "lambda" not in st.breaks(df, ["t"], model)._jdf.queryExecution().optimizedPlan().toString()
