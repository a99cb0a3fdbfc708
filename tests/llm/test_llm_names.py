"""Extra columns may carry every name that an operator uses itself."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, linededup, pii

ODD = ["_doc", "__doc", "_hash", "_all", "_drop", "_every", "_dropped_", "_parts", "_whole", "_gaps", "_id", "_spans", "_hits", "_gone",
       "doc", "text_hash", "ln", "line", "token", "component", "bucket", "ws", "at", "m", "key", "items", "spans", "bad", "contaminated", "norm", "new"]
PASSAGE = " ".join(f"word{k}" for k in range(15))


@pytest.fixture()
def docs(spark):
    rows = [(1, "the very same long line\nmail a.b@example.org"), (2, "the very same long line\nanother one"), (3, "x " + PASSAGE), (4, None), (None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(c).alias(c) for c in ODD])


def kept(rows):
    assert all(r[c] == c for r in rows for c in ODD)
    return {r["doc_id"]: r for r in rows}


def test_line_dedup(docs):
    got = kept(linededup.dedup_lines(docs.withColumns({c: F.lit("old") for c in linededup.ADDED})).collect())
    assert [got[i]["_clean"] for i in (1, 2, 4, None)] == ["the very same long line\nmail a.b@example.org", "another one", None, ""]


def test_surrogates(docs):
    got = kept(pii.replace(docs.withColumns({c: F.lit("old") for c in pii.ADDED}), "key").collect())
    assert "a.b@example.org" not in got[1]["_clean"] and got[2]["_clean"] == "the very same long line\nanother one"


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_decontamination(spark, docs, remove):
    bench = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    out = decontam.decontaminate(docs, bench, remove=remove)
    got = kept(out.collect())
    assert out.columns == docs.columns and (3 not in got if remove == "documents" else got[3]["text"] == "x ")


def test_many_lines_that_share_a_passage_and_links_among_them(spark):
    """Lines of one common passage and an own part, none near another, but for a copy of each with one letter changed."""
    rows = []
    for k in range(120):
        own = "".join(chr(97 + (k * 7919 + j * j * 31 + j * k) % 26) for j in range(60))
        rows += [(2 * k, f"{own} " + "a passage that all of these lines carry with them"), (2 * k + 1, f"{own[:-1]}# " + "a passage that all of these lines carry with them")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)

    def near(a, b):
        x, y = ({t[i : i + 8] for i in range(len(t) - 7)} for t in (text[a], text[b]))
        return len(x & y) >= 0.8 * len(x | y)

    label = list(range(240))
    for a in range(240):
        for b in range(a):
            if near(a, b):
                lo, hi = sorted((label[a], label[b]))
                label = [lo if v == hi else v for v in label]
    gone = {r["doc_id"] for r in linededup.dedup_lines(df).where("_clean = ''").collect()}
    assert gone == {i for i in range(240) if label[i] != i}
