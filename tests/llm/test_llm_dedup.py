"""Components, SimHash, line dedup, decontamination, search: against brute force and SQL."""

import random

import duckdb
import numpy as np
import pytest
from brute import classes, near_lines, simhash
from oracle_harness import compare
from pyspark.sql import functions as F

from tessera.llm import covertree, decontam, linededup, simhash as sim
from tessera.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, fingerprint int, component_id string, doc string, id int, n_words string, k1 int"


def odd_docs(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, "c", "l", 2, "n", 3) for i, t in rows], ODD)


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_components_of_random_graphs(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1040)] + [(k, k + 1) for k in range(2000, 2060)]
    edges += [(5, 5), (7, 9), (9, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    label = classes(2100, [e for e in edges if None not in e])
    assert got == {i: c for i, c in enumerate(label) if c != i}
    assert components(df.where("false")).collect() == []


@pytest.mark.parametrize("tile", [3, 1024])
def test_simhash_against_brute_force(spark, tile):
    docs = documents(spark)
    base = docs[0][1]
    rnd = random.Random(2)
    for k in range(30):  # a group of copies with small changes
        words = base.split(" ")
        words[rnd.randrange(len(words))] = f"changed{k}"
        docs.append((10_000 + k, " ".join(words)))
    docs += [(20_001, None), (20_002, ""), (20_003, " \n "), (20_004, "one"), (20_005, "One"), (20_006, "two words"), (20_007, "w " * 4000)]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in sim.near_duplicates(odd_docs(spark, docs), tile=tile).collect()}
    assert got == simhash(docs)
    assert got[20_001] == got[20_002] == got[20_003] == ("0" * 16, 20_001)


def test_simhash_repeats_null_ids_and_empty_table(spark):
    df = odd_docs(spark, [(2, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "quite another text here")])
    got = [(r["doc_id"], r["component_id"]) for r in sim.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(2, 1), (2, 1), (1, 1), (None, 1), (None, None)], key=str)
    assert sim.near_duplicates(df.where("false")).collect() == []


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{k % 977}" for k in range(20_000))
    whole = sim.fingerprint(text)
    monkeypatch.setattr(sim, "PIECE", 1000)
    assert sim.fingerprint(text) == whole


def test_forest_connects_what_all_links_connect():
    rnd = np.random.default_rng(4)
    a = np.unique(rnd.integers(0, 2**12, 400))
    near = [(i, j) for i in range(len(a)) for j in range(i) if int(a[i] ^ a[j]).bit_count() <= 1]
    x, y = sim.forest(a, a, 1, True)
    at = {int(v): k for k, v in enumerate(a)}
    assert len(x) < len(a) and classes(len(a), [(at[int(p)], at[int(q)]) for p, q in zip(x, y)]) == classes(len(a), near)


def test_op4_against_brute_force(spark):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in sim.op4_simhash(spark, SF).collect()}
    assert got == simhash(documents(spark))


def variants(n, seed):
    """A sentence with one of its words replaced: each is near most others, none equal."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(40)]
    out = []
    for k in range(n):
        w = list(words)
        w[rnd.randrange(40)] = f"{k:07d}"
        out.append(" ".join(w))
    return out


def check_lines(spark, docs, **how):
    got = {r["doc_id"]: (set(r["_dropped"] or []), r["_clean"], r["_lines"]) for r in linededup.dedup_lines(odd_docs(spark, docs), **how).collect()}
    gone, unclear = near_lines(docs, how.get("shingle", 8))
    for i, t in docs:
        dropped, clean, lines = got[i]
        if i not in unclear:
            assert dropped == gone[i], i
        else:
            assert dropped <= gone[i]
        if t is None:
            assert clean is None and lines == 0
        else:
            every = t.split("\n")
            assert clean == "\n".join(x for k, x in enumerate(every) if k not in dropped)
            assert lines == sum(bool(x.strip(" \t\r")) for x in every)


def test_line_dedup_against_brute_force(spark):
    check_lines(spark, documents(spark))


def test_short_lines_of_least_similarity_meet_in_a_band(spark):
    """Lines of 9 shingles, 8 of them shared (similarity 0.8)."""
    rnd = random.Random(8)
    lines = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=17)).replace(" ", "x") for _ in range(4000)]
    rows = [(2 * k + i, t[i : i + 16]) for k, t in enumerate(lines) for i in (0, 1)]
    df = spark.createDataFrame(rows, "doc long, line string")
    found = {r["doc"]: set(r["buckets"]) for r in linededup.signatures(df, linededup.SHINGLE, linededup.BANDS, linededup.ROWS).select("doc", "buckets").collect()}
    assert sum(bool(found[2 * k] & found[2 * k + 1]) for k in range(4000)) >= 0.995 * 4000


def test_line_dedup_in_rounds(spark, monkeypatch):
    """Bands of one minimum give buckets with lines of several components; those take several rounds."""
    monkeypatch.setattr(linededup, "PIVOTS", 1)
    docs = list(enumerate(variants(5, 1) + variants(4, 2) + variants(4, 3) + variants(3, 4)))
    check_lines(spark, docs, bands=6, rows=1, shingle=2, threshold=0.8)


def test_groups_of_the_same_lines_are_compared_once(spark):
    """Tokens 1 to 3 hold the same lines, 4 has one less, 5 another one, 6 one component, 7 the lines of 5."""
    sets = {1: (10, 11, 12), 2: (12, 10, 11), 3: (10, 11, 12), 4: (10, 11), 5: (10, 13), 6: (11, 12), 7: (13, 10)}
    at = {10: 10, 11: 11, 12: 11, 13: 13}
    groups = spark.createDataFrame([(t, i, at[i]) for t, ids in sets.items() for i in ids], "token long, id long, component long")
    assert sorted(r["token"] for r in linededup.open_groups(groups).collect()) == [1, 4, 5]


def test_pairs_of_a_prefix_group_follow_places(spark):
    """Lines that share passages but have shingles of their own are paired by few of their common tokens; all links are among the pairs."""
    rnd = random.Random(12)
    base = "".join(rnd.choice("abcdefghij") for _ in range(130))
    texts = [base[:50] + f"{k:08d}" + base[58:] + f"{k * 7919:09d}" for k in range(24)]
    texts += [t[:128] + "z" + t[129:] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    groups = linededup.prefixes(df, 8, 0.8)
    other = groups.select("token", F.col("id").alias("other"), F.col("n").alias("m"), F.col("i").alias("j"))
    both = groups.join(other, "token").where("id < other")
    made = [(r["id"], r["other"]) for r in both.where(linededup.may_reach(0.8)).collect()]
    sets = [{t[k : k + 8] for k in range(len(t) - 7)} for t in texts]
    near = {(a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(near) >= 24 and near <= set(made)
    assert len(made) < 0.3 * both.count()


def test_line_dedup_of_large_groups_and_edges(spark):
    docs = [(k, f"{v}\nown line of document {k * 7919} and more {k * 104729}") for k, v in enumerate(variants(60, 1) + variants(40, 2))]
    docs += [(1000 + k, "common line\n\n  common line \r\nshort") for k in range(50)]
    docs += [(2001, None), (2002, ""), (2003, "\n \n"), (2004, "x"), (2005, "x"), (2006, "日本語のテキスト行です。とても長い\n🎉🎉🎉"), (2007, "🎉🎉🎉"), (2008, "z" * 50_000)]
    check_lines(spark, docs)


def test_line_dedup_repeated_rows_null_ids_and_empty_table(spark):
    df = odd_docs(spark, [(3, "alpha beta gamma\nonly here in three"), (3, "alpha beta gamma\nonly here in three"), (None, "alpha beta gamma\nonly here in none"), (None, "only here in none")])
    got = sorted((str(r["doc_id"]), r["_clean"]) for r in linededup.dedup_lines(df).collect())
    assert got == [("3", "alpha beta gamma\nonly here in three")] * 2 + [("None", "only here in none")] * 2
    assert linededup.dedup_lines(df.where("false")).collect() == []


def test_op2_returns_every_document(spark):
    got = {r["doc_id"]: r for r in linededup.op2_linededup(spark, SF).collect()}
    docs = documents(spark)
    assert len(got) == len(docs)
    gone, unclear = near_lines(docs)
    assert all(got[i]["dropped"] == sorted(gone[i]) and got[i]["n_dropped"] == len(gone[i]) for i, _ in docs if i not in unclear)


def test_op9_against_sql(spark):
    assert compare(spark, "op9", decontam.op9_decontam(spark, SF), decontam.OP9_SQL, SF)["ok"]


BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Short ITEM here"), (3, "solo"), (4, None), (5, "!!"),
         (6, "short item HERE"), (None, "nobody owns this"), (7, "x y")]


def test_decontamination_edges_against_sql(spark, tmp_path):
    run = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = [(1, None), (2, ""), (3, "..."), (4, f"Before {run.upper()}; after"), (5, run + " fourteen"), (6, run[:-3]), (7, "a short, item HERE! short item here"), (8, "so solo solo"),
            (9, "nobody owns this"), (10, "x y x y x " + "filler " * 100), (11, "x-y " + "filler " * 300), (12, "the wörld x y é " * 2)]
    item_rows = spark.createDataFrame(BENCH, "item_id long, text string")
    item_rows.coalesce(1).write.parquet(str(tmp_path / "b"))
    odd_docs(spark, docs).coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view benchmark as select * from '{tmp_path}/b/*.parquet'")
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"select doc_id, n_words, n_hit, contaminated from ({decontam.OP9_SQL})").fetchall()}
    found = decontam.report(odd_docs(spark, docs), item_rows)
    got = {r["doc_id"]: r for r in found.collect()}
    assert {i: (r["n_words"], r["n_hit"], r["contaminated"]) for i, r in got.items()} == want
    assert sorted(got[7]["items"]) == [2, 6] and got[5]["items"] == [1] and got[9]["items"] == [] and got[9]["contaminated"]
    kept = decontam.decontaminate(odd_docs(spark, docs), item_rows)
    assert kept.columns == odd_docs(spark, docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if not w[2]}
    spans = {r["doc_id"]: r["text"] for r in decontam.decontaminate(odd_docs(spark, docs), item_rows, remove="spans").collect()}
    assert spans[1] is None and spans[2] == "" and spans[4] == "Before after" and spans[8] == "so " and spans[11] == docs[10][1].replace("x-y ", "")
    nothing = decontam.report(odd_docs(spark, docs), item_rows.where("false")).collect()
    assert len(nothing) == len(docs) and not any(r["contaminated"] or r["n_hit"] for r in nothing)
    assert decontam.report(odd_docs(spark, docs).where("false"), item_rows).collect() == []


def test_decontamination_repeated_rows_and_shuffled_set(spark, monkeypatch):
    docs = odd_docs(spark, [(1, "x y"), (1, "x y"), (1, "other"), (None, "short item here")])
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    want = [("1", "1", "False"), ("1", "2", "True"), ("None", "3", "True")]
    rows = lambda: sorted(tuple(map(str, (r["doc_id"], r["n_words"], r["contaminated"]))) for r in decontam.report(docs, items).collect())
    assert rows() == want
    monkeypatch.setattr(decontam, "broadcastable", lambda df: False)
    assert rows() == want
    assert [r["text"] for r in decontam.decontaminate(docs, items).collect()] == ["other"]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, rank int, id int")


def brute_search(rows, is_query, k):
    fine = {i: [int(np.floor(64 * x)) for x in v] for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = {}
    for q in filter(is_query, fine):
        s = sorted((-sum(a * b for a, b in zip(fine[q], fine[i])), i) for i in fine if i != q)
        out[q] = [(i, -x) for x, i in s[:k]]
    return out


@pytest.mark.parametrize("blocks", [(4, 9), (4096, 4096)])
def test_search_against_brute_force(spark, blocks):
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.normal(size=6) * (1 + i % 3)).round(1).tolist(), "s", 1, 2) for i in range(260)]
    rows += [(300 + i, rows[0][1], "s", 1, 2) for i in range(30)]  # ties
    rows += [(400, None, "s", 1, 2), (401, [1.0, None], "s", 1, 2), (402, [float("nan")] * 6, "s", 1, 2), (403, [float("inf")] * 6, "s", 1, 2), (404, [0.5, 0.5], "s", 1, 2),
             (405, [], "s", 1, 2), (None, [1.0] * 6, "s", 1, 2), (10, rows[10][1], "s", 1, 2), (406, [-0.0] * 6, "s", 1, 2), (407, [1e-9] * 6, "s", 1, 2)]
    df = vectors(spark, rows).select("vec_id", covertree.quantised(F.col("embedding")).alias("vector"))
    got = {}
    for r in covertree.top_k(df.where("vec_id % 10 = 0"), df, 7, query_block=blocks[0], data_block=blocks[1]).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got == brute_search(rows, lambda i: i % 10 == 0, 7)


def test_search_prunes_and_handles_few_rows(spark, monkeypatch):
    monkeypatch.setattr(covertree, "LEAF", 64)
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(40, 3)) * 40
    x = (centres[rnd.integers(0, 40, 4000)] + rnd.normal(size=(4000, 3))).round().astype(np.int64)
    met = []
    inner = covertree.Search.leaves
    covertree.Search.leaves = lambda self, a, b: (met.append(len(a.rows) * len(b.rows)), inner(self, a, b))
    try:
        got = covertree.Search(np.arange(200), x[:200], np.arange(4000), x, 5)
    finally:
        covertree.Search.leaves = inner
    assert sum(met) < 0.5 * 200 * 4000
    s = x[:200] @ x.T
    np.fill_diagonal(s, np.iinfo(np.int64).min)
    assert (got.score == np.sort(s, axis=1)[:, ::-1][:, :5]).all()
    two = vectors(spark, [(1, [1.0], "s", 1, 2), (2, [2.0], "s", 1, 2)]).select("vec_id", covertree.quantised(F.col("embedding")).alias("vector"))
    assert [tuple(r) for r in covertree.top_k(two, two, 20).orderBy("query_id").collect()] == [(1, 1, 2, 64 * 128), (2, 1, 1, 64 * 128)]
    assert covertree.top_k(two.where("false"), two, 3).collect() == [] and covertree.top_k(two, two.where("false"), 3).collect() == []


def test_search_beyond_exact_floats():
    x = np.array([[2**30, 1], [2**30, 2], [2**30, 3]], np.int64)
    got = covertree.Search(np.array([0]), x[:1], np.arange(3), x, 2)
    assert got.score.tolist() == [[2**60 + 3, 2**60 + 2]]


def test_op8_against_sql(spark):
    assert compare(spark, "op8", covertree.op8_covertree(spark, SF), covertree.OP8_SQL, SF)["ok"]
