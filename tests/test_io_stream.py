"""Sources, sinks and the streaming wrapper."""

import os
import time

from pyspark.sql import functions as F

from tessera.session import FILE_CLEANUP, cut_lineage, scratch_dir
from tessera.sources import files as fs
from tessera.operators import vocab as vc
from tessera.streaming import scoring


def test_csv_roundtrip_quotes_and_newlines(spark):
    df = spark.createDataFrame([(1, 'say "hi"\nnext line', None), (2, "", "x,y")], "id long, a string, b string")
    path = scratch_dir(spark, "csvtest")
    fs.write_csv(df, path)
    back = {r["id"]: (r["a"], r["b"]) for r in fs.read_csv(spark, path, "id long, a string, b string").collect()}
    assert back[1] == ('say "hi"\nnext line', None)
    assert back[2] == (None, "x,y")


def test_vector_text_header_skipped(spark):
    path = scratch_dir(spark, "vec")
    os.makedirs(path)
    with open(os.path.join(path, "v.txt"), "w") as f:
        f.write("2 3\nred 0.1 0.2 0.3\nblue 1 2 3 \n")
    got = {r["word"]: r["vec"] for r in vc.read_vectors(spark, path).collect()}
    assert set(got) == {"red", "blue"} and len(got["red"]) == 3 and got["blue"] == [1.0, 2.0, 3.0]


def test_list_labelled_from_path(spark):
    root = scratch_dir(spark, "imgs")
    for d, n in [("n0001-Dog_A", "x1"), ("n0002-Cat_B", "x2")]:
        os.makedirs(os.path.join(root, d))
        with open(os.path.join(root, d, n + ".jpg"), "wb") as f:
            f.write(b"\x00")
    lst = fs.list_labelled(spark, root, "*.jpg", segment=-2, drop=6)
    got = {r["stem"]: r["label"] for r in lst.collect()}
    assert got == {"x1": "dog_a", "x2": "cat_b"}
    labels = spark.createDataFrame([("x1", "beagle")], "id string, breed string")
    joined = {r["stem"]: r["class"] for r in fs.attach_labels(lst, labels).collect()}
    assert joined == {"x1": "beagle", "x2": None}


def test_stream_transform_available_now(spark):
    src = scratch_dir(spark, "stream-src")
    spark.createDataFrame([(1, "Hello World"), (2, "naïve café")], "id long, t string").write.parquet(src)
    out = scratch_dir(spark, "stream-out")
    from tessera.functions.text import clean_text
    q = scoring.run_transform(spark, scoring.read_stream(spark, src, "id long, t string"),
                              lambda d: d.select("id", clean_text("t").alias("t")), out)
    q.awaitTermination(120)
    got = {r["id"]: r["t"] for r in spark.read.parquet(out).collect()}
    assert got == {1: "hello world", 2: "naïve café"}


def test_blend_stream_static_join(spark):
    src = scratch_dir(spark, "scores-src")
    spark.createDataFrame([("a", 1, 0.2), ("b", 1, 0.4)], "model string, id long, score double").write.parquet(src)
    w = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "model string, w double")
    out = scratch_dir(spark, "scores-out")
    q = scoring.run_transform(spark, scoring.read_stream(spark, src, "model string, id long, score double"),
                              lambda d: scoring.blend_stream(d, w), out)
    q.awaitTermination(120)
    r = spark.read.parquet(out).agg((F.sum(F.col("w") * F.col("score")) / F.sum("w")).alias("s")).first()
    assert abs(r["s"] - 0.35) < 1e-12


def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (held.apply(k).getName() for k in range(held.size())) if n.startswith("shuffle_") and n.endswith(".data")}


def test_cut_lineage_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    made = cut_lineage(spark.range(5000).groupBy((F.col("id") % 50).alias("k")).count())
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert {r["k"]: r["count"] for r in made.collect()} == {k: 100 for k in range(50)}
    assert spark.conf.get(FILE_CLEANUP, None) == setting
