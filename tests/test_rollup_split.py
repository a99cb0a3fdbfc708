"""The two-level ordered concat: same rows as the plain one, with a parent that holds a third of all children."""

from pyspark.sql import functions as F

from tessera.operators import rollup


def children(spark, n=6000):
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("id"), (F.col("id") * 7919 % 1000).alias("seq"),
                               F.when(F.col("id") % 11 != 0, F.concat(F.lit("d"), (F.col("id") % 40).cast("string"))).alias("description"),
                               F.lit(1.5).alias("price"), F.lit(2).alias("quantity"))
    return df.unionByName(df.limit(5).withColumn("id", F.lit(None).cast("long")))


def test_same_rows_as_the_plain_rollup(spark):
    df = children(spark)
    plain = sorted(map(tuple, rollup.resource_rollup(df).collect()), key=str)
    split = rollup.resource_rollup(df, split=True)
    assert sorted(map(tuple, split.collect()), key=str) == plain
    assert split.columns == rollup.resource_rollup(df).columns
    assert rollup.resource_rollup(df.where("false"), split=True).count() == 0


def test_hot_parent_lies_in_several_blocks(spark, monkeypatch):
    seen = []
    cut = rollup.cut_lineage
    monkeypatch.setattr(rollup, "cut_lineage", lambda d: seen.append(cut(d)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rollup.resource_rollup(children(spark), split=True).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = {r["_block"]: r["n"] for r in seen[0].where("id = 7").groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) >= 3 and max(sizes.values()) < 1600 < sum(sizes.values())
