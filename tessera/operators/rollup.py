"""Child-to-parent rollup (#8, #19-20, #24-26).

All aggregates of the child table are computed in ONE ``groupBy(id)``. The reference builds five separate
group-bys and merges them; one aggregate means one shuffle, with partial (map-side) aggregation for the
sums, extrema and means, so a parent holding a third of all children still shuffles one partial row per
map task for the numeric columns. The ordered description concat is the one aggregate whose result grows
with the group: its output row is the whole joined text by definition. ``ordered_concat`` joins a hot parent's texts block by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def line_total(df: DataFrame, price: str = "price", quantity: str = "quantity",
               out: str = "total_price") -> DataFrame:
    """``total_price = price * quantity`` per child row."""
    return df.withColumn(out, F.col(price) * F.col(quantity))


def _money(c):
    # Prices carry two decimals; summing them as decimal keeps the sum exact and order-independent.
    return F.col(c).cast("decimal(18,2)")


def _listagg(sep: str, order: str) -> str:
    sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"listagg(description, '{sep_sql}') WITHIN GROUP (ORDER BY {order})"


def resource_rollup(resources: DataFrame, sep: str = "\n", key: str = "id", order: str = "seq", split: bool = False) -> DataFrame:
    """One row per parent: ordered description text, total price, unit-price extrema and mean, quantity.

    Descriptions are stringified first (a missing one becomes the text ``nan``) and joined in ``(seq,
    description)`` order; ``seq`` alone is not unique, so the description is the tie breaker. With ``split`` they are joined by
    :func:`ordered_concat`, for parents that may hold a large part of all children.
    """
    r = resources.select(key, order, F.coalesce(F.col("description").cast("string"), F.lit("nan"))
                         .alias("description"), "price", "quantity")
    numbers = [F.coalesce(F.sum(_money("price") * F.col("quantity").cast("decimal(18,2)")), F.lit(0))
               .cast("double").alias("total_price"),
               F.max("price").alias("max_price"),
               F.min("price").alias("min_price"),
               F.avg("price").alias("mean_price"),
               F.coalesce(F.sum(F.col("quantity").cast("decimal(18,2)")), F.lit(0)).cast("double")
               .alias("quantity")]
    if not split:
        return r.groupBy(key).agg(F.expr(_listagg(sep, f"{order}, description")).alias("description"), *numbers)
    texts = ordered_concat(r, sep, key, order).withColumnRenamed(key, "_key")
    sums = r.groupBy(key).agg(*numbers)
    return sums.join(texts, F.col(key).eqNullSafe(F.col("_key"))).select(key, "description", *[c for c in sums.columns if c != key])


def ordered_concat(df: DataFrame, sep: str = "\n", key: str = "id", order: str = "seq") -> DataFrame:
    """``(key, description)``: descriptions of each key joined in ``(order, description)`` order, in two levels.

    Rows are range-partitioned by key, order and description, so a key with a large part of all rows lies in several partitions, and each
    joins the rows of a key that it holds (a block). The few blocks of a key are then joined in order. Equal rows may lie on both sides of
    a boundary, but they are equal texts. No task sorts a whole key; only the joined text itself, the result, is one value.
    A null key is a group of its own; null descriptions don't count.
    """
    # Written, so that boundaries stay when a task is run again.
    placed = cut_lineage(df.select(key, order, "description").repartitionByRange(F.col(key), F.col(order), F.col("description"))
                         .withColumn("_block", F.spark_partition_id()))
    blocks = placed.groupBy(key, "_block").agg(F.expr(_listagg(sep, f"{order}, description")).alias("description"))
    return blocks.groupBy(key).agg(F.expr(_listagg(sep, "_block")).alias("description"))


def project_enrich(projects: DataFrame, rollup: DataFrame, key: str = "id") -> DataFrame:
    """Left join: every parent kept; rollup columns are null for a parent without children.

    No broadcast hint: the rollup has one row per parent and grows with the data. AQE turns the sort-merge
    join into a broadcast join at run time only when the measured rollup side is small.
    """
    return projects.join(rollup, key, "left")
