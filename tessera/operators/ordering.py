"""Distributed dense row numbers over a total order.

``Window.orderBy`` without a partition key moves every row into one task. Here the rows are range-sorted
across all partitions, each row gets its partition id and its position within the partition, and a table
of per-partition counts (one row per partition, so bounded by the partition count and safe to broadcast)
turns that into a global row number.

The tagged frame is written to the shared checkpoint folder before it is used twice, so both uses
see the same partition boundaries even if an executor is lost and a stage is recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import lookup_join
from tessera.session import cut_lineage

#: Bytes of text in a partition of :func:`co_locate_texts`.
TEXT_BYTES = 4 << 20


def global_row_number(df: DataFrame, order_cols: list, out: str = "rn") -> DataFrame:
    """Add ``out`` = 1..n following ``order_cols`` (which must form a total order for determinism)."""
    s = (df.orderBy(*order_cols)
         .withColumn("_rn_p", F.spark_partition_id())
         .withColumn("_rn_m", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    counts = s.groupBy("_rn_p").agg(F.count(F.lit(1)).alias("_rn_n"), F.min("_rn_m").alias("_rn_m0"))
    before = Window.orderBy("_rn_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rn_p", "_rn_m0", F.coalesce(F.sum("_rn_n").over(before), F.lit(0)).alias("_rn_off"))
    return (s.join(F.broadcast(offsets), "_rn_p")
            .withColumn(out, (F.col("_rn_off") + F.col("_rn_m") - F.col("_rn_m0") + 1).cast("long"))
            .drop("_rn_p", "_rn_m", "_rn_m0", "_rn_off"))


def dense_index_within(df: DataFrame, group: str, order_cols: list, out: str = "index") -> DataFrame:
    """0-based index of each row within its ``group`` following ``order_cols``, without putting a whole
    group into one task: a global row number minus the group's first row number (one row per group)."""
    ranked = global_row_number(df, [group, *order_cols], out="_g_rn")
    first = ranked.groupBy(group).agg(F.min("_g_rn").alias("_g_first"))
    # One row per group, size-checked and broadcast: a shuffle join on the group key would send every row
    # of a large group (all values of one high-cardinality feature) to one task.
    return (lookup_join(ranked, first, group, spread="_g_rn")
            .withColumn(out, (F.col("_g_rn") - F.col("_g_first")).cast("int"))
            .drop("_g_rn", "_g_first"))


def co_locate(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition rows by ``keys`` ahead of work that multiplies rows per key and then aggregates per key
    (tokens exploded from a document, then counted per document).

    Shuffling the compact input once (one row per document) replaces shuffling the exploded rows, which are
    several times larger; every later step keyed by the same columns (aggregate, per-key window, join back
    to the keys) then runs inside its partition. Spark drops this exchange when the input is already
    partitioned on the keys, e.g. the output of an aggregate keyed the same way. Rows are unique per key
    here (a document is one row), so no partition receives more than its share of keys.
    """
    return df.repartition(*keys)


def co_locate_texts(df: DataFrame, key: str, *texts: str) -> DataFrame:
    """:func:`co_locate` for texts that are exploded next: as many partitions as the texts, measured, hold ``TEXT_BYTES``. What a task holds for its tokens
    is then the same for any corpus (a text is one row, whatever its length), where partitions merged by the size of the compact rows would hold
    many times as much, and fewer tasks than cores would work."""
    total = df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0).cast("long"))).alias("b")).first()["b"] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1 + int(total) // TEXT_BYTES), key)


def global_running_sum(df: DataFrame, order_cols: list, value: str, out: str = "cum") -> DataFrame:
    """Add ``out`` = the sum of ``value`` over all rows up to and including this one in ``order_cols`` order
    (which must form a total order). Same plan as :func:`global_row_number`: range-sorted partitions,
    written to the shared folder; a running sum inside each partition (a window per partition id, so one partition's rows per
    task); and per-partition totals turned into offsets (one row per partition, broadcast)."""
    s = (df.orderBy(*order_cols)
         .withColumn("_rs_p", F.spark_partition_id())
         .withColumn("_rs_m", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    within = Window.partitionBy("_rs_p").orderBy("_rs_m").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_rs_in", F.sum(value).over(within))
    totals = s.groupBy("_rs_p").agg(F.sum(value).alias("_rs_t"))
    before = Window.orderBy("_rs_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_rs_p", F.coalesce(F.sum("_rs_t").over(before), F.lit(0)).alias("_rs_off"))
    return (s.join(F.broadcast(offsets), "_rs_p")
            .withColumn(out, F.col("_rs_off") + F.col("_rs_in"))
            .drop("_rs_p", "_rs_m", "_rs_in", "_rs_off"))
