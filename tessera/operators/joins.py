"""Lookup joins against dimension-like tables whose size is not known in advance.

A fact stream of tokens is heavily skewed on the join key (a few words make up a large share of all
tokens), and a dimension table such as a lexicon or a vocabulary grows with the corpus. So:

* the dimension is broadcast only after its row count and its byte size are measured against a row limit
  and a byte budget (one partially aggregated pass over the table, which callers write before they ask);
* otherwise the keys of the facts are counted, and those that hold more than one part in ``HOT_PARTS`` of them are
  looked up by broadcast: there are at most ``HOT_PARTS`` of those, whatever the corpus. The other facts, none of whose
  keys is frequent, are shuffled by key and ``SALT`` salts, so that the dimension is sent as often as there are salts;
* where not even the frequent keys' rows may be broadcast, all facts are salted by a hash of a spreading column and the
  dimension rows replicated once per shuffle partition, so one hot key is split over all tasks instead of one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20

#: A key is frequent if it holds more than one part in this many of the facts.
HOT_PARTS = 1_000_000
#: Salts of the keys that aren't.
SALT = 2


# Fixed-width types: bytes per value (an in-memory row also carries a null bitmap and offsets, counted
# as a flat 16 bytes per row).
_FIXED_BYTES = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
                T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
                T.DecimalType: 16}


def _value_bytes(c, t) -> "F.Column":
    """Bytes a value of type ``t`` in column expression ``c`` occupies (0 for null)."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(t, T.ArrayType) and type(t.elementType) in _FIXED_BYTES:
        return F.coalesce(F.size(c), F.lit(0)) * _FIXED_BYTES[type(t.elementType)] + 16
    if isinstance(t, T.ArrayType):
        return F.coalesce(F.aggregate(c, F.lit(0).cast("long"),
                                      lambda acc, x: acc + _value_bytes(x, t.elementType)), F.lit(0)) + 16
    if isinstance(t, T.StructType):
        return sum((_value_bytes(c[f.name], f.dataType) for f in t.fields), F.lit(0)) + 8
    if isinstance(t, T.MapType):
        return F.coalesce(F.size(c), F.lit(0)) * 32 + 16
    if isinstance(t, T.UserDefinedType):  # ml vectors: measured through their array form
        from pyspark.ml.functions import vector_to_array
        return F.coalesce(F.size(vector_to_array(c)), F.lit(0)) * 8 + 16
    return F.lit(_FIXED_BYTES.get(type(t), 8))


def measured_size(df: DataFrame) -> tuple[int, int]:
    """``(rows, bytes)`` of ``df``: sums combined in each task, so one row per task is shuffled. A limit would send
    the rows themselves to a single task."""
    width = sum((_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def broadcastable(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows holding at most ``max_bytes`` bytes, measured on the
    data itself."""
    if max_rows <= 0 or max_bytes <= 0:
        return False
    n, b = measured_size(dim)
    return n <= max_rows and b <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner",
                spread: str | None = None, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                salt: int | None = None, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Equi-join ``facts`` to ``dim`` (``how`` in inner/left), robust to hot keys on the fact side.

    ``spread`` names a fact column with many distinct values (e.g. the document id) used to salt; without it
    the salt is a hash of the whole fact row. Either way the salt is a pure function of the row, so a task
    recomputed after a lost executor sends every row to the same place as before (a random salt would not).
    """
    keys = [on] if isinstance(on, str) else list(on)
    if broadcastable(dim, max_broadcast_rows, max_broadcast_bytes):
        return facts.join(F.broadcast(dim), keys, how)
    if salt is None:
        found = _frequent(facts, dim, keys, max_broadcast_rows, max_broadcast_bytes)
        if found is not None:
            return _in_two(facts, dim, keys, how, spread, *found)
    # As many salts as shuffle partitions: a key with any share of the rows can reach every task.
    return _salted(facts, dim, keys, how, spread, salt or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _salted(facts: DataFrame, dim: DataFrame, keys: list[str], how: str, spread: str | None, salt: int) -> DataFrame:
    spread_cols = [F.col(spread)] if spread else [F.col(c) for c in facts.columns]
    f = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_cols), F.lit(salt)).cast("int"))
    d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return f.join(d, keys + ["_salt"], how).drop("_salt")


def _null_key(keys: list[str]) -> "F.Column":
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _frequent(facts: DataFrame, dim: DataFrame, keys: list[str], max_rows: int, max_bytes: int) -> tuple[DataFrame, DataFrame] | None:
    """The frequent keys of ``facts`` and their rows of ``dim``, both written; None where those may not be broadcast."""
    counts = cut_lineage(facts.where(~_null_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n").alias("n")).first()["n"] or 0
    parts = min(HOT_PARTS, max_rows)
    while parts >= 1:
        often = cut_lineage(counts.where(F.col("_n") * parts > total).select(*keys))
        rows = cut_lineage(dim.join(F.broadcast(often), keys, "left_semi"))
        if broadcastable(rows, max_rows, max_bytes):
            return often, rows
        parts //= 10
    return None


def _in_two(facts: DataFrame, dim: DataFrame, keys: list[str], how: str, spread: str | None, often: DataFrame, rows: DataFrame) -> DataFrame:
    """Facts of frequent keys with their rows, and the others by shuffle."""
    rare = _salted(facts.where(~_null_key(keys)).join(F.broadcast(often), keys, "left_anti"), dim, keys, how, spread, SALT)
    if how == "inner":
        return facts.join(F.broadcast(rows), keys).unionByName(rare)
    # A null key finds nothing, and would all be sent to one task.
    known = often.join(rows, keys, "left").withColumn("_often", F.lit(True))
    kept = facts.join(F.broadcast(known), keys, "left").where(F.col("_often").isNotNull() | _null_key(keys)).drop("_often")
    return kept.unionByName(rare)
