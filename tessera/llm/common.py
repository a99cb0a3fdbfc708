"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate() table that lower-cases A-Z and leaves every other byte alone.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made of ``names`` that ``df`` doesn't have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as the contracts of several operators ask."""
    return F.translate(c, UPPER, LOWER)


def id_remainder(c: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``: the fold of a document."""
    return F.crc32(c.cast("string").cast("binary")) % mod


def packs(ids: list, texts: list, size: int = 2_000_000) -> Iterator[tuple[list, list]]:
    """Split a batch into runs of at most ``size`` characters (one longer text is a run of its own), so what
    a task holds at a time doesn't follow the batch's row count. Null texts come out empty."""
    a: list = []
    b: list = []
    n = 0
    for i, t in zip(ids, texts):
        t = t or ""
        if a and n + len(t) > size:
            yield a, b
            a, b, n = [], [], 0
        a.append(i)
        b.append(t)
        n += len(t)
    if a:
        yield a, b


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
