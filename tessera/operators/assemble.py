"""Selection, presence split and block assembly (#13-15, #22, #70)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import FeatureSet


def feature_select(df: DataFrame, fs: FeatureSet, key: str = "id", target: str | None = None) -> DataFrame:
    """One ``select`` of the key, the target when the frame has it, and the feature lists in order.
    Catalyst prunes every other column down to the scan."""
    cols = [key]
    if target and target in df.columns:
        cols.append(target)
    return df.select(*cols, *fs.columns())


def presence(col: str):
    """Present = not null and not empty (CSV turns an empty field into null, Parquet keeps '')."""
    return F.col(col).isNotNull() & (F.col(col) != "")


def split_by_presence(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``col`` is present, rows where it is absent). Both are filters of the same plan."""
    p = presence(col)
    return df.filter(p), df.filter(~p)


def assemble_blocks(key: str, blocks, spine: DataFrame | None = None, out: str = "features") -> tuple[DataFrame, list[str]]:
    """Bind feature blocks by key (never by row position) into one ``array<double>`` column.

    ``blocks`` is a list of ``(frame, [columns])`` or ``(frame, [columns], fill)``, each frame one row per key.
    Every key of ``spine`` (default: the first block) has a row; a block without that key gives its ``fill``
    (default null). Returns the assembled frame ``(key, features)`` and the slot names in order (block order,
    then column order). Blocks that are aggregates keyed by ``key`` are already hash-partitioned on it, so
    their joins reuse that partitioning.
    """
    df, names = (blocks[0][0] if spine is None else spine).select(key), []
    for frame, cols, *fill in blocks:
        part = frame.select(key, *[F.col(c).cast("double").alias(c) for c in cols], F.lit(True).alias("_has"))
        df = part.drop("_has") if spine is None and not names and not fill else df.join(part, key, "left")
        if fill:
            df = df.withColumns({c: F.when(F.col("_has"), F.col(c)).otherwise(F.lit(float(fill[0]))) for c in cols})
        df = df.drop("_has")
        names += list(cols)
    return df.select(key, F.array(*[F.col(c) for c in names]).alias(out)), names
