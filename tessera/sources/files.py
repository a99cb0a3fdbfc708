"""File scans and sinks (#1, #3-7).

CSV is read with an explicit schema (no inference pass), quoted multi-line fields and ``"`` escapes; an empty
field reads as null. Parquet is the default for everything this package writes itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import path_segment_label


def read_csv(spark: SparkSession, path: str, schema, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted text fields.

    ``multi_line=True`` accepts line breaks inside quoted fields (free text such as essays), but such a file
    cannot be split: it is read by one task. For large inputs keep many files, or convert them once to
    Parquet (:func:`write_parquet`) and read that; ``multi_line=False`` reads files split by byte ranges
    when no field holds a line break.
    """
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, one file per partition, quotes doubled inside fields (readable by :func:`read_csv`)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Stored embedding matrix ``(id, vec)``: aligned to other tables by ``id``, never by row position."""
    return spark.read.parquet(path)


def write_embeddings(df: DataFrame, path: str, key: str = "id", vec: str = "vec") -> None:
    write_parquet(df.select(key, vec), path)


def label_paths(df: DataFrame, path: str = "path", segment: int = -1, drop: int = 0) -> DataFrame:
    """Add ``stem`` (file name without extension) and ``label`` to a frame of paths.

    The label is the ``segment``-th '/'-separated piece of the path (1-based; negative counts from the end),
    with its first ``drop`` characters removed, lowercased; a missing piece gives null. A projection.
    """
    parts = F.split(F.col(path), "/")
    name = F.element_at(parts, -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    if segment < 0:
        piece = F.try_element_at(parts, F.lit(segment))
        label = F.lower(F.substring(piece, drop + 1, 1 << 30))
    else:
        label = path_segment_label(path, segment, drop)
    return df.withColumns({"stem": stem, "label": label})


def list_labelled(spark: SparkSession, root: str, glob: str = "*", segment: int = -1, drop: int = 0,
                  recursive: bool = True) -> DataFrame:
    """``(path, stem, label)`` for the files under ``root`` matching ``glob`` (see :func:`label_paths`).
    Only file metadata is read (the ``content`` column of the binary file source is pruned)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(root).select("path"))
    return label_paths(files, "path", segment, drop)


def attach_labels(listing: DataFrame, labels: DataFrame, key: str = "id", label_col: str = "breed") -> DataFrame:
    """Left join a file listing to a ``(key, label)`` table on the file stem (the key compared as text);
    every file is kept, ``class`` is null for a file without a label row."""
    lab = labels.select(F.col(key).cast("string").alias("stem"), F.col(label_col).alias("class"))
    return listing.join(lab, "stem", "left")
