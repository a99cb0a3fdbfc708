"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

A document's fingerprint is 64 bits wide; a bit is set when it is set in over half of the hashes of the
document's word shingles. Fingerprints link when they differ in at most ``radius`` bits.

Distinct fingerprints are compared once, whatever the number of documents that share one. They are grouped by
the population counts of their four 16-bit quarters: two fingerprints within the radius differ by at most
that radius in the sum of the four count differences, so only such groups meet, and all other tile pairs are
skipped without loss. A large group is cut into tiles of about ``TILE`` fingerprints. Spark deals the tile
pairs; each is compared by exclusive-or and bit counts over a numpy matrix, and yields a spanning forest of
its links rather than all of them. Connected components over those links give the classes.

Null and empty texts (and those of white space only) have no words and the fingerprint zero, linked like any
other. Rows that repeat an id count as the same document and get the same answer. A group whose ids are all
null has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import LOWER_BYTES, batch_of, table
from tessera.llm.components import components
from tessera.session import cut_lineage

TILE = 1024
PIECE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``PIECE`` bytes at a time, so a very long text isn't split at once."""
    at = 0
    while at < len(raw):
        stop = len(raw)
        if at + PIECE < stop:
            gap = SPACE.search(raw, at + PIECE)
            stop = gap.start() if gap else stop
        if words := raw[at:stop].split():
            yield words
        at = stop


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    ones, n = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    for words in word_pieces((text or "").encode().translate(LOWER_BYTES)):
        words = tail + words
        tail = words[-(shingle - 1):] if shingle > 1 else []
        grams = [words[k:] for k in range(shingle)]
        hashes = [xxhash.xxh64_intdigest(b" ".join(g), seed) for g in zip(*grams)]
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(0, dtype=np.int64)
            n += len(hashes)
    if not n and tail:  # fewer words than a shingle
        h = np.array([xxhash.xxh64_intdigest(b" ".join(tail), seed)], "<u8")
        ones, n = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id_col, fingerprint long)`` for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("fingerprint", pa.int64())])
            prints = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            yield batch_of(schema, [batch.column(0).to_pylist(), prints])

    kinds = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("fingerprint", T.LongType())]
    return df.select(F.col(id_col), F.col(text)).mapInArrow(run, T.StructType(kinds))


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest between the fingerprints of two tiles (``same``: of one tile with itself)."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if not len(i):
        return a[:0], a[:0]
    every = a if same else np.concatenate([a, b])
    j = j if same else j + len(a)
    label = np.arange(len(every))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(every)))
    return every[label[moved]], every[moved]


def links(prints: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """``(a, b)``: links that connect the distinct fingerprints in ``prints(fingerprint)`` as all pairs within
    ``radius`` bits would."""
    quarters = [F.bit_count(F.shiftrightunsigned("fingerprint", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    cell = sum((q.cast("long") * 32**k for k, q in enumerate(quarters)), F.lit(0).cast("long"))
    own = prints.select("fingerprint", cell.alias("cell"))
    # One row for each combination of the four counts, at most 17**4.
    cells = cut_lineage(own.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks")))
    tiles = cut_lineage(own.join(F.broadcast(cells), "cell")
                        .withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
                        .groupBy("cell", "block").agg(F.array_sort(F.collect_list("fingerprint")).alias("prints")))
    # A group meets itself and, of the groups within the radius, those with the larger counts in the first
    # place that differs, so each pair of groups once. Counts stay under 32, so no step carries.
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    ok = [F.array(*[F.lit(x) for x in s]) for s in steps]
    places = [F.shiftright("cell", 5 * k).bitwiseAND(F.lit(31)) for k in range(4)]
    there = tiles.select("cell", "block", F.explode(F.array(*ok)).alias("step"))
    inside = [(p + F.get("step", F.lit(k))).between(0, 16) for k, p in enumerate(places)]
    other = sum((F.get("step", F.lit(k)).cast("long") * 32**k for k in range(4)), F.col("cell"))
    there = there.where(inside[0] & inside[1] & inside[2] & inside[3]).select("cell", "block", other.alias("cell2"))
    meet = there.join(F.broadcast(cells.select(F.col("cell").alias("cell2"), "blocks")), "cell2")
    meet = meet.select("cell", "block", "cell2", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block2"))
    meet = cut_lineage(meet.where("cell <> cell2 or block <= block2"))
    second = tiles.select(F.col("cell").alias("cell2"), F.col("block").alias("block2"), F.col("prints").alias("prints2"))
    both = meet.join(tiles, ["cell", "block"]).join(second, ["cell2", "block2"])
    both = both.select("prints", "prints2", F.expr("cell = cell2 and block = block2").alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            left, right = [], []
            for x, y, same in zip(batch.column(0), batch.column(1), batch.column(2)):
                a, b = forest(x.values.to_numpy(), y.values.to_numpy(), radius, same.as_py())
                left.append(a)
                right.append(b)
            if left:
                yield batch_of(schema, [np.concatenate(left), np.concatenate(right)])

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, radius: int = 2,
                    seed: int = 42, tile: int = TILE) -> DataFrame:
    """``(id_col, fingerprint string, component_id)`` for every row: 16 lower-case hex digits, and the smallest
    id that a chain of links reaches, the row's own included."""
    prints = cut_lineage(fingerprints(df, text, id_col, shingle, seed).withColumnRenamed(id_col, "id"))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    found = components(links(distinct, radius, tile)).withColumnRenamed("node", "fingerprint")
    classed = cut_lineage(distinct.join(found, "fingerprint", "left")
                          .select("fingerprint", "first", "n", F.coalesce("component", "fingerprint").alias("component")))
    # Only classes of several documents need a look-up; a document alone is its own class.
    first = classed.groupBy("component").agg(F.min("first").alias("component_id"), F.sum("n").alias("size")).where("size > 1")
    first = cut_lineage(first)
    shared = cut_lineage(classed.join(first, "component").select("fingerprint", "component_id"))
    return (prints.join(shared, "fingerprint", "left")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                    F.coalesce("component_id", "id").alias("component_id")))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document: 3-word shingles, two differing bits at most."""
    return near_duplicates(table(spark, sf_dir, "documents"))
