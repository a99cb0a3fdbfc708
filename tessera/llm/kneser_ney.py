"""Interpolated modified Kneser-Ney language model: counted by Spark, kept as sorted hash arrays, memory-mapped.

Training. Tasks hash words and n-grams to 64 bits with numpy, sum up what they have met and emit packed columns
for each shard of the key space; a shard is reduced by one task to its distinct n-grams and their counts. From
the distinct n-grams of an order come the statistics of its contexts and the continuation counts of the next
lower order, again as packed sums for each shard. Keys are hashes of whole n-grams, so a context or word that
a third of all tokens share is spread over all shards, and only sums for it meet in one. The number of shards
follows ``spark.sql.shuffle.partitions``.

Storage. A shard is one file in the shared folder (``spark.checkpoint.dir``): the sorted keys, then a column for
each value. Shards are ranges of the key, so a sorted batch of look-ups walks the files in order. Files have a
name of their own for each attempt, and only those that finished tasks report are used.

Scoring. Workers map the files (they must be mounted on all machines, as a shared folder is) and look up a
run of texts at a time; pages in use are shared by the workers of a machine. No shuffle.

Tokens are runs of other characters than ASCII white space after lower-casing A-Z, then one end token for each
text. Null and empty texts are just the end token. Repeated rows are scored, and counted, as often as they
occur. With nothing to learn from, every token has probability one over the vocabulary plus one, so 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import LOWER_BYTES, batch_of, id_remainder, packs, table
from tessera.llm.simhash import PIECE, SPACE
from tessera.session import cut_lineage, scratch_dir

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
END, START = U(0xE5D0_0000_0000_0001), U(0x57A7_0000_0000_0003)
FLUSH = 1_000_000
GRAMS, CONTEXTS, WORDS = 0, 1, 2
IS_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
ZSTD = pa.Codec("zstd", 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one-to-one."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def powers(n: int, held: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of BASE and of its inverse, at least ``n`` of each."""
    if len(held.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, x in (("up", BASE), ("down", BASE_INVERSE)):
            p = np.full(size, x, U)
            p[0] = 1
            held[name] = np.multiply.accumulate(p)
    return held["up"][:n], held["down"][:n]


def word_hashes(raw: bytes, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word, or of its first ``most`` bytes. A word's hash is a polynomial of its bytes,
    from differences of a running sum, and its length."""
    b = np.frombuffer(raw, np.uint8)
    gap = np.ones(len(b) + 2, bool)
    gap[1:-1] = IS_SPACE[b]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    first, stop = edge[::2], edge[1::2]
    if most:
        stop = np.minimum(stop, first + most)
    up, down = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, U)
    np.cumsum((b + U(1)) * up[:-1], out=total[1:])
    return mix(mix((total[stop] - total[first]) * down[first]) + (stop - first).astype(U)), first


def sequences(texts: list[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(tokens, at, row)`` for a run of texts: token hashes with ``order - 1`` tokens of context before each
    stretch, the places to predict, and the text that each belongs to. A long text comes in several stretches."""
    short, rows = [], []
    for k, t in enumerate(texts):
        raw = t.encode().translate(LOWER_BYTES)
        if len(raw) <= 2 * PIECE:
            short.append(raw)
            rows.append(k)
            continue
        before, at = np.full(order - 1, START, U), 0
        while at < len(raw):
            stop = len(raw)
            if at + PIECE < stop:
                gap = SPACE.search(raw, at + PIECE)
                stop = gap.start() if gap else stop
            words = [word_hashes(raw[at:stop])[0]]
            if stop == len(raw):
                words.append(np.array([END], U))
            seq = np.concatenate([before, *words])
            yield seq, np.arange(order - 1, len(seq)), np.full(len(seq) - order + 1, k)
            before, at = seq[len(seq) - (order - 1):], stop
    if short:
        hashes, first = word_hashes(b"\n".join(short))
        starts = np.cumsum([0, *[len(s) + 1 for s in short]])
        n = np.diff(np.searchsorted(first, starts))  # words of each text
        offset = np.cumsum([0, *(n + order)])  # contexts, words and end
        seq = np.full(offset[-1], START, U)
        owner = np.repeat(np.arange(len(short)), n)
        seq[np.arange(len(hashes)) + owner * order + order - 1] = hashes
        seq[offset[1:] - 1] = END
        at = np.ones(len(seq), bool)
        for k in range(order - 1):
            at[offset[:-1] + k] = False
        yield seq, np.flatnonzero(at), np.repeat(np.array(rows), n + 1)


def contexts(seq: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the contexts of the tokens at ``at``: of one word, of two, ... up to ``order - 1``."""
    return context_hashes([seq[at - k] for k in range(1, order)])


def context_hashes(back: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the contexts that the words before make, the nearest word first: of one word, of two, ..."""
    out, h = [], np.zeros(len(back[0]), U)
    for w in back:
        h = mix(h * BASE + w)
        out.append(h)
    return out


def gram(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * BASE + mix(word))


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct sorted keys, a row of each, and the sums of the values."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.int64)
    return k[first], order[first], [np.add.reduceat(v[order], first) if len(k) else v for v in values]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> U(32)) * U(shards)) >> U(32)


PACKED = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("level", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("n", T.IntegerType()),
                       T.StructField("columns", T.ArrayType(T.BinaryType()))])
PACKED_ARROW = pa.schema([("kind", pa.int32()), ("level", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("columns", pa.list_(pa.binary()))])


def packed(kind: int, level: int, keys: np.ndarray, columns: list[np.ndarray], shards: int) -> Iterator[list]:
    """A row for each shard that ``keys`` (sorted) reach, its columns compressed."""
    cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        # Sorted by their first column (a context or word that many rows share), columns compress best.
        part = np.argsort(columns[0][cuts[s]:cuts[s + 1]], kind="stable") + cuts[s]
        yield [kind, level, int(s), len(part), [ZSTD.compress(c[part].tobytes(), asbytes=True) for c in columns]]


def packed_grams(level: int, keys: np.ndarray, words: list[np.ndarray], n: np.ndarray, shards: int) -> Iterator[list]:
    """A row for each shard that ``keys`` (sorted) reach: its words once each, then for every n-gram the places of its words
    among them, the nearest before the last first and the last at the end, and its count. Hashes of contexts aren't sent:
    :func:`context_hashes` makes them from the words."""
    cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        mine = slice(cuts[s], cuts[s + 1])
        known, at, often = np.unique(np.concatenate([w[mine] for w in words]), return_inverse=True, return_counts=True)
        # Frequent words first: then most places are small numbers, and their upper bytes compress to little.
        by = np.argsort(-often, kind="stable")
        place = np.empty(len(by), place_kind(len(by)))
        place[by] = np.arange(len(by))
        places = place[at].reshape(len(words), -1)
        part = np.argsort(places[0], kind="stable")
        columns = [known[by], *[p[part].view(np.uint8).reshape(len(part), -1).T for p in places], n[mine][part]]
        yield [GRAMS, level, int(s), len(part), [np.uint32(len(known)).tobytes(), *[ZSTD.compress(c.tobytes(), asbytes=True) for c in columns]]]


def place_kind(words: int) -> type:
    return np.uint16 if words <= 1 << 16 else np.uint32


def unpacked_grams(rows: pa.Table, level: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The words of packed n-grams, a column for each place, and their counts."""
    out: list[list[np.ndarray]] = [[] for _ in range(level + 1)]
    for n, (size, known, *places, count_) in zip(rows.column("n").to_pylist(), rows.column("columns").to_pylist()):
        size = int(np.frombuffer(size, np.uint32)[0])
        kind = np.dtype(place_kind(size))
        known = np.frombuffer(ZSTD.decompress(known, size * 8, asbytes=True), U)
        for o, p in zip(out, places):
            planes = np.frombuffer(ZSTD.decompress(p, n * kind.itemsize, asbytes=True), np.uint8).reshape(kind.itemsize, n)
            o.append(known[np.ascontiguousarray(planes.T).view(kind)[:, 0]])
        out[-1].append(np.frombuffer(ZSTD.decompress(count_, n * 4, asbytes=True), np.uint32))
    *words, n = [np.concatenate(o) if o else np.empty(0, U) for o in out]
    return words, n


def unpacked(rows: pa.Table, kinds: list[type]) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for n, columns in zip(rows.column("n").to_pylist(), rows.column("columns").to_pylist()):
        for o, c, kind in zip(out, columns, kinds):
            o.append(np.frombuffer(ZSTD.decompress(c, n * np.dtype(kind).itemsize, asbytes=True), kind))
    return [np.concatenate(o) if o else np.empty(0, kind) for o, kind in zip(out, kinds)]


def batches(rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for r in rows:
        some.append(r)
        size += sum(map(len, r[4]))
        if size > 8 << 20:
            yield batch_of(PACKED_ARROW, list(zip(*some)))
            some, size = [], 0
    if some:
        yield batch_of(PACKED_ARROW, list(zip(*some)))


def count(docs: DataFrame, text: str, order: int, shards: int) -> DataFrame:
    """Packed n-grams of the highest order and packed words, with the counts of each task."""
    def flush(held: list) -> Iterator[list]:
        full, *words = [np.concatenate(c) for c in zip(*held)]
        word = words[-1]
        keys, rows, (n,) = summed(gram(full, word), np.ones(len(word), np.int64))
        yield from packed_grams(order, keys, [w[rows] for w in words], n.astype(np.uint32), shards)
        word, _, (n,) = summed(word, np.ones(len(word), np.int64))
        yield from packed(WORDS, 1, word, [word, n], shards)

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, size = [], 0
        for batch in source:
            for _, texts in packs([None] * batch.num_rows, batch.column(0).to_pylist(), 1_000_000):
                for seq, at, _ in sequences(texts, order):
                    back = [seq[at - k] for k in range(1, order)]
                    held.append([context_hashes(back)[-1], *back, seq[at]])
                    size += len(at)
                    if size > FLUSH:
                        yield from flush(held)
                        held, size = [], 0
        if held:
            yield from flush(held)

    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(lambda source: batches(rows(source)), PACKED)


def save(folder: str, columns: list[np.ndarray]) -> str:
    fs, path = pafs.FileSystem.from_uri(f"{folder}/{uuid.uuid4().hex}.arrays")
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        for c in columns:
            out.write(c.tobytes())
    return path


def occurrences(n: np.ndarray) -> list[int]:
    """How many n-grams occur once, twice, three and four times."""
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts of one, two and more; plain ones where the corpus is too small."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(found, (1, 2, 3))]


def discount(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


REPORT = T.StructType([*PACKED.fields, T.StructField("path", T.StringType()), T.StructField("stats", T.ArrayType(T.LongType()))])
REPORT_ARROW = pa.schema([*PACKED_ARROW, ("path", pa.string()), ("stats", pa.list_(pa.int64()))])


def reduce_grams(rows: DataFrame, level: int, folder: str, shards: int) -> DataFrame:
    """Store the distinct n-grams of a level. Returns a row for each file and, packed, the statistics of their
    contexts and the n-grams of the level below with the number of their distinct extensions."""
    def reduce(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        out = []
        w, n = unpacked(group.filter(pa.array(kind == WORDS)), [U, np.int64])
        if len(w):  # of the first level: summed up, they go on to reduce_words
            w, _, (n,) = summed(w, n)
            out += [[*r, None, None] for r in packed(WORDS, 1, w, [w, n], shards)]
        words, n = unpacked_grams(group.filter(pa.array(kind == GRAMS)), level)
        keys, first, (n,) = summed(gram(context_hashes(words[:-1])[-1], words[-1]), n.astype(np.int64))
        *back, word = [w[first] for w in words]
        ctx = context_hashes(back)
        large = n > 254
        path = save(folder, [keys, np.where(large, 255, n).astype(np.uint8), keys[large], n[large]])
        out.append([GRAMS, level, group.column("shard")[0].as_py(), len(keys), [], path, [int(large.sum()), *occurrences(n)]])
        c, _, stats = summed(ctx[-1], n, *[(n == k).astype(np.int64) for k in (1, 2)], (n > 2).astype(np.int64))
        out += [[*r, None, None] for r in packed(CONTEXTS, level, c, [c, *[s.astype(np.uint32 if k else np.int64) for k, s in enumerate(stats)]], shards)]
        if level > 2:
            k, first, (n,) = summed(gram(ctx[-2], word), np.ones(len(word), np.int64))
            out += [[*r, None, None] for r in packed_grams(level - 1, k, [*[w[first] for w in back[:-1]], word[first]], n.astype(np.uint32), shards)]
        else:
            w, _, (n,) = summed(word, np.ones(len(word), np.int64))
            out += [[*r, None, None] for r in packed(GRAMS, 1, w, [w, n.astype(np.uint32)], shards)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), REPORT_ARROW)], schema=REPORT_ARROW)

    return rows.groupBy("shard").applyInArrow(reduce, REPORT)


def reduce_contexts(rows: DataFrame, d: dict[int, list[float]], folder: str) -> DataFrame:
    """Store total and interpolation weight of every context of every level."""
    def reduce(group: pa.Table) -> pa.Table:
        level = group.column("level")[0].as_py()
        c, total, *n = unpacked(group, [U, np.int64, np.uint32, np.uint32, np.uint32])
        keys, _, (total, *n) = summed(c, total, *[x.astype(np.int64) for x in n])
        weight = sum(x * y for x, y in zip(d[level], n)) / total
        path = save(folder, [keys, total, weight.astype(np.float32)])
        out = [[CONTEXTS], [level], [group.column("shard")[0].as_py()], [len(keys)], [[]], [path], [[0]]]
        return pa.table([pa.array(x, f.type) for x, f in zip(out, REPORT_ARROW)], schema=REPORT_ARROW)

    return rows.groupBy("level", "shard").applyInArrow(reduce, REPORT)


def reduce_words(rows: DataFrame, folder: str) -> DataFrame:
    """Store every word's continuation count and its count in the text."""
    def reduce(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        word, n = unpacked(group.filter(pa.array(kind == WORDS)), [U, np.int64])
        after, m = unpacked(group.filter(pa.array(kind == GRAMS)), [U, np.uint32])
        keys, _, (n, m) = summed(np.concatenate([word, after]), np.concatenate([n, np.zeros(len(m), np.int64)]),
                                 np.concatenate([np.zeros(len(n), np.int64), m.astype(np.int64)]))
        path = save(folder, [keys, n, m.astype(np.uint32)])
        out = [[WORDS], [1], [group.column("shard")[0].as_py()], [len(keys)], [[]], [path], [[0, *occurrences(m), int(n.sum()), int(m.sum())]]]
        return pa.table([pa.array(x, f.type) for x, f in zip(out, REPORT_ARROW)], schema=REPORT_ARROW)

    return rows.groupBy("shard").applyInArrow(reduce, REPORT)


class Arrays:
    """Files of one kind and level, mapped when first needed."""

    def __init__(self, files: dict[int, tuple[str, int, int]], kinds: list[type], shards: int):
        self.files, self.kinds, self.shards, self.open = files, kinds, shards, {}

    def columns(self, shard: int) -> list[np.ndarray] | None:
        if shard not in self.open:
            if shard not in self.files or not self.files[shard][1]:
                return None
            path, n, large = self.files[shard]
            raw, at, out = np.memmap(path, np.uint8, "r"), 0, []
            for kind, size in zip(self.kinds, [n, n, large, large] if len(self.kinds) == 4 else [n, n, n]):
                out.append(np.frombuffer(raw, kind, size, at))
                at += size * np.dtype(kind).itemsize
            self.open[shard] = out
        return self.open[shard]

    def get(self, keys: np.ndarray, values: int) -> list[np.ndarray]:
        """Values of distinct sorted keys; 0 for unknown ones."""
        out = [np.zeros(len(keys), np.float64 if k == np.float32 else np.int64) for k in self.kinds[1 : 1 + values]]
        cuts = np.searchsorted(shard_of(keys, self.shards), np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            if (columns := self.columns(int(s))) is None:
                continue
            mine = keys[cuts[s]:cuts[s + 1]]
            at = np.minimum(np.searchsorted(columns[0], mine), len(columns[0]) - 1)
            hit = np.flatnonzero(columns[0][at] == mine)
            for o, c in zip(out, columns[1:]):
                o[cuts[s] + hit] = c[at[hit]]
            if len(columns) == 4 and len(columns[2]):  # counts over 254 stand apart
                many = cuts[s] + hit[columns[1][at[hit]] == 255]
                out[0][many] = columns[3][np.searchsorted(columns[2], keys[many])]
        return out


class Model:
    """What a worker needs: file names, discounts and totals. Files are mapped, not read."""

    def __init__(self, order: int, shards: int, reports: list, spent: dict[int, list[float]], words: list[int]):
        self.order, self.shards, self.d = order, shards, spent
        self.vocabulary, self.total, self.bigrams, *n = words
        self.spare = sum(d * k for d, k in zip(spent[1], [n[0], n[1], self.vocabulary - n[0] - n[1]])) / self.bigrams if self.bigrams else 1.0
        self.grams = {k: Arrays({r["shard"]: (r["path"], r["n"], r["stats"][0]) for r in reports if (r["kind"], r["level"]) == (GRAMS, k)},
                                [U, np.uint8, U, np.int64], shards) for k in range(2, order + 1)}
        self.contexts = {k: Arrays({r["shard"]: (r["path"], r["n"], 0) for r in reports if (r["kind"], r["level"]) == (CONTEXTS, k)},
                                   [U, np.int64, np.float32], shards) for k in range(2, order + 1)}
        self.words = Arrays({r["shard"]: (r["path"], r["n"], 0) for r in reports if r["kind"] == WORDS}, [U, np.int64, np.uint32], shards)

    def score(self, texts: list[str]) -> list[np.ndarray]:
        """Tokens, known tokens, log10 probability of the base and of the model for each text."""
        out = [np.zeros(len(texts), t) for t in (np.int64, np.int64, np.float64, np.float64)]
        for seq, at, row in sequences(texts, self.order):
            word, back = np.unique(seq[at], return_inverse=True)
            n, m = self.words.get(word, 2)
            base = np.log10((n + 0.1) / (self.total + 0.1 * (self.vocabulary + 1)))
            p = (m - discount(m, self.d[1])) / max(1, self.bigrams) + self.spare / (self.vocabulary + 1)
            p = p[back]
            for k, ctx in enumerate(contexts(seq, at, self.order), 2):
                keys, own = np.unique(gram(ctx, seq[at]), return_inverse=True)
                (c,) = self.grams[k].get(keys, 1)
                c = (c - discount(c, self.d[k]))[own]
                keys, own = np.unique(ctx, return_inverse=True)
                total, weight = (x[own] for x in self.contexts[k].get(keys, 2))
                known = total > 0
                p = np.where(known, c / np.maximum(total, 1) + weight * p, p)
            for o, v in zip(out, (None, (n > 0)[back], base[back], np.log10(p))):
                o += np.bincount(row, v, len(texts)).astype(o.dtype)
        return out


def train(spark: SparkSession, docs: DataFrame, text: str = "text", order: int = 2, shards: int | None = None) -> Model:
    """Count all of ``docs`` and store the model in the shared folder. The driver gets one row for each file."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    folder = scratch_dir(spark, "kneser-ney")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, words, reports, spent, ctx = count(docs, text, order, shards), None, [], {}, []
    for level in range(order, 1, -1):
        found = cut_lineage(reduce_grams(rows, level, folder, shards))
        if words is None:
            words = found.where(F.col("kind") == WORDS).drop("path", "stats")
        files = found.where("path is not null").drop("columns").collect()
        reports += files
        spent[level] = discounts(*[sum(r["stats"][k] for r in files) for k in (1, 2, 3, 4)])
        ctx.append(found.where(F.col("kind") == CONTEXTS).drop("path", "stats"))
        rows = found.where((F.col("kind") == GRAMS) & F.col("path").isNull()).drop("path", "stats")
    every = ctx[0]
    for c in ctx[1:]:
        every = every.unionByName(c)
    # Kept as tables: a task that ran again would store its shard under another name.
    reports += cut_lineage(reduce_contexts(every, spent, folder)).drop("columns").collect()
    words = cut_lineage(reduce_words(words.unionByName(rows), folder)).drop("columns").collect()
    total = [sum(r["stats"][k] for r in words) for k in range(1, 7)] if words else [0] * 6
    spent[1] = discounts(*total[:4])
    return Model(order, shards, reports + words, spent, [sum(r["n"] for r in words), total[4], total[5], total[0], total[1]])


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_tokens, n_known, base_score, score, perplexity)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # file names and totals
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("perplexity", T.DoubleType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            arrow = pa.schema([batch.schema.field(0), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())])
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 1_000_000):
                n, known, base, own = sent.value.score(texts)
                yield batch_of(arrow, [keys, n, known, base, own, 10 ** np.minimum(-own / n, 300)])

    return docs.select(F.col(id_col), F.col(text)).mapInArrow(run, schema)


def op1_kneser_ney(spark, sf_dir: str, order: int = 2) -> DataFrame:
    """Every document, scored by the model of the nine tenths that aren't held out. Registered at order 3."""
    docs = table(spark, sf_dir, "documents")
    fold = id_remainder(F.col("doc_id"), 10)
    model = train(spark, docs.where(fold.isNull() | (fold != 0)), order=order)
    return score(docs, model).select("doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                                     "base_score", "score", "perplexity")
