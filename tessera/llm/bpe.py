"""Byte-level BPE encoding and decoding in numpy.

Texts are cut by the tokenizer's pattern. The distinct pieces of a run of texts that the task has not met
before are encoded together: pieces of similar length become one padded matrix of ids, and in each round
every row merges its leftmost pair of minimum rank. Pair ranks come from an open-addressing hash table held
in two arrays; the column that a merge frees is squeezed out (each row loses exactly one), so the matrix
narrows by one per round, and rows without a pair left drop out.

There is no shuffle: a task streams Arrow batches, holds at most one run of texts, a bounded cache of pieces
and the pair table. Pieces over ``LONG`` bytes (a text without any break) go through a heap of pairs instead,
with the same order of merges, because a round per merge over such a row would take quadratic time.

Null and empty texts have no ids. Repeated rows give repeated rows, ids of any type pass through, and other columns of the
input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import batch_of, packs

NONE = np.int32(2**31 - 1)
LONG = 256
#: Lengths in bytes up to which pieces share a matrix.
BUCKETS = [*range(2, 33), 40, 48, 64, 96, 128, LONG]
CACHE_PIECES = 400_000
#: Texts over this many characters are cut into pieces as a stream.
LONG_TEXT = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> id of the joined token, as a vectorised open-addressing hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        k, v = np.array(keys, np.int64), np.array(values, np.int32)
        at = self._slot(k)
        while len(k):  # of the keys that want a free slot, the first gets it; the others try the next slot
            free = self.keys[at] == -1
            slots, first = np.unique(np.where(free, at, -1), return_index=True)
            first = first[slots >= 0]
            self.keys[at[first]], self.values[at[first]] = k[first], v[first]
            left = np.ones(len(k), bool)
            left[first] = False
            k, v, at = k[left], v[left], (at[left] + 1) & (len(self.keys) - 1)

    def _slot(self, k: np.ndarray) -> np.ndarray:
        h = k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is no such pair or either side is padding (-1)."""
        k = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at = self._slot(k)
        out = np.full(k.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        k, at = k[todo], at[todo]
        while len(todo):
            found = self.keys[at]
            hit = found == k
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (found != -1)
            todo, k, at = todo[go], k[go], (at[go] + 1) & (len(self.keys) - 1)
        return out


class ByteBPE:
    """Encoder and decoder over one set of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.cache: dict[str, list[int]] = {}

    def merge_matrix(self, m: np.ndarray) -> list[list[int]]:
        """Encode the rows of a matrix of byte ids, padded with -1 on the right."""
        out: list = [None] * len(m)
        rows = np.arange(len(m))
        rank = np.full(m.shape, NONE, np.int32)
        rank[:, :-1] = self.pairs.get(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(len(m), -1)
        while len(rows):
            at = rank.argmin(1)  # the first, so the leftmost, of the lowest
            best = rank[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for r, ids in zip(rows[done].tolist(), m[done].tolist()):
                    out[r] = ids[: ids.index(-1)] if ids[-1] == -1 else ids
                keep = ~done
                rows, m, rank, at, best = rows[keep], m[keep], rank[keep], at[keep], best[keep]
                if not len(rows):
                    break
            i = np.arange(len(rows))
            m[i, at] = best
            stay = np.ones(m.shape, bool)
            stay[i, at + 1] = False
            m, rank = m[stay].reshape(len(rows), -1), rank[stay].reshape(len(rows), -1)
            width = m.shape[1]
            after = np.where(at + 1 < width, m[i, np.minimum(at + 1, width - 1)], -1)
            rank[i, at] = self.pairs.get(best, after)
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.pairs.get(m[has, at[has] - 1], best[has])
        return out

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: lowest rank first, leftmost first among equals."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = [1] * n
        start = list(range(n + 1))  # byte offsets: ids[i] stands for piece[start[i]:start[i] + size[i]]
        ranks = self.ranks
        heap = [(r, i, 1, 1) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if size[i] == a else n
            if j >= n or size[j] != b or size[i] == 0:
                continue  # one side has been merged since
            ids[i], size[i], size[j] = r, a + b, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if left >= 0 and right < n:
                    r2 = ranks.get(piece[start[left] : start[right] + size[right]])
                    if r2 is not None:
                        heapq.heappush(heap, (r2, left, size[left], size[right]))
        return [ids[i] for i in range(n) if size[i]]

    def learn(self, pieces: set[str]) -> dict[str, list[int]]:
        """Ids of distinct pieces, by one matrix for each bucket of lengths."""
        out: dict[str, list[int]] = {}
        todo: list[tuple[int, str, bytes]] = []
        for p in pieces:
            raw = p.encode()
            if (whole := self.ranks.get(raw)) is not None:
                out[p] = [whole]
            elif len(raw) > LONG:
                out[p] = self.merge_long(raw)
            else:
                todo.append((len(raw), p, raw))
        todo.sort(key=lambda x: x[0])
        k = 0
        for width in BUCKETS:
            first = k
            while k < len(todo) and todo[k][0] <= width:
                k += 1
            for lo in range(first, k, 20_000):
                part = todo[lo : min(k, lo + 20_000)]
                flat = np.frombuffer(b"".join(x[2] for x in part), np.uint8)
                sizes = np.array([x[0] for x in part])
                m = np.full((len(part), width), -1, np.int32)
                m[np.arange(width) < sizes[:, None]] = self.of_byte[flat]
                out.update(zip((x[1] for x in part), self.merge_matrix(m)))
        return out

    def encode_pieces(self, pieces: list[list[str]]) -> list[list[int]]:
        cache = self.cache
        new = set(chain.from_iterable(pieces)).difference(cache)
        fresh = self.learn(new) if new else {}
        if len(cache) + len(fresh) > CACHE_PIECES:
            have = {p: cache[p] for p in set(chain.from_iterable(pieces)) - new}
            cache.clear()
            cache.update(have)
        known = cache | fresh if len(fresh) > CACHE_PIECES else cache
        if known is cache:
            cache.update(fresh)
        out = [list(chain.from_iterable(map(known.__getitem__, p))) for p in pieces]
        for p in [p for p in fresh if len(p) > 64]:
            cache.pop(p, None)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encode_pieces([self.pattern.findall(t) for t in texts])

    def encode_stream(self, text: str, pieces: int = 200_000) -> Iterator[list[int]]:
        """Ids of one long text, some pieces at a time."""
        found = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(found, pieces)):
            yield self.encode_pieces([some])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def coder(raw: bytes, pattern: str, held: dict = {}) -> ByteBPE:  # noqa: B006
    """The coder of this worker; built once for each rank file."""
    key = (hashlib.sha256(raw).digest(), pattern)
    if key not in held:
        held.clear()
        held[key] = ByteBPE({base64.b64decode(t): int(r) for t, r in (x.split() for x in raw.splitlines() if x.strip())}, pattern)
    return held[key]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id",
           ids: bool = True, digests: bool = True) -> DataFrame:
    """``(id_col, n_tokens, ids array<int>, ids_sha256, decoded_sha256)`` for every row; ``ids`` and ``digests``
    choose the columns. The rank file (bounded by its vocabulary) is sent to the workers as bytes, so only the
    driver needs its path."""
    with open(ranks_path, "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(raw.value, pattern)
        said = [str(i) for i in range(len(bpe.tokens))]
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("n_tokens", pa.int64()), *[("ids", pa.list_(pa.int32()))] * ids,
                                *[("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] * digests])
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
                    rows = [bpe.encode_stream(texts[0])]
                else:
                    rows = ([x] for x in bpe.encode(texts))
                n, kept, a, b = [], [], [], []
                for parts in rows:
                    count, own = 0, []
                    h, d = hashlib.sha256(), hashlib.sha256()
                    for part in parts:
                        if digests and part:
                            h.update(((b"," if count else b"") + ",".join(map(said.__getitem__, part)).encode()))
                            d.update(bpe.decode(part))
                        count += len(part)
                        if ids:
                            own.append(np.array(part, np.int32))
                    n.append(count)
                    kept.append(np.concatenate(own) if own else np.empty(0, np.int32))
                    a.append(h.hexdigest())
                    b.append(d.hexdigest())
                yield batch_of(schema, [keys, n, *[kept] * ids, *[a, b] * digests])

    return df.select(F.col(id_col), F.col(text)).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, decoded binary)``: the bytes that the ids stand for (null ids: null)."""
    with open(ranks_path, "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(raw.value, "")
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("decoded", pa.binary())])
            rows = batch.column(1)
            for lo in range(0, batch.num_rows, 500):
                part = [None if x is None else bpe.decode(x) for x in rows[lo : lo + 500].to_pylist()]
                yield batch_of(schema, [batch.column(0)[lo : lo + 500].to_pylist(), part])

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("decoded", T.BinaryType())]
    return df.select(F.col(id_col), F.col(ids)).mapInArrow(run, T.StructType(fields))


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded with the multilingual byte-level vocabulary."""
    import public_tokenizers

    from tessera.llm.common import table
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                  public_tokenizers.PATTERN, ids=False)
