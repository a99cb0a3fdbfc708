"""Prefix trie of conversations.

Conversations that begin with the same turns share the nodes of a trie. A turn stands as two 64-bit hashes of role and
text (128 bits) with its length, so texts are hashed where they are read and never shuffled.

1. Turns are gathered by conversation, in order, and every conversation is rebuilt from the first turns of its base and its own rest;
   one shuffle by the base's id serves both.
2. Conversations with the same turns become one class: tasks that hold a range of ids make a block of each class's ids, the blocks of a class
   are read in order as a stream, and a running SHA-256 takes them in. However many members a class has, a task holds one batch of blocks.
3. Classes are dealt into shards by ranges of their turn sequences. In a shard, turns get dense ids, rows become padded matrices of ``WIDTH`` turns (rows that
   go on come back in the next matrix, so padding stays below ``WIDTH`` turns a row), numpy lexsort orders them, change masks accumulated by OR
   from column to column mark where a node of each depth starts, and reduceat sums up the rows of each node. Sums over subtrees go
   up depth by depth.
4. Only nodes on the paths of a shard's first and last row can reach into another shard. Their partial sums are recombined by the digest of their path,
   and their tree, at most two paths for each shard, is summed up in one task; nodes below learn their parent's id from it.

A shard holds about ``SHARD_TURNS`` turns (their number follows the count of turns), unless a single conversation is longer: one conversation is one row.

Results: rows without a conversation id take no part; null roles and texts are empty; null turns come first, equal turn numbers go by the
hash of the turn, and repeated rows are turns of their own. Conversations left without a turn end at the root. An empty table has no
nodes. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import table
from tessera.llm.importance import CRC_SQL, crc_of
from tessera.operators.joins import lookup_join
from tessera.session import cut_lineage

WIDTH, SHARD_TURNS, BLOCK_ROWS = 16, 400_000, 100_000
NOTHING = hashlib.sha256(b"").hexdigest()
PATH = "array<struct<a:bigint,b:bigint,n:int>>"


def rebuilt(convs: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """``(conv_id, path)``: for conversation c the first ``crc32(c) % heads`` turns of conversation ``c - c % group``, then its own turns from there on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = convs.where("conv_id is not null").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        F.struct("turn", F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), F.char_length(text).alias("n")).alias("t"))
    own = turns.repartition("base").groupBy("base", "conv_id").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("own"))
    # A base has at most 2 * group conversations, whose rows are in one partition already.
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumn("h", h).withColumn("first", F.coalesce(first, F.array().cast(PATH)))
    return both.select("conv_id", F.concat(F.slice("first", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))).alias("path"))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins among sorted rows."""
    change = np.zeros(max(0, len(keys[0]) - 1), bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.flatnonzero(np.concatenate([[True], change])) if len(keys[0]) else np.empty(0, np.int64)


def classes(convs: DataFrame) -> DataFrame:
    """``(path, conv_id, n_convs, ends_sha256)``: the distinct turn sequences, their smallest member, how many they are, and the digest of their ids."""
    spark = convs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = convs.select("conv_id", F.xxhash64("path").alias("ka"), F.xxhash64(F.lit(1), "path").alias("kb"), "path")
    ranges = cut_lineage(keyed).repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            ids, ka, kb = (t.column(c).to_numpy() for c in ("conv_id", "ka", "kb"))
            order = np.lexsort((ids, kb, ka))
            start = _starts(ka[order], kb[order])
            said = [str(i) for i in ids[order].tolist()]
            ends = [*start[1:].tolist(), len(order)]
            joined = [",".join(said[a:b]) for a, b in zip(start.tolist(), ends)]
            firsts = t.take(pa.array(order[start]))
            out = pa.table([firsts.column("ka"), firsts.column("kb"), firsts.column("conv_id"), pa.array(np.diff([*start, len(order)]), pa.int64()),
                            pa.array(joined, pa.string()), firsts.column("path")], names=["ka", "kb", "conv_id", "n_convs", "ids", "path"])
            yield from out.combine_chunks().to_batches(max_chunksize=10_000)

        for batch in batches:  # in the order of ids, so the blocks of a class follow one another
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield from flush()
                held, rows = [], 0
        if rows:
            yield from flush()

    blocks = ranges.mapInArrow(block, f"ka long, kb long, conv_id long, n_convs long, ids string, path {PATH}")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, count, first = None, None, 0, None  # of the class that is being read; ``first``: its first row

        def close(rows: list[tuple]) -> pa.RecordBatch:
            t = pa.Table.from_batches([r for r, _, _ in rows])
            return pa.table([t.column("path"), t.column("conv_id"), pa.array([c for _, c, _ in rows], pa.int64()), pa.array([d for _, _, d in rows], pa.string())],
                            names=["path", "conv_id", "n_convs", "ends_sha256"]).combine_chunks().to_batches()[0]

        for batch in batches:
            done = []
            for k, (ka, kb, c, ids) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("ka", "kb", "n_convs", "ids")))):
                if key != (ka, kb):
                    if key is not None:
                        done.append((first, count, sha.hexdigest()))
                    key, sha, count, first = (ka, kb), hashlib.sha256(), 0, batch.slice(k, 1)
                else:
                    sha.update(b",")
                sha.update(ids.encode())
                count += c
            if done:
                yield close(done)
        if key is not None:
            yield close([(first, count, sha.hexdigest())])

    dealt = blocks.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "conv_id")
    return dealt.mapInArrow(digest, f"path {PATH}, conv_id long, n_convs long, ends_sha256 string")


class Level:
    """The nodes of one depth in a shard."""

    def __init__(self, parent, conv, count, length, end, shared):
        self.parent, self.conv, self.count, self.length, self.end, self.shared = parent, conv, count, length, end, shared


def levels(ids: np.ndarray, start: np.ndarray, size: np.ndarray, length: np.ndarray, conv: np.ndarray, count: np.ndarray, width: int = WIDTH) -> tuple[list[Level], int, int]:
    """Nodes by depth (the root first) of distinct rows ``ids[start:start + size]``, and the rows that come first and last. ``ids``: turn ids from 1;
    ``shared`` nodes lie on the path of the first or the last row, ``end`` is the row that ends at a node or -1."""
    rows, group = np.arange(len(size)), np.zeros(len(size), np.int64)
    none = np.flatnonzero(size == 0)
    out = [Level(np.zeros(1, np.int64), conv.min(keepdims=True), count.sum(keepdims=True), np.zeros(1, np.int64), none[:1] if len(none) else np.array([-1]), np.ones(1, bool))]
    head = tail = True  # whether the first (last) row of all is still among ``rows``
    ends, base = [-1, -1], 0
    while len(rows):
        here = np.minimum(np.maximum(size[rows] - base, 0), width)
        m = np.zeros((len(rows), width), np.int64)
        spot = np.arange(width) < here[:, None]
        m[spot] = ids[(start[rows] + base)[:, None].repeat(width, 1)[spot] + np.arange(width)[None, :].repeat(len(rows), 0)[spot]]
        goes_on = size[rows] > base + width
        order = np.lexsort((goes_on, *(m[:, j] for j in range(width - 1, -1, -1)), group))
        rows, group, m, here, goes_on = rows[order], group[order], m[order], here[order], goes_on[order]
        if head and not goes_on[0]:
            ends[0] = rows[0]
        if tail and not goes_on[-1]:
            ends[1] = rows[-1]
        mask = np.concatenate([[True], group[1:] != group[:-1]])
        node = group  # the node of the depth before, for each row
        for j in range(width):
            if not (here > j).any():
                break
            mask = mask | np.concatenate([[True], m[1:, j] != m[:-1, j]])
            first = np.flatnonzero(mask)
            real = m[first, j] > 0
            run = np.cumsum(mask) - 1
            place = np.cumsum(real) - 1
            shared = np.zeros(len(first), bool)
            if head and here[0] > j:
                shared[0] = True
            if tail and here[-1] > j:
                shared[-1] = True
            at = first[real]
            r = rows[at]
            out.append(Level(node[at], np.minimum.reduceat(conv[rows], first)[real], np.add.reduceat(count[rows], first)[real],
                             length[start[r] + base + j], np.where(size[r] == base + j + 1, r, -1), shared[real]))
            node = np.where(real[run], place[run], 0)
        head, tail = head and bool(goes_on[0]), tail and bool(goes_on[-1])
        rows, group, base = rows[goes_on], node[goes_on], base + width
    return out, int(ends[0]), int(ends[1])


NODES = ("key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string, length long")
TYPES = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
NODE_SCHEMA = pa.schema([(n, TYPES[t]) for n, t in (c.split() for c in NODES.split(", "))])


def path_keys(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """Digests of the first 0, 1, 2, ... turns of a path."""
    h = hashlib.md5(usedforsecurity=False)
    out = [h.digest()]
    for x in np.column_stack([a, b]).astype("<i8"):
        h.update(x.tobytes())
        out.append(h.digest())
    return out


def shard_nodes(paths: pa.Array, conv: np.ndarray, count: np.ndarray, ends: list) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard. Those that lie in it alone are complete but for a shared parent's id; shared ones (``key`` set) come with what the complete ones below
    them add up to."""
    offsets = paths.offsets.to_numpy().astype(np.int64)
    values = paths.values
    a, b, n = (values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    start, size = offsets[:-1], np.diff(offsets)
    order = np.lexsort((b, a))
    new = np.zeros(len(a), np.int64)
    new[_starts(a[order], b[order])] = 1
    ids = np.empty(len(a), np.int64)
    ids[order] = np.cumsum(new)
    found, first, last = levels(ids, start, size, n, conv, count)
    keys = [path_keys(a[start[r] : start[r] + size[r]], b[start[r] : start[r] + size[r]]) for r in (first, last)]
    children = leaves = saved = None  # of the depth below, summed up by parent
    batches = []
    for d in range(len(found) - 1, -1, -1):
        x = found[d]
        k = len(x.conv)
        zero = np.zeros(k, np.int64)
        n_children, n_leaves, n_saved = (zero if v is None else v for v in (children, leaves, saved))
        own = ~x.shared
        n_leaves = n_leaves + (own & (n_children == 0))
        n_saved = n_saved + np.where(own, (x.count - 1) * x.length, 0)
        key: list = [None] * k
        if x.shared.any():
            shared = np.flatnonzero(x.shared)  # the first, the last, or one that is both
            for s in shared.tolist():
                key[s] = keys[0][d] if s == shared[0] and len(keys[0]) > d else keys[1][d]
        above = found[d - 1] if d else None
        parent_shared = above.shared[x.parent] if d else np.zeros(k, bool)
        parent_key = [None] * k
        if d and parent_shared.any():
            up = dict(zip(np.flatnonzero(above.shared).tolist(), [None] * 2))
            some = sorted(up)
            for s in some:
                up[s] = keys[0][d - 1] if s == some[0] and len(keys[0]) > d - 1 else keys[1][d - 1]
            for s in np.flatnonzero(parent_shared).tolist():
                parent_key[s] = up[int(x.parent[s])]
        parent_conv = pa.array(above.conv[x.parent], pa.int64(), mask=parent_shared) if d else pa.nulls(k, pa.int64())
        batches.append(pa.RecordBatch.from_arrays([
            pa.array(key, pa.binary()), pa.array(parent_key, pa.binary()), pa.array(x.conv, pa.int64()), pa.array(np.full(k, d), pa.int64()), parent_conv,
            pa.array(x.count, pa.int64()), pa.array(n_children, pa.int64()), pa.array(n_leaves, pa.int64()), pa.array(n_saved, pa.int64()),
            pa.array([ends[e] if e >= 0 else None for e in x.end.tolist()], pa.string()), pa.array(x.length, pa.int64())], schema=NODE_SCHEMA))
        if d:
            whole = len(found[d - 1].conv)
            by = x.parent[own]
            children = np.bincount(by, minlength=whole)
            leaves, saved = np.zeros(whole, np.int64), np.zeros(whole, np.int64)
            np.add.at(leaves, by, n_leaves[own])
            np.add.at(saved, by, n_saved[own])
    yield from batches


def shared_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete the nodes that shards share: each adds up its children among them, from the deepest up."""
    rows = [r for b in batches for r in b.to_pylist()]
    by = {r["key"]: r for r in rows}
    for r in sorted(rows, key=lambda r: -r["depth"]):
        r["n_leaves"] += r["n_children"] == 0
        r["saved_tokens"] += (r["n_convs"] - 1) * r["length"]
        up = by.get(r["parent_key"])
        if up is not None:
            r["parent_conv_id"] = up["conv_id"]
            for c, v in (("n_children", 1), ("n_leaves", r["n_leaves"]), ("saved_tokens", r["saved_tokens"])):
                up[c] += v
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=NODE_SCHEMA)


def prefix_trie(convs: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Nodes of the trie: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    spark = convs.sparkSession
    found = cut_lineage(classes(rebuilt(convs, group, heads)))
    turns = found.agg(F.coalesce(F.sum(F.size("path")), F.lit(0)).alias("n")).first()["n"]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + turns // SHARD_TURNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            path = t.column("path").combine_chunks()
            yield from shard_nodes(path.chunk(0) if isinstance(path, pa.ChunkedArray) else path, t.column("conv_id").to_numpy(), t.column("n_convs").to_numpy(), t.column("ends_sha256").to_pylist())

    nodes = cut_lineage(found.repartitionByRange(shards, "path").mapInArrow(run, NODES))
    sums = nodes.where("key is not null").groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"), F.max("length").alias("length"), F.max("parent_conv_id").alias("parent_conv_id"))
    # At most two paths for each shard, whatever the number of conversations.
    shared = cut_lineage(cut_lineage(sums.select(*NODE_SCHEMA.names)).coalesce(1).mapInArrow(shared_tree, NODES))
    alone = nodes.where("key is null")
    below = lookup_join(alone.where("parent_key is not null").drop("parent_conv_id"), shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")]
    return shared.select(*out).unionByName(below.select(*out)).unionByName(alone.where("parent_key is null").select(*out))


def op13_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = rf"""
with recursive {CRC_SQL.strip()},
o as (select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) w from conversations where conv_id is not null group by conv_id),
h as (select conv_id, w, {crc_of("conv_id::varchar")} % 6 h from o, crc),
p as (select h.conv_id, coalesce(b.w, [])[1:h.h] || h.w[h.h + 1:len(h.w)] w from h left join o b on b.conv_id = h.conv_id - h.conv_id % 100),
s as (select conv_id, len(w) n, 0::bigint depth, ''::varchar k, ''::varchar up, w, 0::bigint size from p
      union all select conv_id, n, depth + 1, sha256(k || '|' || w[depth + 1]::varchar), k, w, len(w[depth + 1].t) from s where depth < n),
nodes as (select k, up, depth, min(conv_id) conv_id, count(*) n_convs, max(size) size, string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth) ends from s group by k, up, depth),
kids as (select up k, count(*) n_children from nodes where depth > 0 group by up),
n as (select k, up, depth, conv_id, n_convs, coalesce(n_children, 0) n_children, (n_convs - 1) * size saved, ends from nodes left join kids using (k)),
anc as (select k, k top, up, n_children, saved from n
        union all select anc.k, n.k, n.up, anc.n_children, anc.saved from anc join n on n.k = anc.up where anc.k <> ''  and anc.top <> ''),
sub as (select top k, count(*) filter (n_children = 0) n_leaves, sum(saved)::bigint saved_tokens from anc group by top)
select n.conv_id, n.depth, u.conv_id parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, sha256(coalesce(n.ends, '')) ends_sha256
from n join sub using (k) left join n u on n.depth > 0 and u.k = n.up
"""
