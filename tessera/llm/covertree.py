"""Exact top-k inner-product search by dual cover trees.

Queries and data are dealt into blocks of bounded size by a hash of their ids, and each query block meets each
data block in one task: a stated query set against all rows, in blocks. The task builds a cover tree over
either block and descends both at once. A pair of nodes is dropped when the best inner product that the
centres and covering radii allow is below the worst kth score of the node's queries; nodes left over are
visited best bound first, and two leaves meet in one matrix product. Each block pair returns at most k rows for a query,
ranked once more by Spark over all blocks.

Scores are exact: components are integers, and products go through float64 only where every sum stays below
2**53. Vectors that are null or hold null or non-finite components take no part, nor do rows without an id;
shorter vectors count as padded with zeros. Rows that repeat an id and vector count once. Ties go to the
smaller id. Fewer candidates than k are all returned; without queries or candidates the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import table

QUERY_BLOCK, DATA_BLOCK = 4096, 4096
LEAF, FANOUT = 512, 16
LOWEST = np.iinfo(np.int64).min


class Node:
    __slots__ = ("rows", "centre", "radius", "norm", "children", "worst")

    def __init__(self, x: np.ndarray, rows: np.ndarray, centre: np.ndarray, far: np.ndarray):
        """``far``: distances of ``rows`` from the centre, which is one of them."""
        self.rows, self.centre, self.radius = rows, centre, float(far.max())
        self.norm, self.worst = float(np.sqrt(centre @ centre)), LOWEST
        self.children: list[Node] = []
        if len(rows) <= LEAF or self.radius == 0:
            return
        # Farthest-first centres, beginning with the node's own, until they cover the node at half its radius.
        first = int(far.argmin())
        dist, owner, chosen = far.copy(), np.zeros(len(rows), np.int64), [first]
        while len(chosen) < FANOUT and dist.max() > self.radius / 2:
            new = int(dist.argmax())
            d = np.sqrt(((x[rows] - x[rows[new]]) ** 2).sum(1))
            near = d < dist
            owner[near], dist[near] = len(chosen), d[near]
            chosen.append(new)
        for k, c in enumerate(chosen):
            own = owner == k
            self.children.append(Node(x, rows[own], x[rows[c]], dist[own]))


def tree(x: np.ndarray) -> Node:
    centre = x[int(np.abs(x - x.mean(0)).sum(1).argmin())]
    return Node(x, np.arange(len(x)), centre, np.sqrt(((x - centre) ** 2).sum(1)))


class Search:
    """Top ``k`` of every query in one block of data."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int):
        self.q_ids, self.x_ids, self.k = q_ids, x_ids, k
        self.exact = [q, x]
        self.q, self.x = q.astype(np.float64), x.astype(np.float64)
        if q.shape[1] and float(np.abs(self.q).max()) * float(np.abs(self.x).max()) * q.shape[1] < 2**53:
            self.exact = [self.q, self.x]
        self.score = np.full((len(q), k), LOWEST, np.int64)
        self.best = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        self.visit(tree(self.q), [tree(self.x)])

    def bounds(self, a: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.array([b.centre for b in nodes])
        radius, norm = np.array([b.radius for b in nodes]), np.array([b.norm for b in nodes])
        top = centres @ a.centre + a.norm * radius + norm * a.radius + a.radius * radius
        return top + np.abs(top) * 1e-9 + 1e-6  # rounding must not drop anything

    def visit(self, a: Node, nodes: list[Node]) -> None:
        """All queries of ``a`` against all data of ``nodes``."""
        top = self.bounds(a, nodes)
        order = np.argsort(-top, kind="stable")
        if a.children:
            # Both sides descend: the data nodes that can still matter are split before the queries are.
            live = [nodes[i] for i in order if top[i] >= a.worst]
            parts = [c for b in live for c in (b.children or [b])]
            if parts:
                for child in a.children:
                    self.visit(child, parts)
                a.worst = min(child.worst for child in a.children)
            return
        for i in order:
            if top[i] < a.worst:
                break
            if nodes[i].children:
                self.visit(a, nodes[i].children)
            else:
                self.leaves(a, nodes[i])

    def leaves(self, a: Node, b: Node) -> None:
        """Merge the scores of two leaves that reach the queries' kth into their best."""
        s = (self.exact[0][a.rows] @ self.exact[1][b.rows].T).astype(np.int64)
        ids = self.x_ids[b.rows]
        s[self.q_ids[a.rows][:, None] == ids[None, :]] = LOWEST
        row, col = np.nonzero((s >= self.score[a.rows, -1][:, None]) & (s > LOWEST))
        if len(row):
            some = np.unique(row)
            rows = a.rows[some]
            at = np.concatenate([np.repeat(np.arange(len(some)), self.k), np.searchsorted(some, row)])
            score = np.concatenate([self.score[rows].ravel(), s[row, col]])
            best = np.concatenate([self.best[rows].ravel(), ids[col]])
            order = np.lexsort((best, -(score + 1), at))  # + 1: the lowest integer has no negative
            first = np.searchsorted(at[order], np.arange(len(some)))
            take = order[first[:, None] + np.arange(self.k)]
            self.score[rows], self.best[rows] = score[take], best[take]
        a.worst = int(self.score[a.rows, -1].min())


def distinct(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the rows that repeat an id and vector."""
    rows = np.unique(np.column_stack([ids, vectors]), axis=0)
    return rows[:, 0], rows[:, 1:]


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(rows), width), np.int64)
    sizes = np.diff(rows.offsets.to_numpy())
    out[np.arange(width) < sizes[:, None]] = rows.flatten().to_numpy()
    return out


def quantised(vector: Column, scale: float = 64) -> Column:
    """``floor(scale * x)`` of every component as a long, or null for a vector that takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(x, lambda v: F.floor(v * scale)))


def top_k(queries: DataFrame, data: DataFrame, k: int = 20, id_col: str = "vec_id", vector: str = "vector",
          query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``. Both frames have an integer id and an array of longs."""
    q = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    x = data.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    n_q, n_x = max(1, -(-q.count() // query_block)), max(1, -(-x.count() // data_block))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select("id", "v", block(n_q).alias("qb")).select("*", every(n_x).alias("xb"))
    right = x.select("id", "v", block(n_x).alias("xb")).select("*", every(n_q).alias("qb"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        width = max(max(len(v) for v in t.column("v")) for t in (a, b))
        got = Search(*distinct(a.column("id").to_numpy(), matrix(a.column("v"), width)), *distinct(b.column("id").to_numpy(), matrix(b.column("v"), width)), k)
        real = got.score.ravel() != LOWEST
        return pa.table([np.repeat(got.q_ids, k)[real], got.best.ravel()[real], got.score.ravel()[real]], schema=schema)

    found = left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb")).applyInArrow(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.distinct().select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def op8_covertree(spark, sf_dir: str) -> DataFrame:
    """The 20 best partners of every twentieth vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_k(vectors.where("vec_id % 20 = 0"), vectors)


OP8_SQL = """
with v as (select vec_id, [floor(64 * cast(x as double)) for x in embedding] e from embeddings
           where vec_id is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id query_id, v.vec_id, cast(list_inner_product(q.e, v.e) as bigint) score
      from v q join v on q.vec_id <> v.vec_id where q.vec_id % 20 = 0),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) r, vec_id, score from s)
select query_id, cast(r as integer) rank, vec_id, score from r where r <= 20
"""
