"""Importance resampling towards a target distribution.

Documents and target texts are bags of hashed features: runs of ``1..ngram`` words, each in the bucket crc32 modulo
``buckets``. Tasks count buckets in arrays and Spark sums them; the gain of a bucket is the rounded log ratio of
its smoothed shares in the target and in the corpus, and a document's weight is the sum of the gains of its features. Adding noise from
the Gumbel distribution (a pure function of the id) and taking the highest scores draws documents without replacement
in proportion to their weights.

The draw takes a share of all eligible rows, so it is a selection and not a top-k report. The cutoff is found by medians of medians: each
block of at most ``BLOCK`` remaining keys of a task reports its median and its size, the median of these medians,
weighted by the sizes, becomes the pivot, and the rows on each side of it are counted. The side without the cutoff, at least a
quarter of what remains, is discarded; what remains is rewritten when it has shrunk to a quarter. Once ``FINISH`` keys are left the cutoff
is read from their sorted list. So the driver sees a few numbers for each block in a round, and no task sorts more than a
block. Only the winners are sorted, by range partitions.

The text is read twice (counts, then scores) without a shuffle of texts; words, hashes and sums are numpy over the bytes of a batch, one
step for each byte position of its words, words of more than ``LONG_WORD`` bytes (and what follows them in a run) apart.

Results: null and empty texts have no features, weight 0. Eligible are rows with at least ``least_words`` words. Equal scores go
by smaller id (null ids last), then by place in the table, so repeated rows are drawn apart. Ids are whole numbers. An empty target gives every
bucket the gain of its absence; an empty corpus gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER_BYTES, batch_of, packs, table
from tessera.operators.ordering import global_row_number
from tessera.session import cut_lineage

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
IN_WORD = np.array([bool(WORD.match(bytes([b]))) for b in range(256)])
BLOCK, FINISH, LONG_WORD = 1 << 18, 10_000, 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _crc_table()


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased bytes."""
    inside = np.concatenate([[False], IN_WORD[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def extend(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Running (not yet inverted) crc32 states after the bytes from ``start`` to ``end``: one step for each byte position."""
    state = state.copy()
    long = np.flatnonzero(end - start > LONG_WORD)
    for k in long.tolist():
        state[k] = zlib.crc32(raw[start[k] : end[k]].tobytes(), int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    todo = np.flatnonzero(end - start <= LONG_WORD)
    at, stop = start[todo], end[todo]
    while len(todo):
        go = at < stop
        if not go.all():
            todo, at, stop = todo[go], at[go], stop[go]
        s = state[todo]
        state[todo] = CRC[(s ^ raw[at]) & 0xFF] ^ s >> np.uint32(8)
        at = at + 1
    return state


def features(texts: list[str], ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, words of each row)`` of the runs of 1 to ``ngram`` words, repeats included."""
    parts = [t.encode() for t in texts]
    size = np.array([len(p) + 1 for p in parts], np.int64)
    raw = np.frombuffer(b"\n".join(parts).translate(LOWER_BYTES), np.uint8)
    start, end = word_spans(raw)
    row = np.searchsorted(np.cumsum(size), start, "right")
    rows, found = [], []
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    space = np.uint32(32)
    for n in range(1, ngram + 1):
        if n > 1:
            state = state[:-1] if len(state) else state
            state = CRC[(state ^ space) & 0xFF] ^ state >> np.uint32(8)
        k = len(start) - n + 1
        if k <= 0:
            break
        state = extend(state, raw, start[n - 1 :], end[n - 1 :])
        whole = row[:k] == row[n - 1 :]
        rows.append(row[:k][whole])
        found.append((state[whole] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))
    words = np.bincount(row, minlength=len(texts))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), words
    return np.concatenate(rows), np.concatenate(found).astype(np.int64), words


def bucket_counts(df: DataFrame, text: str, ngram: int, buckets: int) -> np.ndarray:
    """How many features of ``df`` fall in each bucket: an array for each task, summed by Spark; at most ``buckets`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in packs(list(range(batch.num_rows)), batch.column(0).to_pylist()):
                total += np.bincount(features(texts, ngram, buckets)[1], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(text).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: float = 1000.0) -> np.ndarray:
    """``floor(scale * ln(((t + 1) * (S + b)) / ((s + 1) * (T + b))))`` for each of the b buckets."""
    b = len(corpus)
    share, whole, all_s, all_t = target + 1.0, corpus + 1.0, float(corpus.sum() + b), float(target.sum() + b)
    return np.array([math.floor(scale * math.log(t * all_s / (s * all_t))) for t, s in zip(share.tolist(), whole.tolist())], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, ngram: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id long, n_features, n_words, weight)`` for every row. The gains (one number for each bucket) go to the workers."""
    sent = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = sent.value
        schema = pa.schema([(c, pa.int64()) for c in ("id", "n_features", "n_words", "weight")])
        for batch in batches:
            for keys, texts in packs(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row, bucket, words = features(texts, ngram, len(g))
                order = np.argsort(row, kind="stable")
                count = np.bincount(row, minlength=len(texts))
                running = np.concatenate([[0], np.cumsum(g[bucket[order]])])  # whole numbers: bincount would sum in doubles
                ends = np.cumsum(count)
                yield batch_of(schema, [keys, count, words, running[ends] - running[ends - count]])

    return df.select(F.col(id_col).cast("long"), F.col(text)).mapInArrow(run, "id long, n_features long, n_words long, weight long")


def scored(weights: DataFrame, seed: str) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise from the hash of seed and id (a null id counts as empty)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weights.withColumn("score", (F.col("weight") + noise).cast("long"))


def _order(k: dict[str, np.ndarray]) -> np.ndarray:
    """Best first: high scores, then small ids (null last), then place."""
    return np.lexsort((k["place"], k["id"], k["missing"], -k["score"]))


def _columns(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    t = pa.Table.from_batches(batches)
    null = t.column("id").is_null().to_numpy()
    ids = t.column("id").fill_null(0).to_numpy()
    return {"score": t.column("score").to_numpy(), "id": ids, "missing": null, "place": t.column("place").to_numpy()}


def _better(pivot: tuple) -> F.Column:
    """Rows that come before the pivot ``(score, id or None, place)``."""
    s, i, p = pivot
    score, key, place = F.col("score"), F.col("id"), F.col("place")
    same = place < p
    tie = (key.isNotNull() | same) if i is None else (key.isNotNull() & ((key < i) | ((key == i) & same)))
    return (score > s) | ((score == s) & tie)


def medians(keys: DataFrame) -> list[tuple[tuple, int]]:
    """``((score, id, place), size)``: the median of each block of at most ``BLOCK`` keys of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def middle() -> pa.RecordBatch:
            k = _columns(held)
            m = _order(k)[(size - 1) // 2]
            return pa.RecordBatch.from_arrays([pa.array([k["score"][m]], pa.int64()), pa.array([None if k["missing"][m] else k["id"][m]], pa.int64()),
                                               pa.array([k["place"][m]], pa.int64()), pa.array([size], pa.int64())], names=["score", "id", "place", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                if size + part.num_rows > BLOCK:
                    yield middle()
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield middle()

    rows = keys.select("score", "id", "place").mapInArrow(run, "score long, id long, place long, n long").collect()
    return [((r["score"], r["id"], r["place"]), r["n"]) for r in rows]


def _rank_key(k: tuple) -> tuple:
    return (-k[0], k[1] is None, k[1] or 0, k[2])


def weighted_median(found: list[tuple[tuple, int]]) -> tuple:
    found = sorted(found, key=lambda x: _rank_key(x[0]))
    half, seen = (sum(n for _, n in found) + 1) // 2, 0
    for key, n in found:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, total: int, finish: int = FINISH) -> tuple | None:
    """The key ``(score, id, place)`` of the k-th best of ``total`` rows; None where nothing is drawn."""
    if k <= 0 or total <= 0:
        return None
    k = min(k, total)
    held = total  # rows of the table that ``keys`` reads
    base, left = keys, total
    low = high = None  # remaining rows come after ``low`` and before or at ``high``

    def remaining() -> DataFrame:
        out = base
        if low is not None:
            out = out.where(~(_better(low) | ((F.col("score") == low[0]) & F.col("id").eqNullSafe(F.lit(low[1]).cast("long")) & (F.col("place") == low[2]))))
        if high is not None:
            out = out.where(_better(high) | ((F.col("score") == high[0]) & F.col("id").eqNullSafe(F.lit(high[1]).cast("long")) & (F.col("place") == high[2])))
        return out

    while left > finish:
        pivot = weighted_median(medians(remaining()))
        first = remaining().where(_better(pivot)).count() + 1  # the pivot and what comes before it
        if k <= first:
            high, left = pivot, first
        else:
            low, k, left = pivot, k - first, left - first
        if 4 * left < held:
            base, held, low, high = cut_lineage(remaining()), left, None, None
    rows = [(r["score"], r["id"], r["place"]) for r in remaining().select("score", "id", "place").collect()]
    return sorted(rows, key=_rank_key)[k - 1]


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, ngram: int = 1,
             buckets: int = 10_000, seed: str = "2024", text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id_col long, n_features, weight, score, rank)`` for every row of ``docs``: of the N rows with at least ``least_words`` words,
    the best ``floor(share[0] * N / share[1])`` have a rank from 1, the others null."""
    gain = gains(bucket_counts(docs, text, ngram, buckets), bucket_counts(target, text, ngram, buckets))
    found = scored(weigh(docs, gain, ngram, text, id_col), seed).withColumn("place", F.monotonically_increasing_id())
    found = cut_lineage(found)  # from here on the place of a row is fixed
    able = found.where(F.col("n_words") >= least_words)
    total = able.count()
    last = cutoff(able.select("score", "id", "place"), share[0] * total // share[1], total)
    out = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if last is None:
        return found.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (_better(last) | ((F.col("score") == last[0]) & F.col("id").eqNullSafe(F.lit(last[1]).cast("long")) & (F.col("place") == last[2])))
    winners = global_row_number(found.where(drawn), [F.desc("score"), F.asc_nulls_last("id"), F.asc("place")], out="rank")
    return winners.select(*out, "rank").unionByName(found.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


def op12_importance(spark, sf_dir: str) -> DataFrame:
    """A tenth of the documents drawn towards the benchmark's words."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 of a word in SQL: a table of 256 entries, then one step for each byte.
CRC_SQL = r"""
crc as (select list(c order by b) t from (select b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) c
        from (select unnest(range(0, 256)) b)))"""


def crc_of(c: str) -> str:
    """SQL for the crc32 of a text column ``c`` as an integer, beside the column ``t`` of the ``crc`` table above."""
    byte = f"list_transform(range(0, octet_length(encode({c}))), lambda k: ('0x' || substr(hex(encode({c})), 2 * k + 1, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), lambda x, y: xor(x >> 8, t[xor(x & 255, y) + 1])), 4294967295)"


OP12_SQL = rf"""
with {CRC_SQL.strip()},
d as (select row_number() over () k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
dw as (select k, unnest(w) x from d),
tw as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) x from benchmark),
v as (select x, {crc_of("x")} % 10000 b from (select x from dw union select x from tw), crc),
s as (select b, count(*) s from dw join v using (x) group by b),
t as (select b, count(*) t from tw join v using (x) group by b),
n as (select (select count(*) from dw)::double ss, (select count(*) from tw)::double tt),
g as (select b, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (ss + 10000) / ((coalesce(s, 0) + 1.0::double) * (tt + 10000))))::bigint gain
      from (select unnest(range(0, 10000)) b) left join s using (b) left join t using (b), n),
f as (select k, sum(gain)::bigint weight from dw join v using (x) join g using (b) group by k),
z as (select k, doc_id, len(w)::bigint n_features, coalesce(weight, 0) weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296))))::bigint score
      from d left join f using (k)),
r as (select k, row_number() over (order by score desc, doc_id nulls last, k) r, count(*) over () n from z where n_features >= 20)
select doc_id, n_features, weight, score, case when r <= 10 * n // 100 then r end "rank" from z left join r using (k)
"""
