"""Benchmark decontamination with DataFrame functions only.

Benchmark items and documents are cut into normalised words; a window is ``width`` consecutive words of an item
(a shorter item is one window). The windows, each with the items it stands in, form the hash set, keyed by a
hash of their first words; it is broadcast after a check of its size and joined by a shuffle beyond that. Every
word position of every document probes the key and each probe that hits is verified on the window's text, so a hash
collision counts for nothing. Texts are scanned once and never shuffled when the set is broadcast: the shuffle
holds one row for each document and one for each hit.

Null and empty texts have no words and are never contaminated. Documents are told apart by id and text: rows
that repeat both give one row, null ids are an id like any other. Items are told apart by item id; an item whose id is null
makes words hit but isn't counted. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, fresh, table
from tessera.operators.joins import broadcastable
from tessera.session import cut_lineage

WIDTH = 13
KEY_WORDS = 4
#: A word after lower-casing A-Z, and the same before it.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def key_at(ws: str, at: Column, n: int) -> Column:
    """Hash of ``n`` words from place ``at`` (from 0); the length is part of it."""
    return F.xxhash64(F.lit(n), *[F.get(ws, at + k) for k in range(n)])


def window_set(bench: DataFrame, text: str = "text", item: str = "item_id", width: int = WIDTH) -> DataFrame:
    """``(m, window, items, key_words, key)``: the distinct windows, their length in words and their items."""
    rows = bench.select(F.col(item).alias("item"), words(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    rows = rows.withColumn("m", F.least(F.size("ws"), F.lit(width)))
    rows = rows.select("item", "ws", "m", F.explode(F.sequence(F.lit(0), F.size("ws") - F.col("m"))).alias("at"))
    rows = rows.select("item", "m", F.slice("ws", F.col("at") + 1, F.col("m")).alias("ws"))
    found = rows.groupBy("m", "ws").agg(F.collect_set("item").alias("items"))
    key = F.lit(None).cast("long")
    for n in range(KEY_WORDS, 0, -1):
        key = F.when(F.col("m") >= n, F.when(F.least("m", F.lit(KEY_WORDS)) == n, key_at("ws", F.lit(0), n)).otherwise(key)).otherwise(key)
    return cut_lineage(found.select("m", F.array_join("ws", " ").alias("window"), "items",
                                    F.least("m", F.lit(KEY_WORDS)).alias("key_words"), key.alias("key")))


def scan(docs: DataFrame, windows: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, text_hash, n_words, spans array<struct<at,m>>, items)`` for each document: verified hits."""
    # At most KEY_WORDS rows: how many words the keys are made of, and the shortest window of each kind.
    kinds = sorted((r["key_words"], r["least"]) for r in windows.groupBy("key_words").agg(F.min("m").alias("least")).collect())
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("ws"))
    base = base.select("id", "text_hash", "ws", F.size("ws").alias("n_words"))
    # Place -1 stands for the document itself, which has to come out whether it has hits or not.
    least = min((m for _, m in kinds), default=WIDTH)
    at = base.select("*", F.explode(F.sequence(F.lit(-1), F.greatest(F.lit(-1), F.col("n_words") - least))).alias("at"))
    keys = [key_at("ws", F.col("at"), n) for n, _ in kinds]
    if len(keys) > 1:
        at = at.select("*", F.explode(F.when(F.col("at") >= 0, F.array(*keys)).otherwise(F.array(F.lit(None).cast("long")))).alias("probe"))
    else:
        at = at.select("*", F.when(F.col("at") >= 0, keys[0] if keys else F.lit(None).cast("long")).alias("probe"))
    w = windows.select("key", "m", "window", "items")
    w = F.broadcast(w) if broadcastable(windows) else w
    same = (at["probe"] == w["key"]) & (F.col("at") + F.col("m") <= F.col("n_words")) & \
        (F.array_join(F.slice("ws", F.col("at") + 1, F.col("m")), " ") == F.col("window"))
    hits = at.join(w, same, "left").where("at = -1 or m is not null")
    span = F.when(F.col("m").isNotNull(), F.struct("at", "m"))
    return hits.select("id", "text_hash", "n_words", span.alias("span"), "items").groupBy("id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def hit_words(spans: Column) -> Column:
    """The number of words inside any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["at"] + s["m"] - F.greatest(a["end"], s["at"]))).cast("long").alias("n"),
        F.greatest(a["end"], s["at"] + s["m"]).alias("end")), lambda a: a["n"])


def report(docs: DataFrame, bench: DataFrame, text: str = "text", id_col: str = "doc_id", share: int = 20) -> DataFrame:
    """``(id_col, text_hash, n_words, n_hit, items, spans, contaminated)``: contaminated where at least one word in
    ``share`` is hit."""
    found = scan(docs, window_set(bench), text, id_col).withColumn("n_hit", hit_words(F.col("spans")))
    return found.select(F.col("id").alias(id_col), "text_hash", F.col("n_words").cast("long").alias("n_words"), "n_hit", "items", "spans",
                        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", id_col: str = "doc_id", remove: str = "documents") -> DataFrame:
    """``docs`` without its contaminated documents, or (``remove="spans"``) with all documents but without the hit
    words in any of them. Columns and their order stay."""
    id_, hash_, hits = fresh(docs, "id", "hash", "hits")
    found = report(docs, bench, text, id_col).select(F.col(id_col).alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(hits), F.col("contaminated").alias("bad"))
    mine = docs[id_col].eqNullSafe(F.col(id_)) & (F.xxhash64(docs[text]) == F.col(hash_))
    if remove == "documents":
        return docs.join(cut_lineage(found.where("bad").select(id_, hash_)), mine, "left_anti")
    both = docs.join(cut_lineage(found.where(F.size(hits) > 0).drop("bad")), mine, "left")
    gaps = F.split(docs[text], RAW_WORD, -1)
    own = F.regexp_extract_all(docs[text], F.lit(RAW_WORD), F.lit(0))
    at = F.flatten(F.transform(hits, lambda s: F.sequence(s["at"], s["at"] + s["m"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), at)
    kept = F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(stay, lambda k: F.concat(F.get(own, k), F.get(gaps, k + 1))), ""))
    # A text that is hit throughout has nothing to keep but what stood before its first word.
    return both.select(*[F.when(F.col(hits).isNotNull(), kept).otherwise(docs[c]).alias(c) if c == text else docs[c] for c in docs.columns])


def op9_decontam(spark, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark."""
    found = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(named, 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
with b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
bw as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') win
       from (select item_id, w, least(len(w), 13) m, unnest(range(1, len(w) - least(len(w), 13) + 2)) i from b where len(w) > 0)),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
dw as (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') win
       from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) i from d, (select distinct m from bw))),
h as (select doc_id, i, dw.m, item_id from dw join bw on dw.win = bw.win and dw.m = bw.m),
n as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + m)) p from h) group by doc_id),
t as (select doc_id, count(*) n_items, string_agg(s, ',' order by s) s from (select distinct doc_id, cast(item_id as varchar) s from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(s, '')) items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join n using (doc_id) left join t using (doc_id)
"""
