"""FTRL-proximal: the online linear learner with adaptive rates of its own for each slot (#74).

The state of a slot is ``(z, n)``: the summed, corrected gradients and the summed squares of gradients. Its weight is 0 while ``|z| <= l1`` and else
``(sign(z) * l1 - z) / ((beta + sqrt(n)) / alpha + l2)``. Rows are learned one after the other with the identity link: the error is the
weighted sum minus the label, clipped to ``clip``.

Rows are dealt into shards of about ``SHARD_ROWS`` by a hash of the row, so the shards don't depend on how the input lies. A pass learns every shard in its own task, in
the order of that hash, from the state that all shards ended the pass before with; the state rows that a shard needs come to it by a join on the
slot. After a pass the changes of all shards are added up in the order of shards, so a run repeats exactly. One shard is the plain
online learner; with more, a row of one shard is not seen by the rows of another in the same pass. The rows of each slot's changes are as
many as the shards that hold it; the driver holds nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.boosting import entries
from tessera.operators.joins import lookup_join
from tessera.session import cut_lineage

SHARD_ROWS = 50_000
BIAS = -1


def weights_of(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def learn(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float, clip: float) -> None:
    """One pass in place: ``rows`` are (places in the state, values), whose first place is the bias."""
    for (at, x), label in zip(rows, y.tolist()):
        w = weights_of(z[at], n[at], alpha, beta, l1, l2)
        error = min(max(float(w @ x) - label, -clip), clip)
        g = error * x
        more = n[at] + g * g
        z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
        n[at] = more


def fit(train: DataFrame, alpha: float = 0.01, beta: float = 0.1, l1: float = 0.1, l2: float = 1000.0, passes: int = 2, clip: float = 1.0,
        shards: int | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(slot, z, n)`` after ``passes`` over ``train(key, features, label)``; slot -1 is the bias. Rows without a label teach nothing."""
    known = entries(train).where("label is not null")
    key = [c for c in train.columns if c not in ("features", "label")]
    known = cut_lineage(known.select(F.xxhash64(*key, "_e", "label").alias("h"), F.col("label").cast("double").alias("y"), "_e"))
    shards = shards or 1 + known.count() // shard_rows
    rows = cut_lineage(known.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "h", "y", F.col("_e")["slot"].alias("slots"), F.col("_e")["value"].alias("values")))
    slots = rows.select("shard", F.explode("slots").alias("slot")).distinct().unionByName(rows.select("shard", F.lit(BIAS).alias("slot")).distinct())
    slots = cut_lineage(slots)
    state = None
    for _ in range(passes):
        given = slots if state is None else slots.join(state, "slot", "left")
        given = given.select("shard", "slot", *[F.lit(0.0).alias(c) if state is None else F.coalesce(c, F.lit(0.0)).alias(c) for c in ("z", "n")])

        def run(part: pa.Table, held: pa.Table) -> pa.Table:
            held = held.sort_by("slot")
            names, z, n = (held.column(c).to_numpy() for c in ("slot", "z", "n"))
            z, n = z.copy(), n.copy()
            z0, n0 = z.copy(), n.copy()
            part = part.sort_by("h")
            flat = part.column("slots").combine_chunks()
            ends = np.cumsum([len(v) for v in flat])
            at = np.searchsorted(names, flat.flatten().to_numpy())
            values = part.column("values").combine_chunks().flatten().to_numpy()
            one = np.ones(1)
            lists = [(np.append(0, at[a:b]), np.concatenate([one, values[a:b]])) for a, b in zip([0, *ends[:-1]], ends)]  # the bias, slot -1, comes first
            learn(lists, part.column("y").to_numpy(), z, n, alpha, beta, l1, l2, clip)
            shard = pa.array(np.full(len(names), part.column("shard")[0].as_py()), pa.int64())
            return pa.table([shard, held.column("slot"), pa.array(z - z0), pa.array(n - n0)], names=["shard", "slot", "z", "n"])

        changes = rows.groupBy("shard").cogroup(given.groupBy("shard")).applyInArrow(run, "shard long, slot int, z double, n double")
        if state is not None:
            changes = changes.unionByName(state.select(F.lit(-1).cast("long").alias("shard"), "slot", "z", "n"))
        listed = changes.groupBy("slot").agg(F.array_sort(F.collect_list(F.struct("shard", "z", "n"))).alias("c"))
        add = lambda c: F.aggregate("c", F.lit(0.0), lambda a, x: a + x[c])  # noqa: E731  in the order of shards
        state = cut_lineage(listed.select("slot", add("z").alias("z"), add("n").alias("n")))
    return state


def weights(state: DataFrame, alpha: float = 0.01, beta: float = 0.1, l1: float = 0.1, l2: float = 1000.0) -> DataFrame:
    """``(slot, w)`` of the slots whose weight isn't 0."""
    w = F.when(F.abs("z") <= l1, 0.0).otherwise((F.signum("z") * l1 - F.col("z")) / ((beta + F.sqrt("n")) / alpha + l2))
    return state.select("slot", w.alias("w")).where("w <> 0")


def margins(df: DataFrame, key: str, w: DataFrame) -> DataFrame:
    """``(id, margin)``: the weighted sum of every row."""
    rows = cut_lineage(entries(df).select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("_r"), "_e"))
    e = rows.select("_r", F.explode("_e").alias("e")).select("_r", "e.slot", "e.value")
    e = e.unionByName(rows.select("_r", F.lit(BIAS).alias("slot"), F.lit(1.0).alias("value")))
    terms = lookup_join(e, w, "slot", spread="_r").groupBy("_r").agg(F.sum(F.col("w") * F.col("value")).alias("margin"))
    return rows.select("id", "_r").join(terms, "_r", "left").select("id", F.coalesce("margin", F.lit(0.0)).alias("margin"))
