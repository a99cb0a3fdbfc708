"""A feed-forward network on sparse rows (#75): sigmoid hidden layers, a softmax output, full-batch L-BFGS.

It is the problem that ``pyspark.ml``'s ``MultilayerPerceptronClassifier`` solves, with its start weights, its loss (the mean over blocks of
``STACK`` rows of each block's mean) and its optimiser (Breeze's L-BFGS with a strong Wolfe line search), so the weights agree up to rounding.
That learner makes every row dense, in memory as in the product with the first layer; here only a row's values are multiplied.

Rows lie in packs of whole blocks, each one Spark row of byte arrays. A pass sums the loss and the gradient of all packs: one vector for each task, cut into
parts of ``PART`` numbers that Spark adds up. The driver and each task hold a few vectors as long as all weights (the driver twice ``MEMORY`` of them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

STACK, PART, MEMORY = 128, 1 << 16, 10
#: Values that are multiplied at a time, and values with which a pack ends.
ENTRIES, PACKED = 1 << 11, 1 << 16
#: Up to so many values one task holds all packs, and its passes need no job.
LOCAL_ENTRIES = 1 << 18


class Pack(NamedTuple):
    y: np.ndarray
    weight: np.ndarray  # one by the rows of the row's block
    ptr: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    order: np.ndarray  # of the values by slot


KINDS = (np.float64, np.float64, np.int64, np.int32, np.float64, np.int32)
SCHEMA = ", ".join(f"`{c}` binary" for c in Pack._fields)


def sparse(df: DataFrame, *more: str) -> DataFrame:
    """``(slots, values, *more)`` of the ml vectors ``features``; dense ones have no slots."""
    raw = F.unwrap_udt("features")
    return df.select(F.when(raw["type"] == 0, raw["indices"]).alias("slots"), raw["values"].alias("values"), *more)


def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ptr, slot, value)`` of the rows of :func:`sparse`."""
    values, slots = (batch.column(batch.schema.get_field_index(c)) for c in ("values", "slots"))
    n = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ptr = np.concatenate([[0], np.cumsum(n)])
    slot = (np.arange(ptr[-1]) - np.repeat(ptr[:-1], n)).astype(np.int32)
    given = slots.is_valid().to_numpy(zero_copy_only=False)
    slot[np.repeat(given, n)] = slots.flatten().to_numpy(zero_copy_only=False)
    return ptr, slot, values.flatten().to_numpy(zero_copy_only=False)


def packed(rows: DataFrame) -> DataFrame:
    """Packs of ``rows(features, label)`` in the order of each partition."""
    def pack(y: np.ndarray, ptr: np.ndarray, slot: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        n = len(y)
        block = np.arange(n) // STACK
        p = Pack(y, 1 / np.bincount(block)[block], ptr, slot, value, np.argsort(slot, kind="stable"))
        return pa.RecordBatch.from_arrays([pa.array([np.asarray(v, k).tobytes()], pa.binary()) for v, k in zip(p, KINDS)], names=list(Pack._fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, size, slot, value = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label"))
            new = label.to_numpy(zero_copy_only=False).astype(float)
            if not np.isin(new, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            ptr, s, v = entries(batch)
            y, size, slot, value = np.append(y, new), np.append(size, np.diff(ptr)), np.append(slot, s), np.append(value, v)
            ptr, at = np.concatenate([[0], np.cumsum(size)]), 0
            while len(y) - at > STACK:
                to = at + STACK
                while to + STACK < len(y) and ptr[to] - ptr[at] < PACKED:
                    to += STACK
                part = slice(ptr[at], ptr[to])
                yield pack(y[at:to], ptr[at : to + 1] - ptr[at], slot[part], value[part])
                at = to
            y, size, slot, value = y[at:], size[at:], slot[ptr[at] :], value[ptr[at] :]
        if len(y):
            yield pack(y, np.concatenate([[0], np.cumsum(size)]), slot, value)

    return sparse(rows, "label").mapInArrow(run, SCHEMA)


def layers_of(w: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(weights by input and output, biases)`` of each layer: views of the flat vector."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((w[at : at + a * b].reshape(a, b), w[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def pieces(ptr: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``ENTRIES`` values, or one row."""
    at = 0
    while at < len(ptr) - 1:
        to = max(at + 1, int(np.searchsorted(ptr, ptr[at] + ENTRIES, side="right")) - 1)
        yield at, to
        at = to


def first_products(w: np.ndarray, ptr: np.ndarray, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rows times ``w``, from their values alone."""
    out = np.zeros((len(ptr) - 1, w.shape[1]))
    for a, b in pieces(ptr):
        at = slice(ptr[a], ptr[b])
        each = w[slot[at]]
        each *= value[at, None]
        has = np.flatnonzero(np.diff(ptr[a : b + 1]))
        if len(has):
            out[a + has] = np.add.reduceat(each, ptr[a + has] - ptr[a], axis=0)
    return out


def outputs(w: np.ndarray, layers: list[int], ptr: np.ndarray, slot: np.ndarray, value: np.ndarray) -> list[np.ndarray]:
    """What every layer gives: sigmoids, and at the end the logarithms of the softmax."""
    out = []
    for k, (m, bias) in enumerate(layers_of(w, layers)):
        z = (out[-1] @ m if k else first_products(m, ptr, slot, value)) + bias
        if k < len(layers) - 2:
            out.append(1 / (1 + np.exp(-np.clip(z, -700, 700))))
        else:
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
    return out


def add_gradient(w: np.ndarray, layers: list[int], p: Pack, grad: np.ndarray) -> float:
    """Adds the pack's gradient to ``grad``; its loss."""
    out = outputs(w, layers, p.ptr, p.slot, p.value)
    target = p.y.astype(np.int64)
    loss = -float((out[-1][np.arange(len(target)), target] * p.weight).sum())
    delta = np.exp(out[-1])
    delta[np.arange(len(target)), target] -= 1
    delta *= p.weight[:, None]
    ws, gs = layers_of(w, layers), layers_of(grad, layers)
    for k in range(len(ws) - 1, 0, -1):
        gs[k][0][:] += out[k - 1].T @ delta
        gs[k][1][:] += delta.sum(axis=0)
        delta = delta @ ws[k][0].T * (out[k - 1] * (1 - out[k - 1]))
    gs[0][1][:] += delta.sum(axis=0)
    row, slot = np.repeat(np.arange(len(target)), np.diff(p.ptr))[p.order], p.slot[p.order]
    for a in range(0, len(slot), ENTRIES):
        at = slice(a, a + ENTRIES)
        each = delta[row[at]]
        each *= p.value[p.order[at], None]
        first = np.flatnonzero(np.diff(slot[at], prepend=-1))
        gs[0][0][slot[at][first]] += np.add.reduceat(each, first, axis=0)
    return loss


def summed(batches, w: np.ndarray, layers: list[int]) -> np.ndarray:
    """Loss, number of blocks and gradient of the packs."""
    out = np.zeros(2 + len(w))
    for batch in batches:
        for k in range(batch.num_rows):
            p = Pack(*[np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in enumerate(KINDS)])
            out[0] += add_gradient(w, layers, p, out[2:])
            out[1] += -(-len(p.y) // STACK)
    return out


def total(packs: DataFrame, w: np.ndarray, layers: list[int], parts: int) -> np.ndarray:
    """Loss, number of blocks and gradient over all packs."""
    sc = packs.sparkSession.sparkContext
    held = sc.broadcast(w)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = summed(batches, held.value, layers)
        if out[1]:
            for at in range(0, len(out), PART):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([out[at : at + PART].tobytes()], pa.binary())], names=["at", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                new = np.frombuffer(part.as_buffer())
                all_[at] = all_[at] + new if at in all_ else new
        if all_:
            yield pa.RecordBatch.from_arrays([pa.array(list(all_), pa.int64()), pa.array([v.tobytes() for v in all_.values()], pa.binary())], names=["at", "part"])

    found = packs.mapInArrow(sums, "at bigint, part binary").repartition(parts, "at").mapInArrow(added, "at bigint, part binary").collect()
    held.destroy()
    out = np.zeros(2 + len(w))
    for r in found:
        new = np.frombuffer(r["part"])
        out[r["at"] : r["at"] + len(new)] = new
    return out


def fit(rows: DataFrame, layers: list[int], start: np.ndarray, max_iter: int, tol: float = 1e-6) -> np.ndarray:
    """The weights for ``rows(features, label)``, in the layout of ``pyspark.ml``'s model."""
    sc = rows.sparkSession.sparkContext
    # As many partitions as cores, since each task sends a gradient.
    packs = cut_lineage(packed(rows).repartition(sc.defaultParallelism)).coalesce(sc.defaultParallelism)
    if (packs.agg(F.sum(F.octet_length("slot"))).first()[0] or 0) <= 4 * LOCAL_ENTRIES:
        return fit_local(packs, layers, start, max_iter, tol)
    packs.persist()
    parts = min(sc.defaultParallelism, 1 + len(start) // PART)

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        out = total(packs, w, layers, parts)
        return float(out[0] / out[1]), out[2:] / out[1]

    try:
        return minimised(value, start, max_iter, tol)
    finally:
        packs.unpersist()


def fit_local(packs: DataFrame, layers: list[int], start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """The same where one task may hold all packs."""
    held = packs.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = list(batches)

        def value(w: np.ndarray) -> tuple[float, np.ndarray]:
            out = summed(mine, w, layers)
            return float(out[0] / out[1]), out[2:] / out[1]

        w = minimised(value, held.value, max_iter, tol)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["w"])

    found = packs.coalesce(1).mapInArrow(run, "w binary").first()["w"]
    held.destroy()
    return np.frombuffer(found)


class Failed(ArithmeticError):
    """A direction or a step can't be found."""


def minimised(value: Callable, x: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Breeze's L-BFGS: ``value`` gives a point's value and gradient. Ends after ``max_iter`` steps, when the value has changed by less than ``tol`` of the first
    one over 20 steps, when the gradient is short, or when a search fails twice in a row."""
    f, g = value(x)
    first, recent, steps, failed, k = f, [np.inf], [], False, 0
    while k < max_iter and not (len(recent) >= 2 and abs(f - max(recent)) <= tol * first) and np.linalg.norm(g) > max(tol * f, 1e-8):
        try:
            way = direction(steps, g)
            t, at = searched(value, x, f, g, way, 1.0 if k else 1 / np.linalg.norm(way))
            if t * np.linalg.norm(g) < 1e-10:
                raise Failed
        except Failed:
            if failed:
                break
            failed, steps = True, []
            continue
        failed = False
        new_f, new_g, new_x = at
        steps = [(new_x - x, new_g - g), *steps][:MEMORY]
        x, f, g, k = new_x, new_f, new_g, k + 1
        recent = [*recent, f][-20:]
    return x


def direction(steps: list, g: np.ndarray) -> np.ndarray:
    """The gradient times the negative inverse Hessian that the last steps suggest, the latest first."""
    scale = 1.0
    if steps:
        s, y = steps[0]
        scale = s @ y / (y @ y)
        if not s @ y >= 0:
            raise Failed
    out, shares = g.copy(), []
    for s, y in steps:
        shares.append(s @ out / (s @ y))
        if np.isnan(shares[-1]):
            raise Failed
        out -= shares[-1] * y
    out *= scale
    for (s, y), a in list(zip(steps, shares))[::-1]:
        out += (a - y @ out / (s @ y)) * s
    return -out


def searched(value: Callable, x: np.ndarray, f0: float, g0: np.ndarray, way: np.ndarray, t: float) -> tuple[float, tuple]:
    """A step along ``way`` that meets the strong Wolfe conditions, with value, gradient and place there."""
    slope = float(g0 @ way)
    if slope > 0:
        raise Failed
    at: list = []

    def phi(t: float) -> tuple[float, float, float]:
        new = x + way * t
        f, g = value(new)
        at[:] = f, g, new
        return t, float(g @ way), f

    def between(a: tuple, b: tuple) -> float:
        d1 = a[1] + b[1] - 3 * (a[2] - b[2]) / (a[0] - b[0])
        d2 = np.sqrt(d1 * d1 - a[1] * b[1])
        wide = b[0] - a[0]
        t = b[0] - wide * (b[1] + d2 - d1) / (b[1] - a[1] + 2 * d2)
        low, high = a[0] + 0.1 * wide, a[0] + 0.9 * wide
        return low if t < low else high if t > high else t

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(10):
            c = phi(between(high, low) if low[0] > high[0] else between(low, high))
            if c[2] > f0 + 1e-4 * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= 0.9 * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise Failed

    low = (0.0, slope, f0)
    for k in range(10):
        c = phi(t)
        if not np.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > f0 + 1e-4 * t * slope or c[2] >= low[2] and k:
            return zoom(low, c), tuple(at)
        if abs(c[1]) <= 0.9 * abs(slope):
            return c[0], tuple(at)
        if c[1] >= 0:
            return zoom(c, low), tuple(at)
        low, t = c, t * 1.5
    raise Failed


def scores(df: DataFrame, key: str, layers: list[int], w: np.ndarray) -> DataFrame:
    """``(id, score)``: the probability of class 1 of every row of ``df(key, features)``."""
    held = df.sparkSession.sparkContext.broadcast(w)
    schema = f"id {df.schema[key].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.exp(outputs(held.value, layers, *entries(batch))[-1][:, 1])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), pa.array(p)], names=["id", "score"])

    return sparse(df, key).mapInArrow(run, schema)
