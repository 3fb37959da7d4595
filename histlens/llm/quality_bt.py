"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is a linear score of its text features.  From pairs
(better, worse) of labelled documents the weights are learned by logistic loss
on feature differences.  Scores are mapped to 0..1 so that the decision value
(0.3) is the score quantile that splits the training documents as their labels do.

All labelled training documents are learned from, every better one paired with
every worse one, in passes of sums over their stored features.  Every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlens.llm.common import Stages, byte_texts, forget_kept, slices, train_rows, with_text

DECISION = 0.3
L2 = 1e-3
BITS = 20                   # binary places that the sums of the passes are kept to
_COLUMNS = 256              # more than the sums that a bin has

_CLASS = np.full(256, 6, np.int64)                       # punctuation and control bytes
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_CLASS[128:] = 5
_MARKS = np.frombuffer(b"!?.,|:;-_/@#$%&*=<>()[]{}'\"+~", np.uint8)


def features(text: bytes) -> np.ndarray:
    """Numbers that describe a text's form; all zeros but the last for an empty text."""
    n = len(text)
    ws = text.split()
    if not ws:
        return np.append(np.zeros(_SIZE - 1), 1.0)
    raw = np.frombuffer(text, np.uint8)
    by = np.bincount(raw, minlength=256)
    kinds = np.bincount(_CLASS, by, 7) / n
    marks = by[_MARKS] / len(ws)
    distinct = len(set(ws))
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b";", b'"') for x in lines) / len(lines)
    pairs = list(zip(ws, ws[1:]))
    same = sum(a == b for a, b in pairs) / max(1, len(pairs))
    lens = np.fromiter(map(len, ws), np.float64, len(ws))
    p = by[by > 0] / n
    w = len(ws)
    return np.concatenate([
        kinds, np.minimum(marks, 4.0),
        [np.log1p(w) / 10, w < 20, w < 60, distinct / w, (1 - distinct / w) * np.log1p(w) / 10, len(set(pairs)) / max(1, len(pairs)),
         same, len(set(lines)) / len(lines), np.log1p(len(lines)) / 10, min(50.0, w / len(lines)) / 50, ends,
         min(30.0, lens.mean()) / 30, min(30.0, lens.std()) / 30, min(200.0, lens.max()) / 200, (lens > 25).mean(), (lens <= 2).mean(),
         -(p * np.log2(p)).sum() / 8, sum(x.isupper() for x in ws) / w, sum(x.isdigit() for x in ws) / w,
         sum(x[:1].isalpha() or x[:1] > b"\x7f" for x in ws) / w],
        [0.0]])


_SIZE = 7 + len(_MARKS) + 20 + 1


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float                  # the strength that gets the score DECISION


def strength(m: Model, x: np.ndarray) -> np.ndarray:
    return _weighted(np.clip((x - m.mean) / m.scale, -6, 6), m.weights)


def _weighted(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """z @ w, a row's result the same wherever it stands."""
    return (z * w).sum(-1)


def to_score(m: Model, s: np.ndarray) -> np.ndarray:
    """Logistic of the strength, shifted so that ``cut`` scores DECISION."""
    z = np.clip(s - m.cut + np.log(DECISION / (1 - DECISION)), -35, 35)
    return 1 / (1 + np.exp(-z))


def _binned(bins: np.ndarray, y: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``cols`` by bin and label: (keys, values), a key being (bin, label, column)."""
    at, inv = np.unique(2 * bins + y, return_inverse=True)
    out = np.zeros((len(at), cols.shape[1]), np.int64)
    np.add.at(out, inv, cols)
    return (at[:, None] * _COLUMNS + np.arange(cols.shape[1])).ravel(), out.ravel()


def _unbinned(keys: np.ndarray, values: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, sums) of the sums of ``_binned``, a row each."""
    order = np.argsort(keys, kind="stable")
    at = keys[order][::columns] // _COLUMNS
    return at >> 1, at & 1, values[order].reshape(-1, columns)


def _whole(x: np.ndarray) -> np.ndarray:
    """Numbers as integers of 2 ** -BITS, so that their sums are the same in any order."""
    return np.rint(np.ldexp(x, BITS)).astype(np.int64)


def _minimise(f: Callable, w: np.ndarray, root: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with backtracking; ``root`` is the Cholesky factor of a bound of the second derivatives."""
    val, g = f(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(g).max() < 1e-5:
            break
        q, alpha = g.copy(), []
        for s, y in reversed(past):
            alpha.append(s @ q / (s @ y))
            q -= alpha[-1] * y
        q = np.linalg.solve(root.T, np.linalg.solve(root, q))
        if past:
            s, y = past[-1]
            q *= s @ y / (y @ np.linalg.solve(root.T, np.linalg.solve(root, y)))
        for (s, y), al in zip(past, reversed(alpha)):
            q += (al - y @ q / (s @ y)) * s
        t = 1.0
        while True:
            new = w - t * q
            new_val, new_g = f(new)
            if new_val <= val - 1e-4 * t * (g @ q):
                break
            t /= 4
            if t < 1e-3:
                return w
        if (new - w) @ (new_g - g) > 0:
            past = [*past[1 - memory:], (new - w, new_g - g)]
        w, val, g = new, new_val, new_g
    return w


def _learn(sums: Callable, share_worse: float, steps: int = 25) -> Model:
    """The model of all rows.  ``sums(count)`` adds up what ``count(labels, features)`` gives for parts of them: whole
    numbers under whole keys.

    The loss is that of every pair of a better and a worse document.  Rows are summed by label and bins of 1/32 of
    strength: a bin's rows meet those of another at the bins' mean strengths, so a pass over the rows costs the
    same for all pairs as for one each."""
    zero = np.zeros(_SIZE)
    none = np.log(DECISION / (1 - DECISION))
    _, label, got = _unbinned(*sums(lambda y, x: _binned(np.zeros(len(y), np.int64), y, np.hstack([np.ones((len(y), 1), np.int64), _whole(x), _whole(x * x)]))), 2 * _SIZE + 1)
    if not len(got):
        return Model(zero, zero + 1e-3, zero, none)
    n, unit = got[:, 0].sum(), 2.0**-BITS
    mean = got[:, 1 : _SIZE + 1].sum(0) * unit / n
    scale = np.sqrt(np.maximum(got[:, _SIZE + 1 :].sum(0) * unit / n - mean**2, 0)) + 1e-3
    if len(label) < 2:
        return Model(mean, scale, zero, none)

    def clipped(x):
        return np.clip((x - mean) / scale, -6, 6)

    def products(y, x):
        z = np.rint(clipped(x) * 1024)                  # products of whole numbers: exact in any order
        keys, values = [], []
        for c in (0, 1):
            of = np.hstack([z[y == c], np.full((int((y == c).sum()), 1), 1024.0)])
            keys.append(c * (_SIZE + 1) ** 2 + np.arange((_SIZE + 1) ** 2))
            values.append((of.T @ of).ravel().astype(np.int64))
        return np.concatenate(keys), np.concatenate(values)
    keys, values = sums(products)
    second = np.zeros(2 * (_SIZE + 1) ** 2)
    second[keys] = values
    second = second.reshape(2, _SIZE + 1, _SIZE + 1)
    second /= second[:, -1:, -1:]
    m0, m1 = second[0, -1, :-1], second[1, -1, :-1]
    apart = second[0, :-1, :-1] + second[1, :-1, :-1] - np.outer(m0, m1) - np.outer(m1, m0)      # of all pairs' differences
    root = np.linalg.cholesky(apart / 4 + (L2 + 1e-9) * np.eye(_SIZE))

    def loss(w):
        def strengths(y, x):
            z = clipped(x)
            t = _whole(_weighted(z, w))
            return _binned(t >> (BITS - 5), y, np.hstack([np.ones((len(y), 1), np.int64), t[:, None], _whole(z)]))
        _, y, got = _unbinned(*sums(strengths), _SIZE + 2)
        (c1, s1, x1), (c0, s0, x0) = ((g[:, 0] / g[:, 0].sum(), g[:, 1] * unit / g[:, 0], g[:, 2:] * unit / g[:, :1]) for g in (got[y == 1], got[y == 0]))
        gap = s1[:, None] - s0
        lost = 1 / (1 + np.exp(np.clip(gap, -35, 35)))
        grad = c0 @ (x0 * (c1 @ lost)[:, None]) - c1 @ (x1 * (lost @ c0)[:, None])
        return c1 @ np.logaddexp(0, -gap) @ c0 + L2 / 2 * w @ w, grad + L2 * w
    w = _minimise(loss, zero, root, steps)

    # the quantile of the training strengths that leaves share_worse below it: bins first, then the values of one bin
    def counts(low, shift, width):
        def count(y, x):
            t = _whole(_weighted(clipped(x), w))
            if low is not None:
                t, y = t[(t >= low) & (t < low + width)], y[(t >= low) & (t < low + width)]
            return _binned(t >> shift, y, np.ones((len(y), 1), np.int64))
        return _unbinned(*sums(count), 1)
    size = dict(zip(label.tolist(), got[:, 0].tolist()))
    below, at, shift = 0.0, None, 13
    for low, shift, width in ((None, 13, 0), ("bin", 0, 1 << 13)):
        bins, y, c = counts(low if low is None else at << 13, shift, width)
        weight = np.where(y == 1, (1 - share_worse) / size[1], share_worse / size[0]) * c[:, 0]
        values, inv = np.unique(bins, return_inverse=True)
        total = below + np.cumsum(np.bincount(inv, weight))
        k = min(int(np.searchsorted(total, share_worse + 1e-9, side="right")), len(values) - 1)
        at, below = int(values[k]), float(total[k - 1]) if k else below
    return Model(mean, scale, w, (at - 0.5) * unit)


def fit_pairs(better: np.ndarray, worse: np.ndarray, share_worse: float) -> Model:
    """Learn from feature rows of better and worse documents, from every pair.

    Without documents on one side every text scores 0.5.
    """
    x = np.concatenate([better, worse]) if len(better) + len(worse) else np.zeros((0, _SIZE))
    y = np.repeat([1, 0], [len(better), len(worse)])
    return _learn(lambda count: count(y, x), share_worse)


def _task_sums(rows: DataFrame, count: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Sums of count(labels, features) over all rows: a task sends its own sums, Spark adds them up by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if b.num_rows:
                k, v = count(b.column(0).to_numpy().astype(np.int64), b.column(1).flatten().to_numpy().reshape(b.num_rows, -1))
                keys, inv = np.unique(np.concatenate([keys, k]), return_inverse=True)
                added = np.zeros(len(keys), np.int64)
                np.add.at(added, inv, np.concatenate([sums, v]))
                sums = added
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["k", "v"])
    got = rows.mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    return got.column("k").to_numpy(), got.column("v").to_numpy()


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Learn from all labelled rows with crc32(id) mod 5 <> 0.

    Their features are stored once; sums over them by bins of strength reach the driver, of a size that does not
    depend on the number of rows.  Rows without a label or id are not learned from; of several labels of an id the
    smallest counts, and of several texts that with the smallest features.
    """
    known = (labels.filter(F.col(label_col).isNotNull() & train_rows(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))).filter("label in (0, 1)")
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    learn = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).filter(F.col("id").isNotNull() & train_rows(F.col("id")))
    # features are narrower than texts: they, not the texts, meet the labels
    rows = score_features(learn, "_text").join(known, "id").groupBy("id").agg(F.min("label").alias("label"), F.min("x").alias("x"))
    st = Stages(docs.sparkSession, "quality")
    try:
        stored = st.write(rows.select(F.col("label").cast("int").alias("label"), "x"), "rows")
        total = shares.get(0, 0) + shares.get(1, 0)
        return _learn(lambda count: _task_sums(stored, count), shares.get(0, 0) / total if total else 0.0)
    finally:
        st.drop()


def score_features(rows: DataFrame, text_col: str) -> DataFrame:
    """The other columns and x, the features of the last column, a text."""
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "x array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for b in slices(batches):
            x = pa.array([features(t) for t in byte_texts(b, text_col)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], x], [*b.schema.names[:-1], "x"])
    return rows.mapInArrow(run, out)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """``keep`` columns, score, predicted: one row per document, null and empty texts included
    (a null text is an empty one).  Equal texts have equal scores."""
    src, text = with_text(docs, keep, text_col)
    n = len(keep)
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:n]) + "score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for b in slices(batches):
            ts = byte_texts(b, text)
            s = to_score(model, strength(model, np.array([features(t) for t in ts]))) if ts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(s), pa.array((s >= DECISION).astype(np.int32))],
                                             [*b.schema.names[:n], "score", "predicted"])
    return src.mapInArrow(run, out)
