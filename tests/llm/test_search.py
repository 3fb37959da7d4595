"""Nearest neighbours by Hilbert curves against all pairs."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from histlens.llm import hilbert_ann

SCHEMA = "vec_id long, embedding array<float>"


def check(got, want, tolerance=1e-9):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(q for q, w in want.items() if w)
    for q, rows in by.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(want[q]) + 1))
        assert [r.vec_id for r in rows] == [i for i, _ in want[q]]
        assert np.allclose([r.score for r in rows], [s for _, s in want[q]], atol=tolerance)


def test_small_tables_are_exact(spark):
    """Few vectors fall into one window: the result is that of all pairs, ties included."""
    rng = np.random.default_rng(1)
    x = {i: rng.normal(size=8).astype(np.float32) for i in range(200)}
    for i in (20, 40, 41, 77, 120, 140):
        x[i] = x[7]                             # copies of one vector, queries among them
    rows = [(i, v.tolist()) for i, v in x.items()]
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)          # and repeated rows
    got = hilbert_ann.nearest(df, F.col("vec_id") % 20 == 0, top=20).collect()
    check(got, brute.nearest(x, [i for i in x if i % 20 == 0], 20))


def test_common_vector_and_few_candidates(spark):
    x = {i: [1.0, 0.0] for i in range(100)}
    x[200], x[201] = [0.0, 1.0], [-1.0, 0.5]
    df = spark.createDataFrame([(i, v, "n") for i, v in x.items()], SCHEMA + ", score string")
    check(hilbert_ann.nearest(df, F.col("vec_id") % 20 == 0, top=5).collect(), brute.nearest(x, [0, 20, 40, 60, 80, 200], 5))
    three = {20: [1.0], 1: [2.0], 2: [-1.0]}
    check(hilbert_ann.nearest(spark.createDataFrame(list(three.items()), SCHEMA), F.col("vec_id") % 20 == 0).collect(), brute.nearest(three, [20], 20))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, None), (3, []), (40, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (None, [1.0, 1.0]), (60, [1.0, 1.0, 1.0]), (8, [-1.0, -1.0])]
    got = hilbert_ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    check(got, brute.nearest({0: [1, 2], 1: [2, 1], 8: [-1, -1]}, [0], 20))
    assert hilbert_ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    assert hilbert_ann.nearest(spark.createDataFrame(rows[2:5], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_curve_visits_neighbouring_cells(dims, bits):
    n = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(n)] * dims), -1).reshape(-1, dims)
    key = hilbert_ann.hilbert_key(cells, bits)
    order = np.argsort(key)
    assert sorted(key.tolist()) == list(range(n**dims))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_recall_with_many_blocks(spark):
    """Windows much smaller than the table still find most neighbours."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = hilbert_ann.nearest(df, F.col("vec_id") % 20 == 0, block=200).collect()
    s = x.astype(np.float64) @ x.T
    hits = sum(s[r.query_id, r.vec_id] >= np.sort(np.delete(s[r.query_id], r.query_id))[-20] - 1e-12 for r in got)
    assert len(got) == 200 * 20 and hits >= 0.9 * len(got)


@pytest.mark.parametrize("values", [1 << 21, 16_000])
def test_windows_grow_until_recall_holds(spark, monkeypatch, values):
    """The smallest block is far too narrow for this table: wider blocks, or more of them, are looked into."""
    monkeypatch.setattr(hilbert_ann, "BLOCK_VALUES", values)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = hilbert_ann.nearest(df, F.col("vec_id") % 20 == 0, block=16).collect()
    s = x.astype(np.float64) @ x.T
    hits = sum(s[r.query_id, r.vec_id] >= np.sort(np.delete(s[r.query_id], r.query_id))[-20] - 1e-12 for r in got)
    assert len(got) == 300 * 20 and hits >= 0.9 * len(got)


def test_windows_from_narrow_to_all_rows():
    tried = list(hilbert_ann.windows(16, 64, 1000))
    assert tried[0] == (16, 1) and tried[-1][0] * tried[-1][1] >= 1000
    assert all(a[0] * a[1] < b[0] * b[1] for a, b in zip(tried, tried[1:])) and max(b for b, _ in tried) == 64
    assert list(hilbert_ann.windows(1536, 32768, 500)) == [(1536, 1)]
