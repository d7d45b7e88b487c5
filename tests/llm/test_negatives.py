"""op12 against brute force: given sizes, ties, repeated rows, nulls, several chunks, large numbers."""

from collections import Counter

import numpy as np
import pytest

from tessella.llm import negatives as n

KIND = "vec_id long, label int, embedding array<double>, anchor string, chunk int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, l, v, "x", 9) for i, l, v in rows], KIND).repartition(parts)


def brute(rows, k=5):
    used = []
    for i, label, v in rows:
        if label is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        used.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(int(np.floor(256 * c)) for c in v)))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = Counter()
    for i, label, a in {r for r in used if r[0] is not None and r[0] % 100 == 0}:
        scored = [(j, sum(p * q for p, q in zip(a, x)), m) for j, m, x in used if len(x) == len(a)]
        for p in sorted((s for s in scored if s[2] == label and s[0] != i), key=order)[:k]:
            fits = sorted((s for s in scored if s[2] != label and 80 * p[1] <= 100 * s[1] <= 100 * p[1]), key=order)[:k]
            out.update((i, p[0], rank, s[0], p[1], s[1]) for rank, s in enumerate(fits, 1))
    return out


def found(spark, rows, **more):
    return Counter(map(tuple, n.hard_negatives(frame(spark, rows), **more).collect()))


@pytest.mark.parametrize("spread", [0.1, 0.01])
def test_rows_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(n, "_BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(0, 3)), [float(c) for c in rng.standard_normal(8) * spread]) for i in range(1000)]
    rows += [(i, l, v) for i, l, v in rows[:150]]  # repeated rows
    rows += [(7 + i, 1, list(rows[0][2])) for i in range(40)]  # a common vector: ties
    rows += [(None, 1, rows[5][2]), (5, None, rows[5][2]), (6, 1, None), (8, 1, [None] * 8), (9, 2, [float("nan")] * 8), (200, 1, [0.0] * 8), (300, 2, [1.0]), (301, 2, [1.0]), (302, 1, [0.9]), (400, 1, []), (401, 1, []), (402, 2, [])]
    want = brute(rows)
    assert len(want) > 50
    assert found(spark, rows) == want
    assert found(spark, rows, chunk_bytes=2000) == want


def test_large_numbers_are_exact(spark):
    rows = [(0, 1, [1e7, -3e6]), (1, 1, [8.9e6, 1.5]), (2, 2, [9e6, 1.25]), (3, 1, [9e6, 1.25]), (4, 3, [9e6, 1.245]), (100, 2, [-1e7, 1e7])]
    assert found(spark, rows) == brute(rows) and brute(rows)


def test_no_rows(spark):
    for rows in ([], [(0, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [1.0])]):
        assert found(spark, rows) == Counter()


def test_threshold_leaves_rows_unscored():
    """Where anchors point along few dimensions, the threshold falls below the bar before all rows are read."""
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.standard_normal((4096, 4)) * np.array([1, 1e-2, 1e-2, 1e-2]))
    chunk = n.Chunk(np.array([0]), np.array([-1]), np.array([1]), np.array([[300.0, 1, 1, 1]]), np.array([[-np.inf]]), np.array([[np.inf]]))
    best = n.Best(chunk, 5)
    ids = np.arange(4096)
    taken = n.search_block(chunk, best, ids, np.zeros(4096, bool), np.ones(4096, int), x, n.SAME)
    scores = x @ chunk.x[0]
    assert list(best.row_id) == list(np.lexsort((ids, -scores))[:5]) and taken < 2048
    assert n.search_block(chunk, best, ids, np.zeros(4096, bool), np.ones(4096, int), x - 4096, n.SAME) == 0
