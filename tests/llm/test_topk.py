import math
import random

import numpy as np

from dimweave.llm import topk


def brute(rows, k):
    ok = [(v, [math.floor(1024 * c) for c in x]) for v, x in rows
          if v is not None and x and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for q, qx in sorted({(v, tuple(x)) for v, x in ok if v % 100 == 0}):
        found = sorted(((-sum(a * b for a, b in zip(qx, x, strict=True)), v) for v, x in ok if v != q and len(x) == len(qx)))[:k]
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(found)]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame([(v, x, "z") for v, x in rows], "vec_id long, embedding array<double>, score string")
    return sorted(map(tuple, topk.top_k(df, df.where("vec_id % 100 = 0"), k).collect()))


def test_random_vectors(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([.01, 1, 30]) for _ in range(9)]) for i in range(700)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]  # ties
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_edge_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, -1.0]), (100, [0.0, 0.0]), (200, [1.0]), (300, None), (400, [nan, 1.0]), (500, []), (600, [None, 1.0]), (700, [inf, 1.0]),
            (None, [1.0, 1.0]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-1e4, 1e4]), (100, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_bitmap_sums_and_selection():
    rng = np.random.default_rng(1)
    cells = rng.integers(-900, 900, (333, 12))
    block = topk.SlicedBlock(cells)
    everyone = np.packbits(np.arange(block.words * 64) < 333, bitorder="little").view(np.uint64)
    for _ in range(20):
        q = rng.integers(-500, 500, 12)
        high = (cells - block.low) >> block.shift
        want = (np.abs(q) * np.where(q < 0, (1 << block.bits) - 1 - high, high)).sum(axis=1)
        got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:333].astype(np.int64) << j for j, s in enumerate(block.scores(q)))
        assert (got == want).all()
        rows = block.top(q, everyone, 10)
        assert set(np.argsort(-(cells @ q), kind="stable")[:10]) <= set(rows) and len(rows) < 200
