"""Hard negatives against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import negatives
from kpiloom.llm.negatives import LEVELS, hard_negatives, summary, survivors, window

SCHEMA = "vec_id long, embedding array<double>, label long, row string, v int, label_key string, k int"


def frame(spark, rows):
    """Columns beside the three are named as the operator names its own."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def wanted(rows):
    fine = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for a, (i, v, label) in enumerate(fine):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other == label) for b, (j, w, other) in enumerate(fine) if b != a and len(w) == len(v)]
        for p, positive, same in sorted(s for s in scored if s[2])[:5]:
            rest = sorted((n, j) for n, j, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p)[:10]
            for rank, (n, j) in enumerate(rest, 1):
                out[i, positive, rank, j, -p, -n] += 1
    return out


def table(seed, n, dim, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        x = centres[i % 6] + rng.standard_normal(dim) * rng.choice([0.1, 1.0])
        rows.append((i, (x / np.linalg.norm(x)).tolist(), int(rng.integers(labels))))
    return rows


ODD = [
    (1000, None, 1),
    (1100, [0.1] * 12, None),
    (1200, [0.1] * 11 + [None], 1),
    (1300, [0.1] * 11 + [math.nan], 1),
    (1400, [math.inf] + [0.1] * 11, 1),
    (None, [0.1] * 12, 1),
    (1500, [0.0] * 12, 2),
    (1600, [0.3, 0.1], 1),
    (1601, [0.3, 0.1], 2),
    (1602, [0.3, 0.0], 1),
    (1700, [], 1),
    (1701, [], 1),
    (1702, [], 2),
    # The same row four times, two of them anchors' twins, and ties of score.
    *[(1800, [0.2] * 12, 1)] * 4,
    *[(1801 + i, [0.1] * 12, 2 + i % 2) for i in range(30)],
    # Products beyond what a double holds exactly.
    (1900, [3.0e5, 3.0e5 + 1.1, 1.0, 2.0, 5.5], 3),
    *[(1901 + i, [3.0e5 + i, 3.0e5, 1.0, 2.0, i / 7], 3) for i in range(8)],
    *[(1920 + i, [2.0e5 + i / 3, 2.0e5, 1.0, 2.0, i / 9], 4) for i in range(15)],
]


def result(spark, rows):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(tuple(r) for r in hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, label=label).collect())


def test_negatives_by_brute_force(spark):
    rows = table(1, 700, 12) + ODD
    random.Random(1).shuffle(rows)
    assert result(spark, rows) == wanted(rows)


def test_many_cells_give_the_same(spark, monkeypatch, many_partitions):
    rows = table(2, 500, 40) + ODD
    for name, value in {"ANCHORS": 2, "ROWS": 60, "STEP": 17, "PAIRS": 50}.items():
        monkeypatch.setattr(negatives, name, value)
    assert result(spark, rows) == wanted(rows)


def test_empty_table(spark):
    assert not result(spark, []) and not result(spark, [(1, [0.5], 1)])


@pytest.mark.parametrize("dim", [1, 3, 16, 17, 64])
def test_summaries_bound_every_product(dim):
    rng = np.random.default_rng(dim)
    x, y = (rng.integers(-300, 300, (50, dim)).astype(float) for _ in range(2))
    exact, spread = x @ y.T, None
    for parts in LEVELS:
        (m, d), (m2, d2) = summary(x, parts), summary(y, parts)
        middle, reach = m @ m2.T, d @ d2.T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        assert spread is None or (reach <= spread + 1e-6).all()
        spread = reach


def test_bounds_leave_few_pairs_to_multiply(monkeypatch):
    """Smooth vectors are told apart by their summaries."""
    rng = np.random.default_rng(3)
    base = np.repeat(rng.integers(-200, 200, (400, 8)), 8, axis=1)

    class Plain:
        def __init__(self, x):
            self.whole, self.x = x, x.astype(float)
            self.norm = np.sqrt((self.x**2).sum(axis=1))
            self.levels = [summary(self.x, p) for p in LEVELS]

    anchors, rows = Plain(base[:20] + rng.integers(-5, 5, (20, 64))), Plain(base + rng.integers(-5, 5, (400, 64)))
    counted, plain = [], negatives._products
    monkeypatch.setattr(negatives, "_products", lambda x, y, a, b: counted.append(len(a)) or plain(x, y, a, b))
    low = np.full(20, 1_000_000)
    a, b, score = survivors(anchors, rows, np.ones((20, 400), bool), low, np.full(20, 2**62))
    exact = anchors.whole @ rows.whole.T
    assert sorted(zip(a, b)) == sorted(zip(*np.nonzero(exact >= 1_000_000))) and (score == exact[a, b]).all()
    assert counted[-1] < counted[0] / 8


def test_windows_are_whole_scores():
    p = np.array([-7, -1, 0, 1, 99, 100, 12345, 2**61 + 3])
    low, high = window(p)
    for x, a, b in zip(p.tolist(), low.tolist(), high.tolist()):
        assert 100 * a >= 30 * x > 100 * (a - 1) and 100 * b <= 90 * x < 100 * (b + 1)
