"""Hard negatives against comparing everything, and the bounds of segment summaries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeproof.llm.catalog import ORACLES
from lakeproof.llm.negatives import (
    SEGMENTS, Blocks, Vectors, deal, hard_negatives, mine, products, summarise, summary_spans, tile_scores,
)
from lakeproof.llm.support import table
from tests.oracle import connect, differences

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, summary int, size int, anchor int, score int, window int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "v", 0, -1, 2, 3, 4) for r in rows], SCHEMA)


def plain(rows):
    """What must be found, with loops over all pairs."""
    kept = {}
    for key, vector, label in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole = [math.floor(256 * float(np.float32(x))) for x in vector]
            kept[key] = min(kept.get(key, (label, whole)), (label, whole))
    kept = {k: ((label + 1) % 10 if k % 7 == 0 else label, v) for k, (label, v) in kept.items()}
    found = []
    for a, (label, vector) in kept.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, w)), k, m == label) for k, (m, w) in kept.items() if k != a and len(w) == len(vector))
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            near = [(-s, k) for s, k, same in scored if not same and 30 * -p <= 100 * -s <= 90 * -p]
            found += [(a, positive, n + 1, k, -p, s) for n, (s, k) in enumerate(near[:10])]
    return sorted(found)


def vectors(count, size, labels, seed, step=1):
    draw = np.random.default_rng(seed)
    return [(k * step, [float(x) for x in np.round(draw.standard_normal(size) + 0.4, 1)], int(draw.integers(labels))) for k in range(count)]


ROWS = {
    "plain": vectors(400, 8, 3, 1),
    "many anchors": vectors(150, 5, 2, 2, step=50),
    "ties": [(k, [1.0, float(k % 2)], k % 4) for k in range(300)],
    "one hot vector": [(k, [0.5, 0.5, 0.5] if k % 3 else [0.3, 0.5, 0.6], k % 2) for k in range(600)],
    "sizes": [(k, [1.0] * (k % 5), k % 3) for k in range(0, 900, 20)],
    "awkward": [
        (0, None, 1), (100, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 1),
        (400, [float("inf"), 1.0], 2), (500, [], 1), (501, [], 1), (502, [], 2), (600, [1.0, 2.0], 1), (600, [1.0, 2.0], 1), (600, [2.0, 2.0], 0),
        (601, [1.0, 2.0], 0), (602, [0.5, 1.0], 3), (603, [1.0, 2.0], -1), (604, [-1.0, -1.0], 0), (-700, [-1.0, 0.0], 0), (605, [3e30, -3e30], 4), (700, [1.0, 1.0], 9),
    ],
    "none": [],
}
# a component beyond the bounds is held to them
CLAMPED = [(k, v and [x if x is None or not math.isfinite(x) else max(min(x, 32768.0), -32768.0) for x in v], m) for k, v, m in ROWS["awkward"]]


@pytest.mark.parametrize("name", ROWS)
@pytest.mark.parametrize("options", [{}, {"numbers": 40, "anchors_at_once": 2}])
def test_negatives_equal_comparing_everything(spark, name, options):
    rows = ROWS[name]
    found = hard_negatives(frame(spark, rows), **options)
    assert sorted(map(tuple, found.collect())) == plain(CLAMPED if name == "awkward" else rows)


def test_rounds_equal_sql(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = hard_negatives(table(spark, sf_dir, "embeddings"), numbers=64 * 40)
    assert differences(connect(sf_dir), found, ORACLES["op12_segment_negatives"]) == []


def test_other_questions(spark):
    rows = vectors(60, 4, 2, 5)
    found = mine(frame(spark, rows), F.col("vec_id") < 3, positives=1, negatives=2, low=-1000, high=1000).collect()
    assert {r["anchor_id"] for r in found} == {0, 1, 2} and len(found) == 6


def test_rounds_and_blocks():
    assert Blocks(1, 5).rounds() == [(0, 5)] and Blocks(1, 100).rounds() == [(0, 4), (4, 100)]
    assert Blocks(2, 5000).rounds() == [(0, 5), (5, 157), (157, 5000)]
    assert deal(513, 51_282, 64, 12) == Blocks(1, 12) and deal(10**7, 10**9, 64, 200) == Blocks(2442, 30518)


@pytest.mark.parametrize("size", [0, 1, 3, 16, 50])
def test_summaries_bound_products(size):
    draw = np.random.default_rng(size)
    left, right = (draw.integers(-300, 300, (40, size)) + draw.integers(-200, 200, (40, 1)) for _ in range(2))
    exact = products(left, right)
    a, b = summarise(left), summarise(right)
    assert a.shape[1] == summary_spans(size)[-1][2] == 2 * sum(min(s, max(size, 1)) for s in SEGMENTS)
    widths = []
    for start, middle, end in summary_spans(size):
        means, spread = a[:, start:middle] @ b[:, start:middle].T, a[:, middle:end] @ b[:, middle:end].T
        assert (exact <= means + spread + 1e-3).all() and (exact >= means - spread - 1e-3).all()
        widths.append(spread.sum())
    assert widths == sorted(widths, reverse=True)  # finer summaries bound no worse


def test_only_what_bounds_let_pass_is_scored(monkeypatch):
    draw = np.random.default_rng(3)
    level = draw.integers(-200, 200, (64, 1))
    numbers = np.repeat(level, 32, axis=1) + draw.integers(-2, 3, (64, 32))
    some = Vectors(np.arange(64), np.zeros(64), numbers, summarise(numbers))
    exact = products(numbers, numbers)
    least = np.sort(exact, axis=1)[:, -2]
    seen = []
    scored = np.einsum
    monkeypatch.setattr("lakeproof.llm.negatives.np.einsum", lambda *a: seen.append(len(a[1])) or scored(*a))
    monkeypatch.setattr("lakeproof.llm.negatives.products", lambda *a: pytest.fail("scored a whole tile"))
    a, r, scores = tile_scores(some, some, np.ones((64, 64), bool), least, np.full(64, 1 << 62))
    assert seen[-1] < 64 * 64 / 16 and sorted(zip(a, r)) == sorted(zip(*np.nonzero(exact >= least[:, None]))) and (scores == exact[a, r]).all()


def test_large_numbers_are_exact():
    left = np.array([[1 << 23, 3, -(1 << 23)] * 1000])
    right = np.array([[1 << 23, -5, (1 << 23) - 1] * 1000])
    assert products(left, right)[0, 0] == sum(int(x) * int(y) for x, y in zip(left[0], right[0]))
