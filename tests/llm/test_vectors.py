"""Linked vectors against brute force."""

import math

import numpy as np

from lakeproof.llm import vectors
from lakeproof.llm.vectors import calibrate, link_vectors, same_cell, usable


def brute(rows):
    good = [usable(v) for _, v in rows]
    links = [[] for _ in rows]
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and good[i] and good[j] and len(a) == len(b) and rows[i][0] is not None and rows[j][0] is not None:
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95 - 1e-12:
                    links[i].append(j)
    result = []
    for i, (vec_id, _) in enumerate(rows):
        reach, waiting = {i}, [i]
        while waiting:
            for j in links[waiting.pop()]:
                if j not in reach:
                    reach.add(j)
                    waiting.append(j)
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        result.append((str(vec_id), len(links[i]), str(least), vec_id is not None and vec_id == least))
    return sorted(result)


def found(frame):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in frame.collect())


def sample():
    draw = np.random.default_rng(5)
    rows = [(k, draw.standard_normal(32).astype(np.float32).tolist()) for k in range(60)]
    for group in range(8):
        centre = draw.standard_normal(32)
        rows += [(100 + 20 * group + k, (centre + 0.1 * draw.standard_normal(32)).astype(np.float32).tolist()) for k in range(12)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (501, rows[3][1]), (502, [2 * x for x in rows[3][1]])]
    rows += [(600, None), (601, []), (602, [0.0] * 32), (603, [math.nan] * 32), (604, [math.inf] + [1.0] * 31), (605, [None] + [1.0] * 31)]
    rows += [(700, [1.0, 2.0]), (701, [1.0, 2.0001]), (None, rows[3][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 0, 1, "t") for i, v in rows], "vec_id bigint, embedding array<float>, label int, links int, cell string"
    )


def test_links_equal_brute_force(spark):
    rows = sample()
    assert found(link_vectors(frame(spark, rows).repartition(4), missed=1e-9)) == brute(rows)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 5)
    rows = sample()
    assert found(link_vectors(frame(spark, rows).repartition(4), missed=1e-9)) == brute(rows)


def test_nothing_in_nothing_out(spark):
    assert link_vectors(frame(spark, [])).collect() == []


def test_plan_keeps_its_promise():
    draw = np.random.default_rng(1)
    plan = calibrate(2000, missed=0.02)
    x = vectors.unit(draw.standard_normal((3000, 64)))
    y = draw.standard_normal((3000, 64))
    y = vectors.unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    near = 0.95 * x + math.sqrt(1 - 0.95**2) * y
    met = (plan.keys(x) == plan.keys(near)).any(axis=1)
    assert 0.96 < met.mean()
    assert abs((plan.keys(x)[:, 0] == plan.keys(near)[:, 0]).mean() - same_cell(math.sqrt(0.1)) ** plan.width) < 0.03
    windows = plan.directions(64)[2]
    counts = [vectors._shared_windows(np.stack([a, b]) @ windows, plan.reach)[0, 1] for a, b in zip(x[:300], near[:300])]
    assert min(counts) >= plan.count
    assert counts == [(np.abs((a - b) @ windows) <= plan.reach).sum() for a, b in zip(x[:300], near[:300])]
