import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeproof.operators import quantiles
from lakeproof.operators.profile import profile_numeric
from lakeproof.operators.quantiles import exact_quantiles

TENTHS = [f"0.{i}" for i in range(1, 10)]


def brute(values, p):
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    rank = max(1, -(-int(p[2:]) * len(ordered) // 10))
    return ordered[rank - 1]


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


many_columns = st.lists(st.lists(st.floats(width=64), min_size=30, max_size=30), min_size=10, max_size=10)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(many_columns)
def test_equals_sorting(spark, columns):
    names = [f"v{i}" for i in range(len(columns))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"{n} double" for n in names))
    found = exact_quantiles(df, names, TENTHS)
    assert all(same(found[n, p], brute(values, p)) for n, values in zip(names, columns) for p in TENTHS)


@pytest.mark.parametrize("values", [
    [1.0] * 500 + [2.0] * 3 + [1e300, -1e300],
    [float("inf"), float("-inf"), 0.0, 1.0, float("nan"), float("nan")],
    list(np.random.default_rng(1).lognormal(0, 8, 3000)),
    [1.7e308, -1.7e308, 0.0, 5e-324, -5e-324, 1.0],
    [7.0],
])
def test_hard_distributions(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    found = exact_quantiles(df, ["v"], TENTHS)
    assert all(same(found["v", p], brute(values, p)) for p in TENTHS)


def test_heavy_tail_takes_few_passes(spark, monkeypatch):
    passes = []
    split = quantiles._split_brackets
    monkeypatch.setattr(quantiles, "_split_brackets", lambda *a: passes.append(1) or split(*a))
    values = [float(v) for v in np.random.default_rng(2).lognormal(0, 20, 5000)]
    found = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], TENTHS)
    assert all(found["v", p] == brute(values, p) for p in TENTHS)
    assert len(passes) <= 6


def test_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, None), (3, None, 6)], "k int, a double, b int")
    found = exact_quantiles(df, ["a", "b"], ["0.5"])
    assert found["a", "0.5"] is None
    assert found["b", "0.5"] == 5.0


def test_approximate_agrees_on_small_data(spark):
    df = spark.range(1, 1001).selectExpr("id", "id * 2.5 as v")
    exact, approx = (
        {(r.column_name, r.variable): r.value for r in profile_numeric(df, "id", "s", "t", method).collect()}
        for method in ("exact", "approx")
    )
    assert exact == approx


def test_wide_table(spark):
    df = spark.range(300).selectExpr("id", *[f"id * {i} as c{i}" for i in range(1, 161)])
    rows = {(r.column_name, r.variable): r.value for r in profile_numeric(df, "id", "s", "t").collect()}
    assert len(rows) == 160 * 14
    assert rows["c160", "50th_percentile"] == 149 * 160
