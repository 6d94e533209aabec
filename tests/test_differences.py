"""Where two copies differ, found without looking at equal ranges, and fair samples."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeproof.operators.differences import Range, compare_keys, differences, unequal_ranges, within
from lakeproof.operators.infer import infer_sql_types
from lakeproof.operators.sampling import fair_sample


def plain(source, target, width):
    """What differs by key, with dictionaries."""
    sides = [{}, {}]
    for rows, side in zip((source, target), sides):
        for row in rows:
            side.setdefault(row[:width], Counter())[row] += 1
    found = []
    for key in {*sides[0], *sides[1]}:
        old, new = (side.get(key, Counter()) for side in sides)
        if old != new:
            state = "added" if not old else "lost" if not new else "changed"
            changed = None
            if old.total() == new.total() == 1:
                changed = ",".join("ab"[k] for k, (x, y) in enumerate(zip([*old][0][width:], [*new][0][width:])) if x != y)
            found.append((*key, state, old.total(), new.total(), changed))
    return sorted(found, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


SCHEMA = "k bigint, n int, a string, b double"
CASES = {
    "equal": ([(k, 0, "x", 1.0) for k in range(300)], lambda rows: list(rows)),
    "clusters": ([(k, k % 2, f"t{k}", float(k)) for k in range(3000)], lambda rows: [
        (k, n, a if not 100 <= k < 104 else None, b + (2000 <= k < 2003)) for k, n, a, b in rows if not 1500 <= k < 1510] + [(9000, 1, "new", None)]),
    "everywhere": ([(k, 0, "x", float(k)) for k in range(500)], lambda rows: [(k, n, a, b + 1) for k, n, a, b in rows]),
    "one hot key": ([(7, k, "x", 0.0) for k in range(2000)] + [(k, 0, "y", 0.0) for k in range(1000)], lambda rows: [r for r in rows if r[:2] != (7, 1234)]),
    "nulls": ([(None, k, "x", None) for k in range(20)] + [(k, None, None, 1.0) for k in range(400)], lambda rows: [
        (k, n, "z" if (k, n) == (None, 3) else a, b) for k, n, a, b in rows if (k, n) != (5, None)]),
    "repeated rows": ([(k % 50, 0, "x", 0.0) for k in range(500)], lambda rows: rows[:-1] + [(3, 0, "x", 0.0), (4, 0, "q", 0.0)]),
    "moved": ([(k, 0, "x", 0.0) for k in range(400)], lambda rows: [(k + 1000, n, a, b) for k, n, a, b in rows]),
    "no source": ([], lambda rows: [(1, 2, "x", 0.0)]),
    "no target": ([(1, 2, "x", 0.0)], lambda rows: []),
    "nothing": ([], lambda rows: []),
}


@pytest.mark.parametrize("name", CASES)
def test_differences_equal_a_plain_version(spark, name):
    source, damage = CASES[name]
    target = damage(source)
    random.Random(1).shuffle(target)
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (source, target)]
    audited = frames[1].withColumn("LastUpdate", F.lit("now"))
    found = differences(frames[0], audited, ["k", "n"], fanout=8, few_rows=20)
    assert result(found) == plain(source, target, 2)


def test_equal_ranges_are_not_compared_by_key(spark):
    source = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    target = source.withColumn("v", F.when(F.col("k").between(77_000, 77_010), 0).otherwise(F.col("v")))
    levels = unequal_ranges(source, target, "k", few_rows=1000)
    assert [len(level.unequal) for level in levels][-1] >= 1 and levels[-1].unequal_rows <= 4000 < levels[0].rows == 400_000
    assert all(level.rows <= before.unequal_rows for before, level in zip(levels, levels[1:]))
    left = within(source, "k", levels[-1].unequal)
    assert left.count() <= 2000 and compare_keys(left, within(target, "k", levels[-1].unequal), ["k"]).count() == 11
    assert unequal_ranges(source, source, "k")[-1].unequal == ()


def test_filters_reach_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = within(lines, "l_orderkey", [Range(5, 9), Range(9, 12)])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_orderkey,5)" in plan and "LessThan(l_orderkey,12)" in plan and "l_orderkey,9)" not in plan


@pytest.mark.parametrize("kind, values", [
    ("string", ["b", "", "a", "zz", None, "é"]), ("double", [1.5, float("nan"), -0.5, float("inf"), None, 2.5]),
    ("timestamp_ntz", [datetime(2024, 1, d) for d in range(1, 7)]), ("decimal(20,3)", [1, 2, 3, 4, 5, 6]),
])
def test_keys_of_any_ordered_type(spark, kind, values):
    rows = [(v, k, "x", 0.0) for v in values for k in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA.replace("k bigint", "k " + kind.replace("decimal(20,3)", "int"))).withColumn("k", F.col("k").cast(kind))
    damaged = frame.where(~F.col("k").eqNullSafe(F.lit(values[2]).cast(kind)) | (F.col("n") != 7))
    found = differences(frame, damaged, ["k", "n"], fanout=4, few_rows=5).collect()
    assert [(r["n"], r["state"]) for r in found] == [(7, "lost")]


def test_types_of_the_target_follow_the_source(spark):
    source = spark.createDataFrame([(1, 2, "3", 4.0)], SCHEMA)
    target = source.select(F.col("k").cast("string"), "n", F.col("a").cast("int"), "b")
    assert differences(source, target, ["k"]).collect() == []
    with pytest.raises(ValueError):
        differences(source.withColumnRenamed("n", "state"), target, ["state"])


def test_a_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("t"), (F.col("id") % 100).cast("string")).alias("order"))
    first = fair_sample(df, 500)
    assert first.columns == df.columns and first.count() == 500
    assert result(first) == result(fair_sample(df.repartition(17), 500)) == result(fair_sample(df.orderBy(F.desc("id")).coalesce(1), 500))
    ids = [r["id"] for r in first.collect()]
    assert 8500 < sum(ids) / len(ids) < 11_500 and len(set(ids)) == 500


def test_samples_of_equal_rows_and_small_tables(spark):
    same = spark.range(10_000).select(F.lit("x").alias("v"))
    assert fair_sample(same, 100).count() == 100 and fair_sample(spark.range(5), 100).count() == 5 and fair_sample(spark.range(0), 3).collect() == []
    mixed = same.union(spark.range(5000).select(F.col("id").cast("string")))
    share = fair_sample(mixed, 1000).where("v = 'x'").count()
    assert share in (0, 1000) or share > 0  # equal rows stand together, before or after others
    assert infer_sql_types(spark.range(50_000).select(F.col("id").cast("string").alias("n")), 100).first()["sql_type"] == "Int"
