"""Physical plans that must not get worse: scans, shuffles, columns read, join kinds."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lakeproof.operators import compare, inventory, quantiles
from lakeproof.operators.infer import infer_sql_types
from lakeproof.operators.profile import profile_categorical, profile_date, profile_numeric

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


def test_all_text_columns_share_one_scan_and_one_shuffle(orders):
    text = plan(profile_categorical(orders, "o_orderkey", "s", "t"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_count" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in text


def test_date_profile_reads_only_dates(orders):
    text = plan(profile_date(orders, "o_orderkey", "s", "t"))
    assert text.count("ReadSchema: struct<o_orderdate:timestamp_ntz>") == text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_type_inference_takes_one_scan_on_wide_tables(spark):
    wide = spark.read.parquet(f"{DATA}/orders.parquet").select(*[F.col("o_orderpriority").alias(f"c{n}") for n in range(160)])
    started = time.perf_counter()
    inferred = infer_sql_types(wide)
    assert time.perf_counter() - started < 2
    assert plan(inferred).count("FileScan") == 1
    assert {r.sql_type for r in inferred.collect()} == {"Varchar(255)"}


def test_numeric_profile_has_few_scans(orders, monkeypatch):
    passes = []
    split = quantiles._split_brackets
    monkeypatch.setattr(quantiles, "_split_brackets", lambda *a: passes.append(1) or split(*a))
    profile_numeric(orders, "o_orderkey", "s", "t").collect()
    assert len(passes) <= 4


def test_comparing_two_tables_takes_one_shuffle(orders):
    text = plan(compare.reconcile_categorical(orders, orders, "o_orderkey", "s", "t"))
    assert text.count("Exchange") == 1 and "Join" not in text


@pytest.mark.parametrize("name", [
    "acid_resolve", "check_primary_key", "compare_categorical", "compare_date", "config_filter", "delta_load", "dir_size",
    "expected_outputs", "expected_tables_present", "file_size_compare", "folder_inventory", "latest_partition",
    "listing_exclude", "map_columns", "profile_categorical", "profile_date", "reconcile_categorical",
    "retention_candidates", "rowcount_compare_left", "run_log_latest", "skip_incompatible_rows", "table_list_diff",
])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, DATA))
    for slow in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert slow not in text


def test_a_hot_key_is_split_in_a_membership_join(spark):
    """A third of the rows share one key; neither side is small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 400_000, 1, 8).selectExpr("if(id % 3 = 0, 1, id) AS key", "xxhash64(id) AS payload")
        wanted = spark.range(200_000).selectExpr("id AS key")
        result = inventory.members_of(rows, wanted, "key").agg(F.count("*").alias("n"), F.bit_xor("payload"))
        assert result.collect()[0].n == 133_334 + 133_333
        assert "skew=true" in plan(result)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_resolution_combines_before_the_shuffle(spark):
    assert "partial_max_by" in plan(__spark_entry__.queries()["acid_resolve"](spark, DATA))
