import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeproof.operators import compare
from lakeproof.operators.profile import profile_categorical
from lakeproof.plans.reconcile import reconcile

METRIC = "table_name string, measure string, freq bigint"


def test_null_keys_match_and_zero_source_has_no_percent(spark):
    source = spark.createDataFrame([("t", None, 0), ("t", "a", 8), ("t", "gone", 1)], METRIC)
    target = spark.createDataFrame([("t", None, 5), ("t", "a", 6), ("t", "new", 2)], METRIC)
    rows = {r.measure: r for r in compare.compare_metadata(source, target).collect()}
    assert rows[None]._merge == "both" and rows[None].value_diff == -5 and rows[None].percent_diff is None
    assert rows["a"].percent_diff == 25.0
    assert rows["gone"]._merge == "left_only" and rows["gone"].freq_tgt is None
    assert rows["new"]._merge == "right_only" and rows["new"].value_diff is None


def test_null_value_of_a_one_sided_row_stays_null(spark):
    source = spark.createDataFrame([("t", None, 1)], METRIC)
    target = spark.createDataFrame([], METRIC)
    row = compare.compare_metadata(source, target).first()
    assert (row.measure, row._merge) == (None, "left_only")


def test_dates_missing_on_both_sides_are_equal(spark):
    schema = "table_name string, date_type string, column_name string, column_value string, freq string"
    source = spark.createDataFrame([("t", "year", "d", "2020", None), ("t", "year", "d", "2021", "1")], schema)
    target = spark.createDataFrame([("t", "year", "d", "2020", None), ("t", "year", "d", "2021", "2")], schema)
    found = {r.column_value: r.value_diff for r in compare.compare_date(source, target).collect()}
    assert found == {"2020": True, "2021": False}


texts = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "", None])), max_size=12)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts, texts)
def test_one_shuffle_form_equals_join_of_profiles(spark, left, right):
    source, target = (spark.createDataFrame(rows, "k int, v string") for rows in (left, right))
    joined = compare.compare_categorical(
        profile_categorical(source, "k", "s1", "t"), profile_categorical(target, "k", "s2", "t")
    )
    fused = compare.reconcile_categorical(source, target, "k", "s1", "t", "s2")
    assert sorted(map(str, fused.select(joined.columns).collect())) == sorted(map(str, joined.collect()))


def test_table_against_itself_is_clean(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, "2020-01-01"), (2, "", 2.0, "2021-01-01"), (3, None, None, None)], "k int, v string, n double, d string"
    ).withColumn("d", F.col("d").cast("date"))
    found = reconcile(df, df, "k", "src", "t", "tgt")
    for metrics in (found.metadata, found.categorical, found.numeric):
        assert metrics.count() > 0
        assert metrics.where("_merge <> 'both' OR value_diff <> 0").count() == 0
    assert found.date.where("_merge <> 'both' OR NOT value_diff").count() == 0
    assert compare.null_slice(found.categorical).count() == 1


def test_column_of_one_side_only(spark):
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    target = source.withColumn("CreatedBy", F.lit("run"))
    found = compare.reconcile_categorical(source, target, "k", "s", "t").where("column_name = 'CreatedBy'").first()
    assert (found._merge, found.freq, found.freq_tgt) == ("right_only", None, 1)


@pytest.mark.parametrize("how, expected", [("left", {"a", "gone"}), ("right", {"a", "new"}), ("inner", {"a"})])
def test_join_kinds(spark, how, expected):
    source = spark.createDataFrame([("t", "a", 8), ("t", "gone", 1)], METRIC)
    target = spark.createDataFrame([("t", "a", 6), ("t", "new", 2)], METRIC)
    assert {r.measure for r in compare.compare_metadata(source, target, how=how).collect()} == expected


def test_reconciliation_is_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0)], "k int, v string, n double")
    reconcile(df, df, "k", "s", "t").write(str(tmp_path), "t")
    assert (tmp_path / "Compare_t_numeric").exists() and (tmp_path / "Compare_t_categorical").exists()
