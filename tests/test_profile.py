import pytest
from pyspark.sql import functions as F

from lakeproof.operators.counts import check_primary_key, compare_counts, row_column_count
from lakeproof.operators.profile import profile, profile_categorical, profile_date, profile_numeric
from lakeproof.operators.typeclass import columns_of_class


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, "x", "a", 10, 1.5, "2020-12-31 23:59:59", [1]),
        (1, "y", "", None, 2.5, "2021-01-01 00:00:00", [2]),
        (2, None, None, 30, None, None, None),
        (2, "y", "a", 30, -1.0, "2020-02-29 12:00:00.25", [3]),
    ]
    df = spark.createDataFrame(rows, "k1 int, k2 string, name string, n int, amount double, at string, nested array<int>")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def by(df, *names):
    return {tuple(r[n] for n in names[:-1]): r[names[-1]] for r in df.collect()}


def test_type_classes_leave_out_nested_and_keys(people):
    assert columns_of_class(people, "number", ["k1"]) == ["n", "amount"]
    assert columns_of_class(people, "text", ["k2"]) == ["name"]
    assert columns_of_class(people, "date") == ["at"]


def test_key_with_null_part_is_not_counted(people):
    found = by(check_primary_key(people, "k1,k2", "s", "t"), "measure", "freq")
    assert found == {("unique count",): 3, ("record count",): 4, ("field count",): 7}


def test_blank_and_null_are_separate_values(people):
    found = by(profile_categorical(people, "k1, k2", "s", "t"), "column_value", "freq")
    assert found == {("a",): 2, ("",): 1, (None,): 1}


def test_numeric_statistics(people):
    found = by(profile_numeric(people, ["k1", "k2"], "s", "t"), "column_name", "variable", "value")
    assert found["n", "null_values"] == 1
    assert found["n", "50th_percentile"] == 30
    assert found["amount", "min_value"] == -1.0
    assert found["amount", "avg_value"] == pytest.approx(1.0)


def test_date_components_and_boundaries(people):
    found = by(profile_date(people, "k1,k2", "s", "t"), "date_type", "column_value", "freq")
    assert found["year", "2020"] == "2" and found["year", None] == "1"
    assert found["day", "31"] == "1" and found["month", "2"] == "1"
    assert found["boundary", "maximum"] == "2021-01-01 00:00:00"
    assert found["boundary", "minimum"] == "2020-02-29 12:00:00.25"


def test_plain_dates_have_no_time(spark):
    df = spark.sql("select 1 as k, date'2020-01-02' as d, timestamp_ntz'2020-01-02 03:04:05' as t")
    found = by(profile_date(df, "k", "s", "t"), "column_name", "date_type", "column_value", "freq")
    assert found["d", "boundary", "maximum"] == "2020-01-02"
    assert found["t", "boundary", "maximum"] == "2020-01-02 03:04:05"


def test_empty_table_and_all_null_column(spark):
    empty = spark.createDataFrame([], "k int, name string, n int, d date")
    found = profile(empty, "k", "s", "t")
    assert found.categorical.count() == 0
    values = by(found.numeric, "variable", "value")
    assert values["null_values",] == 0 and values["50th_percentile",] is None
    assert by(check_primary_key(empty, "k", "s", "t"), "measure", "freq")["record count",] == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "k int, n double")
    assert by(profile_numeric(nulls, "k", "s", "t"), "variable", "value")["null_values",] == 2


def test_no_columns_of_a_class(spark):
    df = spark.createDataFrame([(1,)], "k int")
    found = profile(df, "k", "s", "t")
    assert [p.count() for p in (found.categorical, found.numeric, found.date)] == [0, 0, 0]


def test_profile_does_not_depend_on_partitions(spark, people):
    def rows(df):
        found = profile(df, "k1,k2", "s", "t")
        return [sorted(map(str, p.collect())) for p in (found.categorical, found.date)]

    assert rows(people.repartition(1)) == rows(people.repartition(7))


def test_dotted_and_spaced_names(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 4.0)], ["t.key", "t.some text", "t.amount"])
    assert by(profile_categorical(df, "t.key", "s", "t"), "column_name", "column_value", "freq") == {
        ("t.some text", "a"): 1, ("t.some text", "b"): 1,
    }
    assert by(profile_numeric(df, "t.key", "s", "t"), "column_name", "variable", "value")["t.amount", "max_value"] == 4.0
    assert by(check_primary_key(df, "t.key", "s", "t"), "measure", "freq")["unique count",] == 2


def test_counts_of_an_empty_table_and_verdicts(spark):
    full = spark.range(3).toDF("a")
    target = row_column_count({
        "T1": full.withColumns({"x": F.lit(1), "y": F.lit(1)}), "T2": full, "T3": spark.range(2).selectExpr("id", "1 x", "1 y"),
        "T4": full,
    })
    source = row_column_count({"S.T1": full, "S.T2": full, "S.T3": full, "S.T5": full.limit(0)})
    found = by(compare_counts(target, source), "tblnm", "ComparisonResult")
    assert found == {
        ("T1",): "Both matched", ("T2",): "Column count not match", ("T3",): "Row count not match",
        ("T4",): "Both not match",
    }
    right = compare_counts(target, source, how="right").where("tblnm IS NULL").first()
    assert (right.tblnm_src, right.rowcount_src, right._merge) == ("T5", 0, "right_only")
