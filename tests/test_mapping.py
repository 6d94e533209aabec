import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeproof.functions.casting import spark_type
from lakeproof.functions.naming import clean_header, unique_names
from lakeproof.operators import cleaning, mapping
from lakeproof.operators.infer import infer_sql_types
from lakeproof.operators.mapping import ColumnMap


def test_dotted_sources_are_renamed_cast_and_cut(spark):
    df = spark.createDataFrame([("ខ្មែរ-text", "12.345", "x", "2020-01-02 03:04:05")], ["t.name", "t.amt", "t.extra", "t.at"])
    mapped = mapping.map_columns(df, [
        ColumnMap("t.name", "NAME", "nvarchar", width=5), ColumnMap("t.amt", "AMT", "decimal", 5, 1),
        ColumnMap("t.at", "AT", "date"),
    ])
    assert mapped.columns == ["NAME", "AMT", "AT"]
    assert mapped.first() == ("ខ្មែរ-text"[:5], Decimal("12.3"), date(2020, 1, 2))


def test_boolean_is_no_number_and_overflow_is_null(spark):
    df = spark.createDataFrame([(True, "99999")], "flag boolean, n string")
    row = mapping.map_columns(df, [ColumnMap("flag", "F", "int"), ColumnMap("n", "N", "decimal", 3, 0)]).first()
    assert row == (None, None)


def test_rejects_name_their_columns(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "2020-13-01"), (None, None)], "n string, d string")
    good, rejects = mapping.split_incompatible(df, [ColumnMap("n", "N", "int"), ColumnMap("d", "D", "date")])
    assert [tuple(r) for r in good.collect()] == [(None, None)]
    assert {(r.n, r.bad_columns) for r in rejects.collect()} == {("1", "d"), ("x", "n,d")}


def test_type_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None)], "n int, t string, d date, at timestamp_ntz")
    row = mapping.fill_type_defaults(df).first()
    assert row == (0, "", date(1900, 1, 1), datetime(1900, 1, 1))


def test_mapping_documents(spark):
    text = json.dumps({"mappings": [
        {"source": {"ordinal": 2}, "sink": {"name": "event_name", "type": "String"}},
        {"source": {"name": "t.n", "type": "Decimal"},
         "sink": {"name": "N", "physicalType": "decimal", "precision": 3, "scale": 0}},
    ]})
    assert mapping.parse_mapping(text) == [
        ColumnMap("_c1", "event_name"), ColumnMap("t.n", "N", "decimal", 3, 0),
    ]
    table = spark.createDataFrame([("s", "t", text)], "schema_name string, table_name string, mapping string")
    assert len(mapping.mapping_from_table(table, "s", "t")) == 2
    with pytest.raises(LookupError):
        mapping.mapping_from_table(table, "s", "other")


def test_type_names():
    assert spark_type("nvarchar(20)") == "string"
    assert spark_type("decimal", 38, 18) == "decimal(38,18)"
    assert spark_type("Datetime") == "timestamp"


def test_headers():
    assert clean_header(" Shelf/Bay  Number ") == "Shelf_Bay_Number"
    assert unique_names(["a", "A", "a", "b"]) == ["a", "A_2", "a_3", "b"]
    assert unique_names(["a", "a", "a_2"]) == ["a", "a_2", "a_2_2"]


def test_cleaning(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", 3)], "t string, n int")
    assert [r.t for r in cleaning.blank_to_null_text(df).orderBy("n").collect()] == ["null", None, "x"]
    void = df.withColumn("v", F.lit(None))
    assert dict(cleaning.void_to_string(void).dtypes)["v"] == "string"


@pytest.mark.parametrize("values, label", [
    (["2020-01-01"], "Date"), (["2020-01-01 10:00:00"], "Datetime"), (["2020-01-01T10:00:00"], "Datetime"),
    (["2020-01-01", "2020-01-01 10:00:00"], "Datetime"), (["2020-13-01"], "Varchar(255)"),
    (["1.50", "2.0"], "Decimal(18,4)"), (["7", None], "Int"), (["3000000000"], "Bigint"), (["1e3"], "Bigint"),
    (["true", "no"], "Bit"), (["x" * 255], "Varchar(255)"), (["x" * 256], "Varchar(MAX)"), (["7", "x"], "Varchar(255)"),
    ([None], "Varchar(MAX)"), ([""], "Varchar(255)"), (["7", "x" * 256], "Varchar(MAX)"), (["1.5", "7"], "Decimal(18,4)"),
    (["1" * 400], "Bigint"), (["-.5"], "Decimal(18,4)"), (["+"], "Varchar(255)"),
])
def test_inferred_labels(spark, values, label):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_sql_types(df).first().sql_type == label


def test_typed_columns_rank_as_their_text(spark):
    df = spark.sql("""
      SELECT * FROM VALUES
        (1, 3000000000, 1.5D, true, date'2020-01-01', timestamp_ntz'2020-01-01 00:00:00', 1.25BD, 7S, cast(0.5 as float)),
        (2, 1, 1e9D, false, null, null, null, 8S, null) AS t(i, l, d, b, dt, ts, dec, s, f)
    """)
    typed = {r.column_name: r.type_rank for r in infer_sql_types(df.select("i", "l", "d", "b", "dt", "dec", "s", "f")).collect()}
    as_text = df.select([F.col(c).cast("string").alias(c) for c in ("i", "l", "d", "b", "dt", "dec", "s", "f")])
    assert typed == {r.column_name: r.type_rank for r in infer_sql_types(as_text).collect()}
    assert infer_sql_types(df.select("ts")).first().sql_type == "Datetime"


def test_infer_on_no_rows(spark):
    assert infer_sql_types(spark.createDataFrame([], "a int, b string")).where("type_rank = 9").count() == 2
    assert infer_sql_types(spark.range(10), sample_rows=3).first().sql_type == "Int"


def test_audit_columns(spark):
    df = mapping.add_audit_columns(spark.range(1), datetime(2020, 1, 2, 3, 4, 5), "r1")
    assert df.first()[1:] == ("2020-01-02 03:04:05", "r1")
    assert mapping.with_column_ids(df).columns == ["[1]id", "[2]LastUpdate", "[3]CreatedBy"]
