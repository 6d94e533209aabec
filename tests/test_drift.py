"""Parquet files of drifting schemas."""

from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.session import scratch_path
from lakeproof.sinks import files as sinks
from lakeproof.sources.drift import SchemaConflict, common_type, footer_schemas, read_drifted, reader_widens


@pytest.fixture(autouse=True)
def session(spark):
    """Types are parsed by a session."""


def ddl(text):
    return T.StructType.fromDDL(f"x {text}")[0].dataType


@pytest.mark.parametrize("one, other, expected", [
    ("tinyint", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(38,30)", "double"), ("int", "float", "double"),
    ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"), ("decimal(5,2)", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", "timestamp"), ("timestamp_ntz", "timestamp", "timestamp"), ("int", "string", None), ("boolean", "int", None),
    ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "array<string>", None), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:string>", "struct<A:bigint,c:date>", "struct<a:bigint,b:string,c:date>"), ("struct<a:int>", "struct<a:string>", None), ("void", "int", "int"),
])
def test_least_common_types(one, other, expected):
    for pair in ((one, other), (other, one)):
        found = common_type(*map(ddl, pair))
        # a struct's fields come in the order in which they are met
        assert found is None and expected is None or sorted(found.simpleString().lower()) == sorted(expected)


ORDER = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(12,2)", "decimal(20,4)", "decimal(38,10)", "date", "timestamp", "timestamp_ntz", "string", "boolean"]
ONE = {"date": "date'2024-01-02'", "timestamp": "timestamp'2024-01-02 03:04:05'", "timestamp_ntz": "timestamp_ntz'2024-01-02 03:04:05'", "boolean": "true"}


def test_what_the_reader_is_said_to_widen_it_widens(spark):
    path = scratch_path(spark, "widen")
    for kind in ORDER:
        spark.range(1).select(F.expr(f"CAST({ONE.get(kind, '7')} AS {kind})").alias("c")).write.parquet(f"{path}/{kind}")
    pairs = [(a, b) for a in ORDER for b in ORDER if a != b and reader_widens(ddl(a), ddl(b))]
    assert len(pairs) > 20
    for stored, wanted in pairs:
        value = spark.read.schema(f"c {wanted}").parquet(f"{path}/{stored}")
        assert value.first()[0] == spark.read.parquet(f"{path}/{stored}").select(F.col("c").cast(wanted)).first()[0], (stored, wanted)


def test_drifted_files_become_one_table(spark):
    path = scratch_path(spark, "drift")
    spark.sql("SELECT 1 AS id, CAST(1.5 AS DECIMAL(5,2)) AS v, date'2024-01-02' AS d, 'x' AS `odd.name`").write.parquet(f"{path}/a")
    spark.sql("SELECT 5000000000 AS ID, 7 AS v, timestamp_ntz'2024-01-02 03:04:05' AS d, 9 AS n").write.parquet(f"{path}/b")
    spark.sql("SELECT 2.5D AS v, CAST(NULL AS STRING) AS `odd.name`").write.parquet(f"{path}/c")
    assert footer_schemas(spark, path).count() == 3
    df = read_drifted(spark, path)
    assert df.dtypes == [("id", "bigint"), ("v", "double"), ("d", "timestamp_ntz"), ("odd.name", "string"), ("n", "int")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        (1, 1.5, datetime(2024, 1, 2), "x", None), (5_000_000_000, 7.0, datetime(2024, 1, 2, 3, 4, 5), None, 9), (None, 2.5, None, None, None),
    ], key=str)
    target = scratch_path(spark, "one")
    sinks.convert_to_parquet(spark, path, "parquet-drift", target)
    assert spark.read.parquet(target).count() == 3


def test_types_with_nothing_in_common_are_text(spark):
    path = scratch_path(spark, "drift")
    spark.sql("SELECT 1 AS a, true AS b").write.parquet(f"{path}/a")
    spark.sql("SELECT 'x' AS a, 2L AS b").write.parquet(f"{path}/b")
    df = read_drifted(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")] and sorted(map(tuple, df.collect())) == [("1", "true"), ("x", "2")]
    with pytest.raises(SchemaConflict, match="'a' is int, string"):
        read_drifted(spark, path, strict=True)
    with pytest.raises(FileNotFoundError):
        read_drifted(spark, path, name_glob="*.none")


def test_widening_alone_takes_one_scan(spark):
    path = scratch_path(spark, "drift")
    spark.range(5).selectExpr("CAST(id AS INT) AS id").write.parquet(f"{path}/a")
    spark.range(5).selectExpr("id", "id AS more").write.parquet(f"{path}/b")
    df = read_drifted(spark, path)
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1 and df.agg(F.sum("id")).first()[0] == 20


def test_files_of_other_writers(spark, tmp_path):
    pq.write_table(pa.table({"u": pa.array([200], pa.uint8()), "t": pa.array([datetime(2024, 1, 1)], pa.timestamp("us")), "m": pa.array([Decimal("1.25")])}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"u": pa.array([-1], pa.int64()), "t": pa.array([date(2024, 1, 2)])}), tmp_path / "b.parquet")
    df = read_drifted(spark, str(tmp_path))
    assert df.dtypes == [("u", "bigint"), ("t", "timestamp_ntz"), ("m", "decimal(3,2)")]
    assert sorted(map(tuple, df.collect())) == [(-1, datetime(2024, 1, 2), None), (200, datetime(2024, 1, 1), Decimal("1.25"))]
