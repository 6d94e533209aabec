"""Row, column and key counts, and the verdict on a copied table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field, table_part
from lakeproof.operators.typeclass import key_list


def row_column_count(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tblnm, columncount, rowcount), one row per table even when it is empty."""
    counts = [
        df.agg(F.count("*").alias("rowcount")).select(
            F.lit(name).alias("tblnm"),
            F.lit(str(len(df.columns))).alias("columncount"),
            "rowcount",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def check_primary_key(df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str) -> DataFrame:
    """Distinct keys, records and fields of a table, in one scan.

    A key with a null part is not counted, as in SQL ``count(distinct a, b)``.
    """
    parts = [field(k) for k in key_list(keys)]
    counted = df.agg(F.count_distinct(*parts).alias("unique_count"), F.count("*").alias("record_count"))
    rows = F.array(
        _measure("unique count", "primary key", F.col("unique_count")),
        _measure("record count", "", F.col("record_count")),
        _measure("field count", "", F.lit(len(df.columns)).cast("bigint")),
    )
    return counted.select(F.inline(rows)).select(
        F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"),
        "measure", "column_value", "freq",
    )


def _measure(name: str, value: str, freq: Column) -> Column:
    return F.struct(F.lit(name).alias("measure"), F.lit(value).alias("column_value"), freq.alias("freq"))


def suffix_counts(counts: DataFrame, side: str) -> DataFrame:
    """``tblnm`` becomes ``tblnm_<side>`` and so on; the name loses its schema."""
    renamed = counts.withColumnsRenamed({c: f"{c}_{side}" for c in ("tblnm", "columncount", "rowcount")})
    return renamed.withColumn(f"tblnm_{side}", table_part(F.col(f"tblnm_{side}")))


def compare_counts(
    target: DataFrame, source: DataFrame, side: str = "src", how: str = "left",
    audit_columns: int = 2, checked_at: datetime | Column | None = None,
) -> DataFrame:
    """Join count tables on table name and judge each pair.

    The target carries ``audit_columns`` more columns than its source.
    """
    joined = target.join(suffix_counts(source, side), F.col("tblnm") == F.col(f"tblnm_{side}"), how)
    same_rows = F.col("rowcount") == F.col(f"rowcount_{side}")
    same_columns = F.col("columncount").cast("int") - audit_columns == F.col(f"columncount_{side}").cast("int")
    verdict = (
        F.when(same_rows & same_columns, "Both matched")
        .when(~same_rows & same_columns, "Row count not match")
        .when(same_rows & ~same_columns, "Column count not match")
        .otherwise("Both not match")
    )
    presence = (
        F.when(F.col("tblnm").isNull(), "right_only")
        .when(F.col(f"tblnm_{side}").isNull(), "left_only")
        .otherwise("both")
    )
    result = joined.withColumns({"ComparisonResult": verdict, "_merge": presence})
    if checked_at is not None:
        stamp = checked_at if isinstance(checked_at, Column) else F.lit(checked_at)
        result = result.withColumn("ComparedAt", stamp)
    return result
