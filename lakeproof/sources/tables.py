"""Catalog tables by name or by query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    return spark.table(f"{schema}.{table}" if schema else table)


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A query over catalog tables and over the DataFrames given by name."""
    return spark.sql(query, **tables)
