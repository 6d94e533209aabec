"""JDBC tables and queries. Connection details always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcPartitions:
    """Split a read into ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column, "lowerBound": self.lower,
            "upperBound": self.upper, "numPartitions": str(self.count),
        }


def read_options(
    url: str, *, table: str | None = None, query: str | None = None,
    partitions: JdbcPartitions | None = None, fetch_size: int = 10000,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read of exactly one of a table or a query.

    Spark cannot split the ``query`` option, so a partitioned query is read as
    a derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **(connection or {})}
    if query is not None and partitions is None:
        options["query"] = query
    elif query is not None:
        options["dbtable"] = f"({query.rstrip().rstrip(';')}) src"
    else:
        options["dbtable"] = table
    if partitions is not None:
        options |= partitions.options()
    return options


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, **kwargs)).load()


def write_options(
    url: str, table: str, *, truncate: bool = False, column_types: Mapping[str, str] | None = None,
    batch_size: int = 10000, connections: int | None = None, connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(connection or {})}
    if truncate:
        options["truncate"] = "true"
    if column_types:
        options["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in column_types.items())
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """``mode="overwrite", truncate=True`` empties the table and keeps its definition."""
    df.write.format("jdbc").options(**write_options(url, table, **kwargs)).mode(mode).save()
