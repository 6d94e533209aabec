"""Profile a table and its copy and compare the two, side by side or by way of metric files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeproof.operators.cleaning import blank_to_null_text
from lakeproof.operators.compare import (
    compare_categorical, compare_date, compare_metadata, compare_numeric, reconcile_categorical,
)
from lakeproof.operators.counts import check_primary_key
from lakeproof.operators.profile import (
    CATEGORICAL_SCHEMA, DATE_SCHEMA, NUMERIC_SCHEMA, profile, profile_date, profile_numeric,
)
from lakeproof.sinks.files import read_metrics, write_metrics


METADATA_SCHEMA = "schema_name string, table_name string, measure string, column_value string, freq bigint"
METRIC_SCHEMAS = {
    "metadata": METADATA_SCHEMA, "categorical": CATEGORICAL_SCHEMA, "numeric": NUMERIC_SCHEMA, "date": DATE_SCHEMA,
}


@dataclass(frozen=True)
class Reconciliation:
    metadata: DataFrame
    categorical: DataFrame
    numeric: DataFrame
    date: DataFrame

    def write(self, path: str, table_name: str) -> None:
        """The four comparisons as pipe-separated files below a folder."""
        for name, metrics in vars(self).items():
            write_metrics(metrics, f"{path}/Compare_{table_name}_{name}")


def reconcile(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str,
    target_schema_name: str | None = None, clean_blanks: bool = True,
) -> Reconciliation:
    """Compare all metrics of two tables. Columns that only one side has show up as one-sided rows."""
    if clean_blanks:
        source, target = blank_to_null_text(source), blank_to_null_text(target)
    target_schema = target_schema_name or schema_name
    sides = ((source, schema_name), (target, target_schema))
    return Reconciliation(
        compare_metadata(*(check_primary_key(df, keys, schema, table_name) for df, schema in sides)),
        reconcile_categorical(source, target, keys, schema_name, table_name, target_schema),
        compare_numeric(*(profile_numeric(df, keys, schema, table_name) for df, schema in sides)),
        compare_date(*(profile_date(df, keys, schema, table_name) for df, schema in sides)),
    )


def table_metrics(
    df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str, clean_blanks: bool = True
) -> dict[str, DataFrame]:
    """The four metric tables of one side."""
    cleaned = blank_to_null_text(df) if clean_blanks else df
    found = profile(cleaned, keys, schema_name, table_name)
    return {"metadata": check_primary_key(cleaned, keys, schema_name, table_name), **vars(found)}


def store_metrics(metrics: dict[str, DataFrame], path: str, side: str, table_name: str) -> None:
    """Metric files, for a site that cannot reach the other side's tables."""
    for name, rows in metrics.items():
        write_metrics(rows, f"{path}/{side}_{table_name}_{name}")


def reconcile_stored(
    spark: SparkSession, path: str, side: str, target: DataFrame, keys: str | Sequence[str],
    schema_name: str, table_name: str, clean_blanks: bool = True,
) -> Reconciliation:
    """Compare metric files that the source side delivered with a table at hand."""
    stored = {
        name: read_metrics(spark, f"{path}/{side}_{table_name}_{name}", schema)
        for name, schema in METRIC_SCHEMAS.items()
    }
    own = table_metrics(target, keys, schema_name, table_name, clean_blanks)
    return Reconciliation(
        compare_metadata(stored["metadata"], own["metadata"]),
        compare_categorical(stored["categorical"], own["categorical"]),
        compare_numeric(stored["numeric"], own["numeric"]),
        compare_date(stored["date"], own["date"]),
    )
