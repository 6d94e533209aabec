"""Rename and cast columns from a mapping, and split off rows that do not fit."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.casting import safe_cast, spark_type, type_default
from lakeproof.functions.naming import bare_upper, clean_header, field, unique_names

MAPPING_SCHEMA = (
    "mappings array<struct<source: struct<name: string, type: string, physicalType: string>, "
    "sink: struct<name: string, type: string, physicalType: string, precision: int, scale: int, width: int>>>"
)


@dataclass(frozen=True)
class ColumnMap:
    """One source column, its name in the sink and the warehouse type there."""

    source: str
    sink: str
    physical_type: str = "nvarchar"
    precision: int | None = None
    scale: int | None = None
    width: int | None = None

    @property
    def target_type(self) -> str:
        return spark_type(self.physical_type, self.precision, self.scale)


def parse_mapping(text: str) -> list[ColumnMap]:
    """A translator document: ``{"mappings": [{"source": {...}, "sink": {...}}]}``."""
    result = []
    for entry in json.loads(text)["mappings"]:
        source, sink = entry["source"], entry["sink"]
        name = source.get("name") or f"_c{int(source['ordinal']) - 1}"
        result.append(ColumnMap(
            name, sink["name"], sink.get("physicalType") or _physical_of(sink.get("type", "String")),
            sink.get("precision"), sink.get("scale"), sink.get("width"),
        ))
    return result


def _physical_of(interim: str) -> str:
    # Interim type names and the warehouse type each one lands in.
    names = {
        "Boolean": "bit", "DateTime": "datetime", "Decimal": "decimal", "Double": "float",
        "Int16": "smallint", "Int32": "int", "Int64": "bigint", "String": "nvarchar",
    }
    return names[interim]


def mapping_from_table(mappings: DataFrame, schema_name: str, table_name: str) -> list[ColumnMap]:
    """Look up the mapping document of one table in a mapping table."""
    row = (
        mappings.where((F.col("schema_name") == schema_name) & (F.col("table_name") == table_name))
        .select("mapping").first()
    )
    if row is None:
        raise LookupError(f"no mapping for {schema_name}.{table_name}")
    return parse_mapping(row["mapping"])


def map_columns_of(df: DataFrame, mapping: Sequence[ColumnMap]) -> list[Column]:
    return [
        safe_cast(field(m.source), df.schema[m.source].dataType, m.target_type, m.width).alias(m.sink) for m in mapping
    ]


def map_columns(df: DataFrame, mapping: Sequence[ColumnMap]) -> DataFrame:
    """One projection: rename, cast, cut text to width, drop what is not mapped."""
    return df.select(map_columns_of(df, mapping))


def map_ordinals(df: DataFrame, names: Sequence[str] | Mapping[int, str]) -> DataFrame:
    """Name the columns of a headerless read; ordinals start at 1."""
    pairs = names.items() if isinstance(names, Mapping) else enumerate(names, start=1)
    return df.select([field(df.columns[ordinal - 1]).alias(name) for ordinal, name in pairs])


def conversion_errors(df: DataFrame, mapping: Sequence[ColumnMap]) -> Column:
    """Names of the source columns whose value is present but does not fit."""
    failed = [
        F.when(
            field(m.source).isNotNull()
            & safe_cast(field(m.source), df.schema[m.source].dataType, m.target_type).isNull(),
            F.lit(m.source),
        )
        for m in mapping
    ]
    return F.array_compact(F.array(*failed))


def split_incompatible(df: DataFrame, mapping: Sequence[ColumnMap]) -> tuple[DataFrame, DataFrame]:
    """(rows that load, mapped; rows that do not, as read, with ``bad_columns``, or ``bad_columns_2`` beside a column of that name)."""
    errors = unique_names([*df.columns, "bad_columns"])[-1]
    checked = df.withColumn(errors, conversion_errors(df, mapping))
    good = checked.where(F.size(field(errors)) == 0).drop(errors)
    rejects = checked.where(F.size(field(errors)) > 0).withColumn(errors, F.concat_ws(",", field(errors)))
    return map_columns(good, mapping), rejects


def fill_type_defaults(df: DataFrame) -> DataFrame:
    """Replace missing values by the default of their type."""
    return df.select([F.coalesce(field(f.name), type_default(f.dataType)).alias(f.name) for f in df.schema])


def strip_table_prefix(df: DataFrame) -> DataFrame:
    """``table.column`` becomes ``COLUMN`` for all columns."""
    return df.toDF(*unique_names(bare_upper(c) for c in df.columns))


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(clean_header(c) for c in df.columns))


def add_audit_columns(df: DataFrame, run_time: datetime, run_id: str) -> DataFrame:
    """``LastUpdate`` and ``CreatedBy``: the run's trigger time and id, as text."""
    stamp = run_time.strftime("%Y-%m-%d %H:%M:%S")
    return df.withColumns({"LastUpdate": F.lit(stamp), "CreatedBy": F.lit(run_id)})


def add_load_timestamp(df: DataFrame, run_time: datetime) -> DataFrame:
    return df.withColumn("Timestamp", F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S")))


def add_load_date(df: DataFrame, run_date: date | None = None) -> DataFrame:
    """``LoadDate`` is the run's date, today unless given."""
    return df.withColumn("LoadDate", F.current_date() if run_date is None else F.lit(run_date))


def with_column_ids(df: DataFrame) -> DataFrame:
    """Columns renamed to their position and name, such as ``[1]name``."""
    return df.toDF(*[f"[{i}]{c}" for i, c in enumerate(df.columns, start=1)])
