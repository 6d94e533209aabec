"""Control records: JSON configuration and configuration files with an active flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field

# The fields of a control record.
CONFIG_RECORD = (
    "FwkSourceId int, SourceType string, FwkConfigId int, SrcObject string, SchemaName string, "
    "DatabaseName string, WmkColumnName string, WmkDataType int, TypeLoad int, RelativeURL string, "
    "ActiveFlag string, SrcPath string, SinkPathGranularity string, FwkTriggerId int, BatchGroupId int, "
    "ConvertMethod string, SynapseObject string, EnvironmentName string, CountryId string, SystemName string, "
    "TimezoneName string, MaxConcurrency int, BlockSize int, DegreeOfParallelism int"
)
FULL_LOAD = 1


def parse_config(documents: DataFrame, text: str = "config") -> DataFrame:
    """One row per record of each document's JSON array; missing fields are null."""
    records = F.from_json(field(text), f"array<struct<{CONFIG_RECORD}>>")
    return documents.select(F.inline(records))


def config_for_source(config: DataFrame, source_type: str) -> DataFrame:
    return config.where(F.col("SourceType") == source_type)


def batch_groups(config: DataFrame, trigger_id: int | Column) -> DataFrame:
    """Batch groups of a trigger's active records, in the order they run."""
    wanted = (F.col("FwkTriggerId") == trigger_id) & (F.col("ActiveFlag") == "Y")
    return config.where(wanted).select("BatchGroupId").distinct().orderBy("BatchGroupId")


def active_rows(config: DataFrame, position: int) -> DataFrame:
    """Rows whose flag column, by position from 0, holds ``1``."""
    return config.where(F.trim(field(config.columns[position])) == "1")


def mapping_tables(mappings: DataFrame) -> DataFrame:
    """Distinct tables that a mapping table describes."""
    return mappings.select(
        F.upper("schema_name").alias("schema_name"), "table_name", "source_system", "adlsg2_file_name"
    ).distinct()
