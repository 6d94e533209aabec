"""Dated lake paths: ``zone/country/Full/system/OBJECT/yyyy[/MM[/dd[/HH]]]/SCHEMA_OBJECT_<stamp>.parquet``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The granularity codes of the control table and the folder
# levels each one writes.
GRANULARITY_FOLDERS = {
    "YY": "yyyy",
    "MM": "yyyy/MM",
    "DD": "yyyy/MM/dd",
    "HH": "yyyy/MM/dd/HH",
}
FILE_STAMP = "yyyy_MM_dd_HH_mm"
OUTPUT_STAMP = "yyyyMMddHHmm"

_STRFTIME = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M"}


def _format(when: datetime, pattern: str) -> str:
    for spark_token, python_token in _STRFTIME.items():
        pattern = pattern.replace(spark_token, python_token)
    return when.strftime(pattern)


def dated_path(
    zone: str, country: str, system: str, schema: str, obj: str,
    when: datetime, granularity: str = "DD", load_kind: str = "Full",
) -> str:
    """The path of one load, for the writer."""
    folder = [zone, country, load_kind, system, obj.upper()]
    if granularity in GRANULARITY_FOLDERS:
        folder.append(_format(when, GRANULARITY_FOLDERS[granularity]))
    name = f"{schema.upper()}_{obj.upper()}_{_format(when, FILE_STAMP)}.parquet"
    return "/".join([*folder, name])


def object_path(zone: str, country: str, system: str, obj: str, load_kind: str = "Delta") -> str:
    """The folder of an object that grows by increments."""
    return "/".join([zone, country, load_kind, system, obj.upper()])


def dated_folder(when: Column, granularity: Column) -> Column:
    """Folder levels per row; an unknown granularity has none."""
    expression = F.lit(None).cast("string")
    for code, pattern in GRANULARITY_FOLDERS.items():
        expression = F.when(granularity == code, F.date_format(when, pattern)).otherwise(expression)
    return expression


def dated_path_column(
    zone: Column, country: Column, system: Column, schema: Column, obj: Column,
    when: Column, granularity: Column, load_kind: str = "Full",
) -> Column:
    """``dated_path`` over a set of loads."""
    name = F.concat(
        F.upper(schema), F.lit("_"), F.upper(obj), F.lit("_"),
        F.date_format(when, FILE_STAMP), F.lit(".parquet"),
    )
    # concat_ws leaves out the folder part when the granularity is unknown
    return F.concat_ws(
        "/", zone, country, F.lit(load_kind), system, F.upper(obj),
        dated_folder(when, granularity), name,
    )


def output_path_column(function: Column, name: Column, when: Column, granularity: Column) -> Column:
    """``function/name/yyyy[/MM[/dd[/HH]]]/name_yyyyMMddHHmm.csv``: where a transformation leaves its result."""
    file = F.concat(name, F.lit("_"), F.date_format(when, OUTPUT_STAMP), F.lit(".csv"))
    return F.concat_ws("/", function, name, dated_folder(when, granularity), file)


def daily_file_name(prefix: str, run_date: datetime, suffix: str = ".zip", days_back: int = 1) -> str:
    """The name of the file delivered for an earlier day, yesterday by default."""
    return f"{prefix}{(run_date - timedelta(days=days_back)).strftime('%Y-%m-%d')}{suffix}"


def daily_file_name_column(prefix: Column, run_date: Column, suffix: Column, days_back: int = 1) -> Column:
    return F.concat(prefix, F.date_format(F.date_sub(run_date, days_back), "yyyy-MM-dd"), suffix)
