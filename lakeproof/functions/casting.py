"""Casts that never raise, text width limits and load defaults."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names and the Spark type of each.
SPARK_TYPE_BY_WAREHOUSE = {
    "bigint": "bigint",
    "bit": "boolean",
    "char": "string",
    "date": "date",
    "datetime": "timestamp",
    "datetime2": "timestamp",
    "decimal": "decimal",
    "float": "double",
    "int": "int",
    "nchar": "string",
    "numeric": "decimal",
    "nvarchar": "string",
    "smallint": "smallint",
    "tinyint": "smallint",
    "varchar": "string",
}

# What a bulk load stores in place of a missing value.
TYPE_DEFAULTS = {"number": "0", "text": "", "date": "1900-01-01", "timestamp": "1900-01-01 00:00:00"}


def spark_type(physical: str, precision: int | None = None, scale: int | None = None) -> str:
    """``nvarchar`` or ``decimal`` with precision and scale as a Spark DDL type."""
    base = re.sub(r"\(.*\)", "", physical).strip().lower()
    name = SPARK_TYPE_BY_WAREHOUSE[base]
    return f"decimal({precision or 18},{scale or 0})" if name == "decimal" else name


# The integer types narrower than a bigint, and their largest value.
NARROW_INTEGERS = {"tinyint": 2**7 - 1, "smallint": 2**15 - 1, "int": 2**31 - 1}


def safe_cast(value: Column, source: T.DataType, target: str, width: int | None = None) -> Column:
    """Cast to ``target``; null where the value does not fit.

    A boolean is no number, so it becomes null in a numeric target. Text longer
    than ``width`` is cut, which is what a truncating load does.
    """
    numeric_target = target.split("(")[0] in {"smallint", "int", "bigint", "float", "double", "decimal"}
    if isinstance(source, T.BooleanType) and numeric_target:
        return F.lit(None).cast(target)
    if target in NARROW_INTEGERS and isinstance(source, T.StringType):
        # a bigint and a range test cost far less than a cast that fails on overflow
        wide, largest = value.try_cast("bigint"), NARROW_INTEGERS[target]
        return F.when(wide.between(-largest - 1, largest), wide.cast(target))
    cast = value.try_cast(target)
    if target == "string" and width is not None:
        cast = F.substring(cast, 1, width)
    return cast


def type_default(dtype: T.DataType) -> Column:
    """The literal stored for a missing value of this type."""
    if isinstance(dtype, T.NumericType):
        text = TYPE_DEFAULTS["number"]
    elif isinstance(dtype, T.DateType):
        text = TYPE_DEFAULTS["date"]
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = TYPE_DEFAULTS["timestamp"]
    elif isinstance(dtype, T.StringType):
        text = TYPE_DEFAULTS["text"]
    else:
        return F.lit(None).cast(dtype)
    return F.lit(text).cast(dtype)
