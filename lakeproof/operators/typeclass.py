"""Which profile a column belongs to, decided from its data type."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT, NUMBER, DATE = "text", "number", "date"


def type_class(dtype: T.DataType) -> str | None:
    """Nested, binary and boolean columns belong to no profile."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(dtype, T.NumericType):
        return NUMBER
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    return None


def columns_of_class(df: DataFrame, wanted: str, exclude: Collection[str] = ()) -> list[str]:
    return [f.name for f in df.schema if f.name not in exclude and type_class(f.dataType) == wanted]


def key_list(keys: str | Sequence[str]) -> list[str]:
    """``"a, b"`` and ``["a", "b"]`` both name a composite key."""
    parts = keys.split(",") if isinstance(keys, str) else keys
    return [part.strip() for part in parts if part.strip()]
