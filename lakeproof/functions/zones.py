"""Local time from the Windows zone names that control tables carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows zone name to IANA zone, keys in lower case.
IANA_BY_WINDOWS = {
    "china standard time": "Asia/Shanghai",
    "india standard time": "Asia/Kolkata",
    "se asia standard time": "Asia/Bangkok",
    "se standard time": "Asia/Bangkok",
    "singapore standard time": "Asia/Singapore",
    "utc": "UTC",
}


def iana_zone(windows_name: str) -> str:
    try:
        return IANA_BY_WINDOWS[windows_name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown time zone name: {windows_name!r}") from None


def iana_zone_column(windows_name: Column) -> Column:
    """IANA zone per row; null where the name is unknown."""
    key = F.lower(F.trim(windows_name))
    expression = F.lit(None).cast("string")
    for name, zone in IANA_BY_WINDOWS.items():
        expression = F.when(key == name, F.lit(zone)).otherwise(expression)
    return expression


def utc_to_local(when: Column, windows_name: Column) -> Column:
    return F.from_utc_timestamp(when, iana_zone_column(windows_name))


def local_to_utc(when: Column, windows_name: Column) -> Column:
    return F.to_utc_timestamp(when, iana_zone_column(windows_name))
