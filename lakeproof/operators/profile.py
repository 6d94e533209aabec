"""Column profiles of a table: value frequencies, numeric distribution, dates.

Each profile reads only its own class of columns, and nothing is cached. Text and
dates take one scan each. Numbers take one scan for everything but the deciles,
and exact deciles two to four more, which run when the function is called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field, quoted
from lakeproof.operators.quantiles import ColumnRange, exact_quantiles, long_form
from lakeproof.operators.typeclass import DATE, NUMBER, TEXT, columns_of_class, key_list

CATEGORICAL_SCHEMA = "schema_name string, table_name string, column_name string, column_value string, freq bigint"
NUMERIC_SCHEMA = (
    "schema_name string, table_name string, column_name string, variable string, value double, exact string"
)
DATE_SCHEMA = (
    "schema_name string, table_name string, column_name string, date_type string, column_value string, freq string"
)

# The statistics of a numeric profile and the deciles among them.
DECILES = {f"{tenth}0th_percentile": f"0.{tenth}" for tenth in range(1, 10)}
NUMERIC_VARIABLES = ("min_value", "max_value", "avg_value", "stddev_value", *DECILES, "null_values")


@dataclass(frozen=True)
class Profile:
    categorical: DataFrame
    numeric: DataFrame
    date: DataFrame


def profile(
    df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str,
    percentiles: str = "exact", accuracy: int = 10000,
) -> Profile:
    return Profile(
        profile_categorical(df, keys, schema_name, table_name),
        profile_numeric(df, keys, schema_name, table_name, percentiles, accuracy),
        profile_date(df, keys, schema_name, table_name),
    )


def _named(schema_name: str, table_name: str) -> list[Column]:
    return [F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name")]


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def melt(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(column_name, value): one row per column and input row."""
    typed = df.select([field(c).cast(dtype).alias(c) for c in columns])
    return typed.unpivot([], [field(c) for c in columns], "column_name", "value")


def profile_categorical(df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str) -> DataFrame:
    """Frequency of every value of every text column; null is a value too.

    All columns share one aggregation. Counts are combined before the shuffle,
    so a value held by a third of the rows costs one record per task.
    """
    columns = columns_of_class(df, TEXT, key_list(keys))
    if not columns:
        return _empty(df, CATEGORICAL_SCHEMA)
    counted = melt(df, columns, "string").groupBy("column_name", "value").agg(F.count("*").alias("freq"))
    return counted.select(
        *_named(schema_name, table_name), "column_name", F.col("value").alias("column_value"), "freq"
    )


def profile_numeric(
    df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str,
    percentiles: str = "exact", accuracy: int = 10000,
) -> DataFrame:
    """Range, mean, sample deviation, deciles and nulls of every numeric column.

    The result has one row per column and statistic. Statistics are doubles; the
    ends of integer and decimal columns are kept as ``exact`` text too, in the
    column's own type (up to 20 digits before and 18 after the point).
    ``percentiles="exact"``
    finds true deciles in a few scans that shuffle only bin counts;
    ``"approx"`` takes one scan with ``percentile_approx`` and suits tables of a
    few thousand partitions, since all sketches of a column meet in one reducer.
    """
    columns = columns_of_class(df, NUMBER, key_list(keys))
    if not columns:
        return _empty(df, NUMERIC_SCHEMA)
    if percentiles not in {"exact", "approx"}:
        raise ValueError(f"percentiles must be exact or approx, not {percentiles!r}")

    # all columns share nine aggregates, so a table with hundreds of columns needs no more code than one with two
    value = F.col("value")
    real = F.when(~F.isnan(value), value)
    aggregates = [
        F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.avg(value).alias("avg_value"),
        F.stddev_samp(value).alias("stddev_value"), F.count_if(value.isNull()).alias("null_values"),
        F.count(value).alias("n"), F.count_if(F.isnan(value)).alias("nan"), F.min(real).alias("low"),
        F.max(real).alias("high"),
    ]
    if percentiles == "approx":
        tenths = F.array(*[F.lit(float(p)) for p in DECILES.values()])
        aggregates.append(F.percentile_approx(value, tenths, accuracy).alias("deciles"))
    aggregates += [F.min("exact").alias("least"), F.max("exact").alias("most")]
    whole = [c for c in columns if isinstance(df.schema[c].dataType, (T.IntegralType, T.DecimalType))]
    exact = [(field(c) if c in whole else F.lit(None)).try_cast("decimal(38,18)") for c in columns]
    pairs = [F.struct(field(c).cast("double").alias("value"), e.alias("exact")) for c, e in zip(columns, exact)]
    summary = df.select(F.posexplode(F.array(*pairs)).alias("slot", "pair")).select("slot", "pair.*").groupBy("slot").agg(*aggregates)
    found = {columns[row["slot"]]: row.asDict() for row in summary.collect()}
    nothing = {"null_values": 0, "n": 0, "nan": 0}  # a table without rows
    stats = {c: found.get(c, nothing) for c in columns}

    if percentiles == "exact":
        ranges = {c: ColumnRange(s["n"], s["nan"], s.get("low"), s.get("high")) for c, s in stats.items()}
        deciles = exact_quantiles(df, columns, list(DECILES.values()), ranges)
    else:
        deciles = {
            (c, p): v for c, s in stats.items()
            for p, v in zip(DECILES.values(), s.get("deciles") or [None] * len(DECILES))
        }

    # one row per column and statistic, whatever the size of the table
    rows = [
        {"schema_name": schema_name, "table_name": table_name, "column_name": name, "variable": variable,
         "value": deciles[name, DECILES[variable]] if variable in DECILES else stats[name].get(variable),
         "exact": _plain(stats[name].get({"min_value": "least", "max_value": "most"}.get(variable, "")), df.schema[name].dataType)}
        for name in columns
        for variable in NUMERIC_VARIABLES
    ]
    text = ("schema_name", "table_name", "column_name", "variable")
    arrow_schema = pa.schema([*((c, pa.string()) for c in text), ("value", pa.float64()), ("exact", pa.string())])
    return df.sparkSession.createDataFrame(pa.Table.from_pylist(rows, arrow_schema))


def _plain(value: Decimal | None, dtype: T.DataType) -> str | None:
    """A number with as many digits after the point as its type has."""
    if value is None:
        return None
    scale = min(dtype.scale, 18) if isinstance(dtype, T.DecimalType) else 0
    return f"{value:.{scale}f}"


def profile_date(df: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str) -> DataFrame:
    """Rows per year, month and day of month, and the first and last value.

    One scan: the rows are first reduced to one record per column and calendar
    day, and the components and boundaries are taken from those together.
    """
    columns = columns_of_class(df, DATE, key_list(keys))
    if not columns:
        return _empty(df, DATE_SCHEMA)
    plain_dates = [c for c in columns if isinstance(df.schema[c].dataType, T.DateType)]
    is_date = F.col("column_name").isin(plain_dates) if plain_dates else F.lit(False)
    return date_metrics(days_of(df, columns).withColumn("is_date", is_date), schema_name, table_name)


def days_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, day, n, first, last): rows per column and calendar day, with the first and last value."""
    # wall-clock values: local-time columns keep theirs, others show the session zone's
    return (
        melt(df, columns, "timestamp_ntz")
        .groupBy("column_name", F.to_date("value").alias("day"))
        .agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))
    )


def date_metrics(days: DataFrame, schema_name: str, table_name: str) -> DataFrame:
    """The date profile of rows per day; ``is_date`` says whether a column holds days without a time."""
    # components and ends leave as rows of one kind, and one aggregation sums the former and joins the latter
    parts = [(F.lit(name), part("day").cast("string"), F.col("n")) for name, part in (
        ("year", F.year), ("month", F.month), ("day", F.dayofmonth),
    )] + [(F.lit("boundary"), F.lit(end), F.lit(0).cast("bigint")) for end in ("maximum", "minimum")]
    spread = days.select("column_name", "is_date", "first", "last", F.inline(F.array(*[
        F.struct(kind.alias("date_type"), value.alias("column_value"), n.alias("n")) for kind, value, n in parts
    ])))
    found = spread.groupBy("column_name", "is_date", "date_type", "column_value").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
    )

    def text_of(end: str) -> Column:
        return F.when(F.col("is_date"), F.to_date(end).cast("string")).otherwise(F.col(end).cast("string"))

    freq = F.when(F.col("date_type") != "boundary", F.col("n").cast("string")).when(
        F.col("column_value") == "maximum", text_of("last")
    ).otherwise(text_of("first"))
    return found.select(*_named(schema_name, table_name), "column_name", "date_type", "column_value", freq.alias("freq"))


def sort_metrics(metrics: DataFrame) -> DataFrame:
    """Order a metric table by schema, table and its remaining text columns."""
    keys = [f.name for f in metrics.schema if isinstance(f.dataType, T.StringType) and f.name not in {"freq", "value"}]
    return metrics.orderBy([F.asc_nulls_first(quoted(k)) for k in keys])
