"""Infer a warehouse type for every column from the text of its values."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import quoted
from lakeproof.operators.sampling import fair_sample

# Rank of a value and the type label of a column whose smallest
# rank it is. Rank 1 is long text; an all-null column (rank 9) has no label of
# its own and falls back to the widest text.
LABEL_BY_RANK = {
    2: "Varchar(255)",
    3: "Datetime",
    4: "Date",
    5: "Decimal(18,4)",
    6: "Bigint",
    7: "Int",
    8: "Bit",
}
WIDEST_LABEL = "Varchar(MAX)"
NULL_RANK = 9
INT_RANGE = (-(2**31), 2**31 - 1)

# Texts read as booleans.
BOOLEAN_TEXTS = ("true", "false", "t", "f", "yes", "no", "y", "n")

_TYPED_START = r"^[-+.0-9]"
_STAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_DOTTED = r"^[+-]?(\d+\.\d*|\.\d+)$"
_UP_TO_TEN_DIGITS = r"^[+-]?0*\d{1,10}$"
_FLOATING = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def value_rank(value: Column) -> Column:
    """Rank of one text value; the first test that holds decides.

    Dates and numbers start with a digit, sign or point, so other texts skip
    their patterns, and only short texts are compared with the boolean words.
    """
    text = F.when(F.length(value) <= 255, 2).otherwise(1)
    longest = max(map(len, BOOLEAN_TEXTS))
    typed = (
        F.when(value.rlike(_STAMP) & value.try_cast("timestamp_ntz").isNotNull(), 3)
        .when(value.rlike(_DATE) & value.try_cast("date").isNotNull(), 4)
        .when(value.rlike(_DOTTED), 5)
        # ten digits always fit a bigint, so no value pays for a failed cast
        .when(value.rlike(_UP_TO_TEN_DIGITS) & value.try_cast("bigint").between(*INT_RANGE), 7)
        .when(value.rlike(_FLOATING), 6)
        .otherwise(text)
    )
    return (
        F.when(value.isNull(), NULL_RANK)
        .when(value.rlike(_TYPED_START), typed)
        .when((F.length(value) <= longest) & F.lower(value).isin(*BOOLEAN_TEXTS), 8)
        .otherwise(text)
    )


def _known_rank(column: T.StructField) -> str | None:
    """The rank of a typed value, from its type and size, as SQL; none for text, which has to be looked at."""
    value, dtype = quoted(column.name), column.dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # from 1e7 and below 1e-3 numbers are shown with an exponent
        return (
            f"CASE WHEN {value} IS NULL THEN {NULL_RANK} WHEN isnan({value}) OR abs({value}) = double('infinity') THEN 2 "
            f"WHEN abs({value}) >= 1e7 OR abs({value}) < 1e-3 AND abs({value}) > 0 THEN 6 ELSE 5 END"
        )
    if isinstance(dtype, T.LongType):
        return f"CASE WHEN {value} IS NULL THEN {NULL_RANK} WHEN {value} BETWEEN {INT_RANGE[0]} AND {INT_RANGE[1]} THEN 7 ELSE 6 END"
    ranks = {
        7: (T.ByteType, T.ShortType, T.IntegerType), 4: T.DateType, 8: T.BooleanType, 3: (T.TimestampType, T.TimestampNTZType),
    }
    known = next((rank for rank, kinds in ranks.items() if isinstance(dtype, kinds)), None)
    return None if known is None else f"IF({value} IS NULL, {NULL_RANK}, {known})"


def infer_sql_types(df: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """(ordinal, column_name, type_rank, sql_type): one row per column.

    All columns share one scan and one minimum per column, taken before the
    shuffle. The tests of a text are one expression over the values of all text
    columns, so a table with hundreds of columns needs no more code than one
    with two. ``sample_rows`` looks at a fair sample of so many rows, the same
    however the table is partitioned.
    """
    source = df if sample_rows is None else fair_sample(df, sample_rows)
    values = []
    for column in df.schema:
        known = _known_rank(column)
        text = f"CAST({quoted(column.name)} AS STRING)" if known is None else "CAST(NULL AS STRING)"
        values.append(f"named_struct('text', {text}, 'known', CAST({known or 'NULL'} AS INT))")
    long = source.select(F.posexplode(F.expr(f"array({', '.join(values)})")).alias("slot", "value")).select("slot", "value.*")
    ranks = long.select("slot", F.coalesce("known", value_rank(F.col("text"))).alias("rank")).groupBy("slot").agg(
        F.min("rank").alias("rank")
    )
    names = pa.table({
        "slot": pa.array(range(len(df.columns)), pa.int32()), "column_name": pa.array(df.columns, pa.string()),
    })
    label = reduce(
        lambda rest, item: F.when(F.col("type_rank") == item[0], item[1]).otherwise(rest),
        LABEL_BY_RANK.items(), F.lit(WIDEST_LABEL),
    )
    # one row per column on both sides
    return df.sparkSession.createDataFrame(names).join(ranks, "slot", "left").select(
        (F.col("slot") + 1).alias("ordinal"), "column_name", F.coalesce("rank", F.lit(NULL_RANK)).alias("type_rank")
    ).withColumn("sql_type", label)
