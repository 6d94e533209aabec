"""Profiles that add up: what an increment contributes is stored, and merged without reading old rows.

The state of a table's part is four small tables: statistics and a distinct sketch per column,
counts in bins of geometric width, frequencies of text values, and rows per day. States of parts
add up to the state of the whole, and a state gives the same metric tables as ``profile``. Counts,
frequencies, dates, ends and nulls are exact; means and deviations are those of doubles added in
another order; deciles are within ``BIN_ERROR`` of the true one, relative to it; distinct counts
come from a sketch with a standard error of 1.6 percent.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field
from lakeproof.operators.profile import DECILES, Profile, date_metrics, days_of, melt
from lakeproof.operators.typeclass import DATE, NUMBER, TEXT, columns_of_class, key_list
from lakeproof.sinks.versions import newest_version, put_increment, read_table

#: How far a decile may be from the true one, relative to it.
BIN_ERROR = 0.005
#: The logarithm of the number of a distinct sketch's registers.
SKETCH_BITS = 12
#: The name under which rows and keys are counted; no column has it.
WHOLE_ROWS = ""
_WIDTH = math.log((1 + BIN_ERROR) / (1 - BIN_ERROR))
_ENDS = 100_000


@dataclass(frozen=True)
class ProfileState:
    """``columns`` (statistics and sketches), ``bins``, ``values`` and ``days`` of some rows."""

    columns: DataFrame
    bins: DataFrame
    values: DataFrame
    days: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"columns": self.columns, "bins": self.bins, "values": self.values, "days": self.days}


COLUMN_SCHEMA = (
    "column_name string, is_number boolean, scale int, n bigint, nulls bigint, nan bigint, low double, high double, mean double, spread double, "
    "least decimal(38,18), most decimal(38,18), sketch binary"
)
STATE_SCHEMAS = {
    "columns": COLUMN_SCHEMA, "bins": "column_name string, bin int, n bigint", "values": "column_name string, value string, n bigint",
    "days": "column_name string, is_date boolean, day date, n bigint, first timestamp_ntz, last timestamp_ntz",
}


def _bin(value: Column) -> Column:
    """The number of the bin of a double, in the order of values: 0 for zero, one more for each step of width, NaN last."""
    size = F.abs(value)
    # bins of numbers below one have negative logarithms, so they are moved up before the sign is put on
    step = F.least(F.greatest(F.floor(F.log(size) / _WIDTH), F.lit(-_ENDS + 1)), F.lit(_ENDS)) + _ENDS
    return (
        F.when(F.isnan(value), 3 * _ENDS).when(size == 0, 0).when(size == F.lit(float("inf")), F.signum(value) * (2 * _ENDS + 1))
        .otherwise(F.signum(value) * step).cast("int")
    )


def _value(number: Column) -> Column:
    """What stands for a bin: the number that is closest, relatively, to both of its ends."""
    step = F.abs(number)
    inside = F.signum(number) * F.exp((step - _ENDS) * _WIDTH) * (1 + BIN_ERROR)
    return (
        F.when(number == 3 * _ENDS, F.lit(float("nan"))).when(number == 0, F.lit(0.0))
        .when(step == 2 * _ENDS + 1, F.signum(number) * F.lit(float("inf"))).otherwise(inside)
    )


def state_of(df: DataFrame, keys: str | Sequence[str]) -> ProfileState:
    """The state of some rows: one scan for statistics and sketches, and one each for bins, texts and dates."""
    spark, parts = df.sparkSession, key_list(keys)
    numeric, columns = columns_of_class(df, NUMBER, parts), [*columns_of_class(df, NUMBER, parts), *columns_of_class(df, TEXT, parts), *columns_of_class(df, DATE, parts)]

    def entry(name: str | None) -> Column:
        if name is None:
            whole = reduce(Column.__and__, [field(k).isNotNull() for k in parts])
            text = F.to_json(F.struct(*[field(k).cast("string").alias(f"k{n}") for n, k in enumerate(parts)]))
            return F.struct(F.when(whole, text).alias("text"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("decimal(38,18)").alias("exact"))
        kind = df.schema[name].dataType
        is_whole = isinstance(kind, (T.IntegralType, T.DecimalType))
        return F.struct(
            field(name).cast("string").alias("text"), (field(name).cast("double") if name in numeric else F.lit(None).cast("double")).alias("value"),
            (field(name).try_cast("decimal(38,18)") if is_whole else F.lit(None).cast("decimal(38,18)")).alias("exact"),
        )

    named = [*columns, *([None] if parts else [])]
    long = df.select(F.posexplode(F.array(*map(entry, named))).alias("slot", "e")).select("slot", "e.*") if named else None
    value = F.col("value")
    real = F.when(~F.isnan(value), value)
    names = spark.createDataFrame(
        [(n, WHOLE_ROWS if c is None else c, c in numeric, _scale(df, c)) for n, c in enumerate(named)], "slot int, column_name string, is_number boolean, scale int"
    )
    if long is None:
        found = spark.createDataFrame([], COLUMN_SCHEMA)
    else:
        summed = long.groupBy("slot").agg(
            F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("nulls"), F.count_if(F.isnan(value)).alias("nan"),
            F.min(real).alias("low"), F.max(real).alias("high"), F.avg(real).alias("mean"), (F.var_pop(real) * F.count(real)).alias("spread"),
            F.min("exact").alias("least"), F.max("exact").alias("most"), F.hll_sketch_agg("text", F.lit(SKETCH_BITS)).alias("sketch"),
        )
        # a part without rows has a row for each of its columns too
        none = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n", "nulls", "nan")}
        found = names.join(summed, "slot", "left").withColumns(none)
    schemas = {name: T.StructType.fromDDL(ddl) for name, ddl in STATE_SCHEMAS.items()}

    def shaped(frame: DataFrame, name: str) -> DataFrame:
        return frame.select([field(f.name).cast(f.dataType).alias(f.name) for f in schemas[name]])

    def nothing(name: str) -> DataFrame:
        return spark.createDataFrame([], schemas[name])

    texts = columns_of_class(df, TEXT, parts)
    dates = columns_of_class(df, DATE, parts)
    bins = melt(df, numeric, "double").where("value IS NOT NULL").groupBy("column_name", _bin(value).alias("bin")).agg(F.count("*").alias("n")) if numeric else nothing("bins")
    values = melt(df, texts, "string").groupBy("column_name", "value").agg(F.count("*").alias("n")) if texts else nothing("values")
    plain = [c for c in dates if isinstance(df.schema[c].dataType, T.DateType)]
    days = days_of(df, dates).withColumn("is_date", F.col("column_name").isin(plain) if plain else F.lit(False)) if dates else nothing("days")
    return ProfileState(shaped(found, "columns"), shaped(bins, "bins"), shaped(values, "values"), shaped(days, "days"))


def _scale(df: DataFrame, name: str | None) -> int | None:
    """Digits after the point of a column's exact ends; none for a column without them."""
    kind = None if name is None else df.schema[name].dataType
    return min(kind.scale, 18) if isinstance(kind, T.DecimalType) else 0 if isinstance(kind, T.IntegralType) else None


def merge_states(state: ProfileState) -> ProfileState:
    """The state of the whole, from the states of its parts put together: one row per column, bin, value and day."""
    parts = F.collect_list(F.when(F.col("mean").isNotNull(), F.struct((F.col("n") - F.col("nulls") - F.col("nan")).alias("n"), "mean", "spread")))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("spread"))

    def add(one: Column, other: Column) -> Column:
        n = one["n"] + other["n"]
        apart = other["mean"] - one["mean"]
        mean = one["mean"] + apart * other["n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), (one["spread"] + other["spread"] + apart * apart * one["n"] * other["n"] / n).alias("spread"))

    columns = state.columns.groupBy("column_name").agg(
        F.max("is_number").alias("is_number"), F.max("scale").alias("scale"), *[F.sum(c).alias(c) for c in ("n", "nulls", "nan")], F.min("low").alias("low"), F.max("high").alias("high"),
        F.array_sort(parts).alias("parts"), F.min("least").alias("least"), F.max("most").alias("most"), F.hll_union_agg("sketch").alias("sketch"),
    ).withColumn("all", F.when(F.size("parts") > 0, F.aggregate("parts", start, add))).withColumns({"mean": F.col("all.mean"), "spread": F.col("all.spread")})
    schema = T.StructType.fromDDL(COLUMN_SCHEMA)
    return ProfileState(
        columns.select([field(f.name).cast(f.dataType).alias(f.name) for f in schema]),
        state.bins.groupBy("column_name", "bin").agg(F.sum("n").alias("n")), state.values.groupBy("column_name", "value").agg(F.sum("n").alias("n")),
        state.days.groupBy("column_name", "is_date", "day").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")),
    )


def store_state(state: ProfileState, path: str, key: str) -> None:
    """Keep an increment's state under its key, in place of what is there under that key.

    The four tables are committed one after the other, columns last; a run that dies between them is
    repeated under the same key.
    """
    for name, frame in reversed(state.tables().items()):
        put_increment(frame, f"{path.rstrip('/')}/{name}", key)


def read_state(spark: SparkSession, path: str) -> ProfileState:
    """The merged state of all increments that were stored."""
    root = path.rstrip("/")
    keys = [{p.key for p in version.parts} for name in STATE_SCHEMAS if (version := newest_version(spark, f"{root}/{name}"))]
    if not keys or len(keys) < len(STATE_SCHEMAS) or any(k != keys[0] for k in keys):
        raise ValueError(f"{path} holds increments that were not stored in full; store them again")
    return merge_states(ProfileState(*[read_table(spark, f"{root}/{name}") for name in STATE_SCHEMAS]))


def profile_of(state: ProfileState, schema_name: str, table_name: str) -> Profile:
    """The metric tables of a merged state, as ``profile`` gives them."""
    named = [F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name")]
    categorical = state.values.select(*named, "column_name", F.col("value").alias("column_value"), F.col("n").alias("freq"))
    running = Window.partitionBy("column_name").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = state.bins.withColumn("upto", F.sum("n").over(running)).withColumn("of", F.sum("n").over(Window.partitionBy("column_name")))
    deciles = counted.groupBy("column_name").agg(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(share).cast("decimal(2,1)") * F.col("of")), F.col("bin"))).alias(name) for name, share in DECILES.items()
    ])
    not_number = F.col("nan") > 0
    known = F.col("n") - F.col("nulls")
    real = known - F.col("nan")
    lost = F.lit(float("nan"))

    def plain(end: str) -> Column:
        text = F.col(end).cast("string")
        return F.when(F.col("scale") == 0, F.split_part(text, F.lit("."), F.lit(1))).otherwise(F.left(text, F.length(text) - 18 + F.col("scale")))

    def within(name: str) -> Column:
        """A decile is no further out than the ends; the middle of a bin may be."""
        return F.when(F.isnan(_value(F.col(name))), lost).otherwise(F.least(F.greatest(_value(F.col(name)), "low"), "high"))

    statistics = {
        "min_value": (F.coalesce("low", F.when(not_number, lost)), plain("least")), "max_value": (F.when(not_number, lost).otherwise(F.col("high")), plain("most")),
        "avg_value": (F.when(not_number, lost).otherwise(F.col("mean")), None), "stddev_value": (F.when(not_number & (known > 1), lost).when(real > 1, F.sqrt(F.col("spread") / (real - 1))), None),
        **{name: (within(name), None) for name in DECILES}, "null_values": (F.col("nulls").cast("double"), None),
    }
    rows = F.array(*[
        F.struct(F.lit(v).alias("variable"), value.alias("value"), (F.lit(None).cast("string") if exact is None else exact).alias("exact")) for v, (value, exact) in statistics.items()
    ])
    numeric = state.columns.where("is_number").join(deciles, "column_name", "left").select("column_name", F.inline(rows))
    return Profile(categorical, numeric.select(*named, "column_name", "variable", "value", "exact"), date_metrics(state.days, schema_name, table_name))


def key_counts(state: ProfileState) -> DataFrame:
    """(column_name, records, distinct_values): about how many values each column has, nulls apart; '' stands for the key."""
    return state.columns.select("column_name", F.col("n").alias("records"), F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("bigint")).alias("distinct_values"))
