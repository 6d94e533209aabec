"""Exact discrete quantiles of many columns without sorting or shuffling the rows.

A sketch per task, merged in one reducer, does not survive hundreds of
thousands of tasks, and an exact sort moves every value. Instead each pass
counts the values per histogram bin (partial aggregation on the map side, so
only bin counts are shuffled), finds the bin that holds each wanted rank and
splits just that bin in the next pass. A bin whose smallest and largest value
are equal is the answer. Two or three passes are usual.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeproof.functions.naming import field

DEFAULT_BINS = 512

_PLACES = pa.schema([
    ("slot", pa.int32()), ("place", pa.int32()), ("bracket_low", pa.float64()), ("bracket_high", pa.float64()),
    ("unit", pa.float64()), ("start", pa.float64()), ("scale", pa.float64()),
])
_WANTED = pa.schema([
    ("place", pa.int32()), ("column_name", pa.string()), ("probability", pa.string()),
    ("wanted_rank", pa.int64()), ("offset", pa.int64()),
])


@dataclass(frozen=True)
class Bracket:
    """``count`` values of one column in [low, high]; ``below`` values are smaller than low.

    ``unit`` asks for bins of equal width in the logarithm of value / unit,
    which splits heavy tails that bins of equal width would not.
    """

    low: float
    high: float
    below: int
    count: int
    unit: float | None = None

    def stretched(self, value: float) -> float:
        """A value on the scale that is cut into equal bins. Halving keeps the width of finite values finite."""
        if self.unit is None:
            return value / 2
        return math.copysign(math.log1p(abs(value) / self.unit), value)

    def scale(self, bins: int) -> float:
        width = self.stretched(self.high) - self.stretched(self.low)
        return bins / width if width else math.inf

    def inner(self, low: float, high: float, below: int, count: int) -> Bracket:
        """The bin to split next; the other kind of bins is tried where this one kept most values together."""
        unit = None
        if count > self.count / 2 and self.unit is None:
            unit = max(abs(low), abs(high)) * 2.0**-60
        return Bracket(low, high, below, count, unit if unit and math.isfinite(unit) else None)


@dataclass(frozen=True)
class ColumnRange:
    """What a summary pass knows of a column: non-null values, NaNs and the finite range."""

    count: int
    nan_count: int
    low: float | None
    high: float | None


def column_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnRange]:
    real = F.when(~F.isnan("value"), F.col("value"))
    rows = long_form(df, columns).groupBy("slot").agg(
        F.count("value").alias("n"), F.count_if(F.isnan("value")).alias("nan"), F.min(real).alias("low"),
        F.max(real).alias("high"),
    ).collect()
    found = {columns[r["slot"]]: ColumnRange(r["n"], r["nan"], r["low"], r["high"]) for r in rows}
    return {c: found.get(c, ColumnRange(0, 0, None, None)) for c in columns}


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(slot, value): the value of every column as a double, by position."""
    return df.select(F.posexplode(F.array(*[field(c).cast("double") for c in columns])).alias("slot", "value"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[str],
    ranges: Mapping[str, ColumnRange] | None = None, bins: int = DEFAULT_BINS,
) -> dict[tuple[str, str], float | None]:
    """The smallest value whose cumulative share reaches each probability.

    ``probabilities`` are decimal texts such as ``"0.1"``, so that ranks come
    from exact arithmetic. What reaches the driver is one row per column and
    probability. NaN counts as larger than any number, as Spark orders it.
    """
    ranges = ranges or column_ranges(df, columns)
    answers: dict[tuple[str, str], float | None] = {}
    pending: dict[str, dict[Bracket, dict[str, int]]] = {}
    for column in columns:
        known = ranges[column]
        wanted: dict[str, int] = {}
        for p in probabilities:
            rank = max(1, -(-Fraction(p) * known.count // 1))
            if known.count == 0:
                answers[column, p] = None
            elif rank > known.count - known.nan_count:
                answers[column, p] = float("nan")
            elif known.low == known.high:
                answers[column, p] = known.low
            else:
                wanted[p] = int(rank)
        if wanted:
            pending[column] = {Bracket(known.low, known.high, 0, known.count - known.nan_count): wanted}

    while pending:
        brackets_of = {(c, p): b for c, brackets in pending.items() for b, wanted in brackets.items() for p in wanted}
        following: dict[str, dict[Bracket, dict[str, int]]] = defaultdict(lambda: defaultdict(dict))
        for hit in _split_brackets(df, pending, bins).collect():
            if hit["low"] == hit["high"]:
                answers[hit["column_name"], hit["probability"]] = hit["low"]
            else:
                outer = brackets_of[hit["column_name"], hit["probability"]]
                inner = outer.inner(hit["low"], hit["high"], hit["below"], hit["n"])
                following[hit["column_name"]][inner][hit["probability"]] = hit["wanted_rank"]
        pending = following
    return answers


def _split_brackets(df: DataFrame, pending: Mapping[str, Mapping[Bracket, Mapping[str, int]]], bins: int) -> DataFrame:
    """One pass: the bin of every wanted rank, with its value range."""
    names = list(pending)
    places, wanted_rows = [], []
    for slot, name in enumerate(names):
        for bracket, wanted in pending[name].items():
            wanted_rows += [
                {"place": len(places), "column_name": name, "probability": p, "wanted_rank": rank,
                 "offset": bracket.below}
                for p, rank in wanted.items()
            ]
            places.append({
                "slot": slot, "place": len(places), "bracket_low": bracket.low, "bracket_high": bracket.high,
                "unit": bracket.unit, "start": bracket.stretched(bracket.low), "scale": bracket.scale(bins),
            })
    spark = df.sparkSession
    brackets = spark.createDataFrame(pa.Table.from_pylist(places, _PLACES))
    wanted = spark.createDataFrame(pa.Table.from_pylist(wanted_rows, _WANTED))

    value, low, high = F.col("value"), F.col("bracket_low"), F.col("bracket_high")
    logarithm = F.signum("value") * F.log1p(F.abs("value") / F.col("unit"))
    stretched = F.when(F.col("unit").isNull(), value / 2).otherwise(logarithm)
    position = (stretched - F.col("start")) * F.col("scale")
    # the two ends always fall into different bins, so every pass makes progress
    bin_of = (
        F.when(value == low, 0)
        .when(value == high, bins - 1)
        .when(F.isnan(position), 1)
        .otherwise(F.least(F.greatest(F.floor(position), F.lit(0)), F.lit(bins - 1)).cast("int"))
    )
    counted = (
        # at most one bracket per column and probability, so the broadcast is small for any table;
        # NaN lies above every bracket
        long_form(df, names).join(F.broadcast(brackets), "slot")
        .where((value >= low) & (value <= high))
        .groupBy((F.col("place") * bins + bin_of).alias("code"))
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("place", F.floor(F.col("code") / bins).cast("int"))
    )
    # at most `bins` rows per window partition, whatever the size of the table
    upto = W.partitionBy("place").orderBy("code").rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = F.col("offset") + F.col("reached")
    return (
        counted.withColumn("reached", F.sum("n").over(upto))
        .join(wanted, "place")
        .where((F.col("wanted_rank") <= reached) & (F.col("wanted_rank") > reached - F.col("n")))
        .select("column_name", "probability", "wanted_rank", "low", "high", "n", (reached - F.col("n")).alias("below"))
    )

