"""Compare the metrics of a source table with those of its copy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field
from lakeproof.operators.profile import CATEGORICAL_SCHEMA, melt
from lakeproof.operators.typeclass import TEXT, columns_of_class, key_list

# The join keys of each metric table.
METADATA_KEYS = ("table_name", "measure")
NUMERIC_KEYS = ("table_name", "column_name", "variable")
CATEGORICAL_KEYS = ("table_name", "column_name", "column_value")
DATE_KEYS = ("table_name", "date_type", "column_name", "column_value")


def value_diff(source: Column, target: Column) -> Column:
    return source.cast("double") - target.cast("double")


def exact_diff(source: Column, target: Column) -> Column:
    """The difference of two numbers given as text, to the last digit; null where one is missing.

    The digits before and after the point are subtracted apart, since their
    difference as a whole would not fit a decimal.
    """

    def whole(text: Column) -> Column:
        return F.substring_index(text, ".", 1).try_cast("decimal(38,0)")

    def part(text: Column) -> Column:
        digits = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("0")
        return F.concat(F.when(F.startswith(text, F.lit("-")), "-0.").otherwise("0."), digits).try_cast("decimal(18,18)")

    return (whole(source) - whole(target)).cast("double") + (part(source) - part(target)).cast("double")


def percent_diff(source: Column, target: Column) -> Column:
    """(source - target) / source x 100; null for a zero source."""
    return F.try_divide(value_diff(source, target), source.cast("double")) * 100


def ratio_percent(source: Column, target: Column) -> Column:
    return F.try_divide(source.cast("double"), target.cast("double")) * 100


def join_sides(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str = "outer") -> DataFrame:
    """Join two metric tables of one shape; null keys match each other.

    Columns of the target that are no keys get the suffix ``_tgt``. ``_merge``
    tells which side a row came from.
    """
    keys = list(keys)
    left = source.withColumn("_in_src", F.lit(True)).alias("s")
    right = target.withColumn("_in_tgt", F.lit(True)).alias("t")
    condition = None
    for key in keys:
        equal = left["s." + key].eqNullSafe(right["t." + key])
        condition = equal if condition is None else condition & equal
    joined = left.join(right, condition, how)
    presence = (
        F.when(F.col("_in_tgt").isNull(), "left_only")
        .when(F.col("_in_src").isNull(), "right_only")
        .otherwise("both")
    )
    from_source = F.col("_in_src").isNotNull()
    return joined.select(
        *[F.when(from_source, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys],
        *[F.col(f"s.{c}").alias(c) for c in source.columns if c not in keys],
        *[F.col(f"t.{c}").alias(f"{c}_tgt") for c in target.columns if c not in keys],
        presence.alias("_merge"),
    )


def with_differences(joined: DataFrame, measure: str, prefix: str = "") -> DataFrame:
    """Add the absolute and the percent difference of a measure and its ``_tgt``."""
    source, target = field(measure), field(f"{measure}_tgt")
    names = (f"{prefix}ValueDiff", f"{prefix}PercentDiff") if prefix else ("value_diff", "percent_diff")
    return joined.withColumns({names[0]: value_diff(source, target), names[1]: percent_diff(source, target)})


def compare_metadata(
    source: DataFrame, target: DataFrame, keys: Sequence[str] = METADATA_KEYS, how: str = "outer"
) -> DataFrame:
    return with_differences(join_sides(source, target, keys, how), "freq")


def compare_categorical(
    source: DataFrame, target: DataFrame, keys: Sequence[str] = CATEGORICAL_KEYS, how: str = "outer"
) -> DataFrame:
    return with_differences(join_sides(source, target, keys, how), "freq")


def compare_numeric(
    source: DataFrame, target: DataFrame, keys: Sequence[str] = NUMERIC_KEYS, how: str = "outer", digits: int = 4
) -> DataFrame:
    """Doubles are rounded before they are compared; where both sides have the exact number, that is."""
    joined = join_sides(source, target, keys, how)
    rounded = joined.withColumns({c: F.round(c, digits) for c in ("value", "value_tgt")})
    difference = F.coalesce(exact_diff(F.col("exact"), F.col("exact_tgt")), value_diff(F.col("value"), F.col("value_tgt")))
    return rounded.withColumns({
        "value_diff": difference, "percent_diff": F.try_divide(difference, F.col("value")) * 100,
    })


def compare_date(
    source: DataFrame, target: DataFrame, keys: Sequence[str] = DATE_KEYS, how: str = "outer"
) -> DataFrame:
    """``value_diff`` is true where both sides show the same text; both missing is the same."""
    joined = join_sides(source, target, keys, how)
    return joined.withColumn("value_diff", F.col("freq").eqNullSafe(F.col("freq_tgt")))


def null_slice(compared: DataFrame) -> DataFrame:
    """The rows for blank values, which cleaning turned into the text ``null``."""
    return compared.where(F.col("column_value") == "null")


def reconcile_categorical(
    source: DataFrame, target: DataFrame, keys: str | Sequence[str], schema_name: str, table_name: str,
    target_schema_name: str | None = None,
) -> DataFrame:
    """``compare_categorical`` straight from the two tables, with one shuffle.

    Both tables feed one aggregation that counts each side, instead of two
    aggregations and a join of their results. Grouping matches null to null.
    """
    parts = key_list(keys)
    sides = []
    for df, is_source in ((source, True), (target, False)):
        columns = columns_of_class(df, TEXT, parts)
        if columns:
            sides.append(melt(df, columns, "string").withColumn("is_source", F.lit(is_source)))
    if not sides:
        empty = source.sparkSession.createDataFrame([], CATEGORICAL_SCHEMA)
        return compare_categorical(empty, empty)
    counted = reduce(DataFrame.unionByName, sides).groupBy("column_name", F.col("value").alias("column_value")).agg(
        F.count_if("is_source").alias("n_source"), F.count_if(~F.col("is_source")).alias("n_target")
    )
    in_source, in_target = F.col("n_source") > 0, F.col("n_target") > 0
    matched = counted.select(
        F.lit(table_name).alias("table_name"), "column_name", "column_value",
        F.when(in_source, schema_name).alias("schema_name"), F.when(in_source, F.col("n_source")).alias("freq"),
        F.when(in_target, target_schema_name or schema_name).alias("schema_name_tgt"),
        F.when(in_target, F.col("n_target")).alias("freq_tgt"),
        F.when(~in_target, "left_only").when(~in_source, "right_only").otherwise("both").alias("_merge"),
    )
    return with_differences(matched, "freq")


def compare_file_sizes(source: DataFrame, target: DataFrame) -> DataFrame:
    """Listings of (FilePath, FileName, SizeBytes, FileType), matched on path."""
    return with_differences(join_sides(source, target, ["FilePath"]), "SizeBytes", "FileSize")


def compare_folder_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Folder inventories of (Path, FolderCount, FileCount), matched on path."""
    joined = join_sides(source, target, ["Path"])
    return with_differences(with_differences(joined, "FolderCount", "FolderCount"), "FileCount", "FileCount")
