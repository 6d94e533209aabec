"""Load modes: truncate and load, append, reject threshold, publish."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.functions.naming import field, unique_names
from lakeproof.operators.mapping import ColumnMap, conversion_errors, fill_type_defaults, map_columns_of
from lakeproof.session import scratch_path
from lakeproof.sinks.files import write_parquet
from lakeproof.sinks.fingerprint import copy_consistency
from lakeproof.sinks.versions import Version, commit, newest_version, read_part, read_table, replace_table, write_part


class LoadRejected(RuntimeError):
    """More rows failed to convert than the load allows. No row was loaded."""


class CopyMismatch(RuntimeError):
    """The copy does not hold the rows of its source."""


def truncate_load(df: DataFrame, path: str) -> Version:
    """Replace the content of a table in one step: a load that fails leaves the rows that were there.

    Read it with ``read_table``. Use ``write_jdbc(mode="overwrite", truncate=True)`` for a database.
    """
    return replace_table(df, path)


def autocreate_append(df: DataFrame, table: str, path: str | None = None) -> None:
    """Insert into a catalog table, creating it from the rows' schema on first use."""
    writer = df.write.format("parquet").mode("append")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def load_with_threshold(
    df: DataFrame, mapping: Sequence[ColumnMap], path: str, max_rejects: int | None = 0,
    use_type_default: bool = True, reject_path: str | None = None,
) -> int:
    """Load the rows that convert and return how many did not.

    The source is read and converted once, into a staged table of good and bad
    rows; what follows reads that. More than ``max_rejects`` stops the load
    before any row is loaded; None allows any number. The rows that failed are
    kept at ``reject_path``, also when the load is stopped. The rows at ``path``
    are replaced in one step; read them with ``read_table``.
    """
    spark, staging = df.sparkSession, scratch_path(df.sparkSession, "load")
    *_, errors, shown = unique_names([*df.columns, "bad", "bad_columns"])
    raw = df.select("*", conversion_errors(df, mapping).alias(errors))
    converted = F.struct(*map_columns_of(raw, mapping))
    is_bad = F.size(field(errors)) > 0
    split = raw.select(
        is_bad.cast("string").alias("is_bad"), F.when(~is_bad, converted).alias("good"),
        F.when(is_bad, F.struct(*[field(c) for c in df.columns], F.concat_ws(",", field(errors)).alias(shown))).alias("reject"),
    )
    split.write.partitionBy("is_bad").parquet(staging)
    staged = spark.read.schema(split.schema).parquet(staging)
    rejects = staged.where("is_bad = 'true'").select("reject.*")
    rejected = rejects.count()
    if reject_path is not None:
        write_parquet(rejects, reject_path)
    if max_rejects is not None and rejected > max_rejects:
        raise LoadRejected(f"{rejected} rows do not fit, {max_rejects} allowed")
    good = staged.where("is_bad = 'false'").select("good.*")
    replace_table(fill_type_defaults(good) if use_type_default else good, path)
    return rejected


def publish(spark: SparkSession, raw_path: str, published_path: str, check: bool = True) -> int:
    """Copy a landed Parquet folder to its published place and return the row count.

    The copy is compared with its source before it counts: readers (``read_table``) see the old
    version until a new one has been found to be whole.
    """
    raw, before = spark.read.parquet(raw_path), newest_version(spark, published_path)
    part = write_part(raw, published_path)
    copied = read_part(spark, published_path, part, raw.schema)
    result = copy_consistency(raw, copied).first() if check else None
    if result is not None and not result["consistent"]:
        raise CopyMismatch(f"{published_path}: {result['target_rows']} rows of {result['source_rows']}")
    commit(spark, published_path, [part], raw.schema, after=before.number if before else 0)
    return result["target_rows"] if result is not None else read_table(spark, published_path).count()


def merge_versions(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two versions of one delivery in one table, and (version, row_count) before and after."""
    merged = first.unionByName(second, allowMissingColumns=True)
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(version).alias("version"), "row_count")
        for version, df in (("first", first), ("second", second), ("merged", merged))
    ]
    return merged, counts[0].unionByName(counts[1]).unionByName(counts[2])

