"""Order-free fingerprints of tables, to check that a copy is complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field


FINGERPRINT = ("row_count", "hash_xor", "high_sum", "low_sum")


def fingerprint(df: DataFrame) -> DataFrame:
    """Count, xor and sums of the row hashes over all columns, in one scan.

    A hash leaves out nulls, so it takes in whether each value is null beside the
    value: a value that has moved to another column shows. None of the four
    depends on the order of rows, and all combine before the shuffle. The
    sums catch rows that occur an even number of times, which xor cannot see.
    They take 24 bits each, so that a trillion rows stay within a bigint.
    """
    row_hash = F.xxhash64(*[part for c in sorted(df.columns) for part in (field(c).isNull(), field(c))])
    return df.select(row_hash.alias("h")).agg(*hash_sums())


def hash_sums(h: str = "h") -> list[Column]:
    """The aggregates of a fingerprint over a column of row hashes."""
    none = F.lit(0).cast("bigint")
    return [
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor(h), none).alias("hash_xor"),
        F.coalesce(F.sum(F.shiftright(h, 40)), none).alias("high_sum"),
        F.coalesce(F.sum(F.shiftright(F.shiftleft(h, 40), 40)), none).alias("low_sum"),
    ]


def copy_consistency(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: row counts of both sides and whether their fingerprints agree.

    Only the columns of the source count; the target may carry audit columns.
    """
    sides = fingerprint(source).withColumn("is_source", F.lit(True)).unionByName(
        fingerprint(target.select([field(c) for c in source.columns])).withColumn("is_source", F.lit(False))
    )
    return sides.agg(
        F.max(F.when(F.col("is_source"), F.col("row_count"))).alias("source_rows"),
        F.max(F.when(~F.col("is_source"), F.col("row_count"))).alias("target_rows"),
        (F.count_distinct(*FINGERPRINT) == 1).alias("consistent"),
    )
