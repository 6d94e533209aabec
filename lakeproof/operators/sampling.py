"""Samples that don't depend on how a table is partitioned."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.naming import field, unique_names
from lakeproof.session import scratch_path

#: Hashes that order rows lie from 0 to this, and are spread evenly.
SPREAD = 1 << 60


def row_order(df: DataFrame) -> Column:
    """A hash of all columns; where a value is null counts too."""
    parts = [part for c in sorted(df.columns) for part in (field(c).isNull(), field(c))]
    return F.xxhash64(*parts).bitwiseAND(F.lit(SPREAD - 1))


def fair_sample(df: DataFrame, rows: int, by: Column | None = None, total: int | None = None) -> DataFrame:
    """``rows`` rows, those with the smallest hashes (``by``: other whole numbers spread evenly below ``SPREAD``).

    Every row is as likely as any other, and equal rows are as likely as their number. The same table
    gives the same rows however it is partitioned. A first count (or ``total``) tells below which hash
    about as many rows lie, so little more than the sample is shuffled; where that were too few rows, because many
    rows are equal, all tasks pass on their ``rows`` smallest.
    """
    total = df.count() if total is None else total
    if total <= rows:
        return df
    name = unique_names([*df.columns, "order"])[-1]
    hashed = df.withColumn(name, row_order(df) if by is None else by)
    share = (rows + 8 * math.sqrt(rows) + 8) / total
    if share < 0.5:
        path = scratch_path(df.sparkSession, "sample")
        hashed.where(field(name) < int(share * SPREAD)).write.parquet(path)
        few = df.sparkSession.read.schema(hashed.schema).parquet(path)
        hashed = few if few.count() >= rows else hashed
    return hashed.orderBy(name).limit(rows).drop(name)
