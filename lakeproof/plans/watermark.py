"""High-watermark loads: read the old mark, load what is newer, then move the mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.sinks.versions import commit, newest_version, read_part, write_part

FULL_LOAD = 1

MARK_SCHEMA = "config_id bigint, src_object string, mark string, moved_at timestamp, state string"
# A full reload announces itself before it replaces anything, and every load commits its mark.
RELOADING, COMMITTED = "reloading", "committed"


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_watermark"))


def delta(df: DataFrame, column: str, type_load: int, old_mark: object | None) -> DataFrame:
    """All rows of a full load, or the rows above the old mark.

    The mark is a literal of the column's type, so the comparison reaches the
    scan as a pushed filter.
    """
    if type_load == FULL_LOAD or old_mark is None:
        return df
    return df.where(F.col(column) > F.lit(old_mark).cast(df.schema[column].dataType))


def read_mark(spark: SparkSession, marks_path: str, config_id: int, src_object: str) -> str | None:
    """The newest mark of an object, as text; None before its first load and after a full reload that did not end."""
    try:
        marks = spark.read.schema(MARK_SCHEMA).parquet(marks_path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    committed = F.coalesce(F.col("state"), F.lit(COMMITTED)) == COMMITTED
    newest = marks.where((F.col("config_id") == config_id) & (F.col("src_object") == src_object)).agg(
        F.max_by(F.struct("mark", committed.alias("committed")), F.struct("moved_at", committed)).alias("newest")
    ).first()["newest"]
    return newest["mark"] if newest is not None and newest["committed"] else None


def _record(
    spark: SparkSession, marks_path: str, config_id: int, src_object: str, mark: str | None, state: str, now: datetime | None
) -> None:
    spark.range(1).select(
        F.lit(config_id).cast("bigint").alias("config_id"), F.lit(src_object).alias("src_object"),
        F.lit(mark).cast("string").alias("mark"),
        (F.lit(now).cast("timestamp") if now else F.current_timestamp()).alias("moved_at"), F.lit(state).alias("state"),
    ).write.mode("append").partitionBy("config_id").parquet(marks_path)


def advance(
    spark: SparkSession, source: DataFrame, column: str, target_path: str, marks_path: str,
    config_id: int, src_object: str, type_load: int = 0, now: datetime | None = None,
) -> str | None:
    """Load one increment and return the new mark.

    The target is a table with versions (``sinks.versions``); an increment is one of its parts, under
    the old mark as it is. If a run fails between committing the rows and moving the mark, the next
    run starts from the same old mark and replaces the part of that mark, so nothing is loaded twice
    and no other increment is touched. The new mark is read from what was written. A full load
    replaces all increments in one step; it announces itself first, and one that died before it moved
    the mark is done again in full by the next run, whatever that run was to load. Until a version is
    committed readers see the one before.
    """
    old = read_mark(spark, marks_path, config_id, src_object)
    before = newest_version(spark, target_path)
    full = old is None or before is None or type_load == FULL_LOAD
    batch = source if full else delta(source, column, type_load, old)
    if full and old is not None:
        _record(spark, marks_path, config_id, src_object, old, RELOADING, now)
    part = write_part(batch, target_path, None if full else old)
    new = read_part(spark, target_path, part, source.schema).agg(F.max(column).cast("string")).first()[0]
    if not full and new is None:
        return old
    kept = [] if full else [p for p in before.parts if p.key != old]
    schema = source.schema if full else before.schema
    commit(spark, target_path, [*kept, part], schema, {"mark": new}, before.number if before else 0)
    _record(spark, marks_path, config_id, src_object, new, COMMITTED, now)
    return new
