"""Load one table as its control record says: read, map, audit, land, publish, log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakeproof.functions.lake_paths import dated_path, object_path
from lakeproof.operators.mapping import ColumnMap, add_audit_columns, map_columns
from lakeproof.plans.runlog import finish_run, log_error, start_run
from lakeproof.plans.watermark import FULL_LOAD, advance, delta, read_mark
from lakeproof.sinks.files import write_parquet
from lakeproof.sinks.loads import publish


@dataclass(frozen=True)
class TableLoad:
    """``watermark_column`` names a landed column; without one every run loads everything."""

    system: str
    schema: str
    obj: str
    country: str
    granularity: str = "DD"
    mapping: Sequence[ColumnMap] = ()
    type_load: int = FULL_LOAD
    watermark_column: str | None = None
    config_id: int = 0


@dataclass(frozen=True)
class RunContext:
    run_id: str
    trigger_time: datetime
    trigger_id: str = "manual"
    enterprise_run_id: str = ""

    def record(self) -> dict:
        return {
            "ModuleRunId": self.run_id, "PipelineTriggerDT": self.trigger_time, "TriggerId": self.trigger_id,
            "Module": "Ingestion", "StartDate": self.trigger_time, "EntRunId": self.enterprise_run_id,
        }


def load_table(
    spark: SparkSession, source: DataFrame, load: TableLoad, run: RunContext, lake: str, log_path: str,
    error_path: str | None = None, marks_path: str | None = None,
) -> tuple[str, int]:
    """Land a source in the raw zone and publish it; returns the published path and the rows of this run.

    With a watermark column only rows above the old mark are landed, as a dated
    delivery, and published as one more increment of the object; the mark in
    ``marks_path`` moves last, so a run that failed is simply run again. What
    fails is logged to ``error_path`` and raised.
    """
    start_run(spark, log_path, run.record())
    activity, succeeded = "Map", False
    try:
        mapped = map_columns(source, load.mapping) if load.mapping else source
        place = (load.country, load.system, load.schema, load.obj, run.trigger_time, load.granularity)
        raw, published = (f"{lake}/{dated_path(zone, *place)}" for zone in ("Raw", "Published"))
        landed = add_audit_columns(mapped, run.trigger_time, run.run_id)
        column = load.watermark_column
        if column is not None:
            if marks_path is None:
                raise ValueError("a load with a watermark needs a place for its marks")
            old = read_mark(spark, marks_path, load.config_id, load.obj)
            landed = delta(landed, column, load.type_load, old)
        activity = "Land"
        write_parquet(landed, raw)
        activity = "Publish"
        if column is None:
            rows = publish(spark, raw, published)
        else:
            published = f"{lake}/{object_path('Published', load.country, load.system, load.obj)}"
            delivered = spark.read.parquet(raw)
            advance(spark, delivered, column, published, marks_path, load.config_id, load.obj, load.type_load)
            rows = delivered.count()
        succeeded = True
    except Exception as error:
        if error_path is not None:
            log_error(spark, error_path, error, f"{load.system}.{load.schema}.{load.obj}", run.run_id, activity)
        raise
    finally:
        finish_run(spark, log_path, run.record(), succeeded)
    return published, rows
