"""Run and error logs as append-only events."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_EVENT = (
    "ModuleRunId string, PipelineTriggerDT timestamp, TriggerId string, Module string, "
    "StartDate timestamp, EntRunId string, PipelineStatus string, event_time timestamp"
)
ERROR_EVENT = (
    "Activity_Name string, ActivityRunId string, ActivityType string, ErrorCode string, "
    "ErrorLoggedTime timestamp, ErrorMessage string, PipelineName string, PipelineRunId string"
)


def append_events(spark: SparkSession, path: str, rows: list[dict], schema: str, clock: str) -> None:
    """Append a few log rows made on the driver. Rows without a time in ``clock`` get Spark's own."""
    timed = spark.createDataFrame(rows, schema).withColumn(clock, F.coalesce(clock, F.current_timestamp()))
    timed.coalesce(1).write.mode("append").parquet(path)


def start_run(spark: SparkSession, path: str, run: dict, at: datetime | None = None) -> None:
    """A new run has no status yet."""
    append_events(spark, path, [{**run, "PipelineStatus": None, "event_time": at}], RUN_EVENT, "event_time")


def finish_run(spark: SparkSession, path: str, run: dict, succeeded: bool, at: datetime | None = None) -> None:
    status = "Success" if succeeded else "Failed"
    append_events(spark, path, [{**run, "PipelineStatus": status, "event_time": at}], RUN_EVENT, "event_time")


def log_error(
    spark: SparkSession, path: str, error: BaseException, pipeline: str, run_id: str, activity: str, at: datetime | None = None
) -> None:
    """Append what went wrong in an activity of a run."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    append_events(spark, path, [{
        "Activity_Name": activity, "ActivityRunId": f"{run_id}/{activity}", "ActivityType": type(error).__name__,
        "ErrorCode": condition or type(error).__name__, "ErrorLoggedTime": at, "ErrorMessage": str(error),
        "PipelineName": pipeline, "PipelineRunId": run_id,
    }], ERROR_EVENT, "ErrorLoggedTime")


def latest_status(events: DataFrame) -> DataFrame:
    """The newest status of every run; null while it is running.

    A run that has ended keeps its status whatever the clocks of the machines
    that logged its start and its end say.
    """
    newest = F.max_by(F.struct("PipelineStatus"), F.struct(F.col("PipelineStatus").isNotNull(), "event_time")).alias("newest")
    return events.groupBy("ModuleRunId").agg(
        F.min("StartDate").alias("StartDate"), F.max("event_time").alias("LastEvent"), newest
    ).select("ModuleRunId", "StartDate", "LastEvent", "newest.PipelineStatus")


def error_summary(errors: DataFrame) -> DataFrame:
    """Errors per pipeline, activity and code, with the first and last time."""
    return errors.groupBy("PipelineName", "Activity_Name", "ErrorCode").agg(
        F.count("*").alias("error_count"), F.min("ErrorLoggedTime").alias("first_logged"),
        F.max("ErrorLoggedTime").alias("last_logged"),
    )
