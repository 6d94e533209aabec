"""Value frequencies per time window over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_frequencies(
    stream: DataFrame, time: str, value: str, window: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """(window_start, window_end, value, freq).

    In append mode a window comes out once the watermark has passed its end;
    rows for a window that is already out are dropped as late.
    """
    stamped = stream.withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", delay)
    counted = stamped.groupBy(F.window("event_time", window).alias("w"), F.col(value)).agg(F.count("*").alias("freq"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), value, "freq"
    )
