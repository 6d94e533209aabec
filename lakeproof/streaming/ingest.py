"""Load files as they arrive, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeproof.sources.files import ALL_FILES, FileSelection


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet",
    selection: FileSelection = ALL_FILES, files_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema).options(**selection.options()).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def ingest_available(stream: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Write all files that have arrived since the last run, then stop.

    The checkpoint remembers which files are done; the Parquet sink's own log
    keeps a repeated batch from being read twice.
    """
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
