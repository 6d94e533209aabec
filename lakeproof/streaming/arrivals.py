"""Files as they arrive: windows of arrival, and deliveries that come twice.

A file's event time is when it was last modified. A delivery is known by its name and size, so the
same file put down again, in whatever folder, is the same delivery. Contents are not read to tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeproof.sinks.versions import newest_version, put_increment, read_table

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
DELIVERY = ("name", "size")


def file_arrivals(spark: SparkSession, path: str, name_glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (path, name, size, modified), one row per file below a folder."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
    if name_glob is not None:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(
        "path", F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def first_arrivals(arrivals: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The arrivals without those that repeat a delivery within the watermark.

    State is kept per delivery until ``delay`` has passed. A file that arrives later than that is late
    for its window whether it repeats another or not.
    """
    return arrivals.withWatermark("modified", delay).dropDuplicatesWithinWatermark(list(DELIVERY))


def arrival_windows(arrivals: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(window_start, window_end, files, bytes) of the deliveries that arrived in [start, end), each counted once.

    In append mode a window comes out once the watermark has passed its end.
    """
    counted = first_arrivals(arrivals, delay).groupBy(F.window("modified", window).alias("w")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "files", "bytes")


def ingest_deliveries(
    spark: SparkSession, landing: str, schema: T.StructType | str, target: str, checkpoint: str,
    file_format: str = "parquet", name_glob: str | None = None, files_per_trigger: int = 10_000,
) -> StreamingQuery:
    """Load the rows of all files that have arrived since the last run, each delivery once, however late it is.

    Every batch adds an increment to ``target`` (read it with ``read_table``), under its number, so a
    batch that is run again replaces what it wrote. Which deliveries are in is kept beside it, in
    ``{target}_deliveries``. Rows get ``delivered_name`` and ``delivered_at``. The paths of a batch's
    files, at most ``files_per_trigger``, pass through the driver, where Spark lists the files it reads.
    """
    known_path = f"{target.rstrip('/')}_deliveries"

    def load(batch: DataFrame, number: int) -> None:
        session, key = batch.sparkSession, f"{number:010d}"
        first = batch.groupBy(*DELIVERY).agg(F.min(F.struct("modified", "path")).alias("first")).select(
            *DELIVERY, F.col("first.modified").alias("modified"), F.col("first.path").alias("path")
        )
        if newest_version(session, known_path) is not None:
            before = read_table(session, known_path, key_column="batch").where(F.col("batch") != key)
            first = first.join(before.select(*DELIVERY), list(DELIVERY), "left_anti")
        rows = first.orderBy("path").collect()
        if rows:
            read = session.read.format(file_format).schema(schema).load([r["path"] for r in rows])
            named = read.select("*", F.col("_metadata.file_name").alias("delivered_name"), F.col("_metadata.file_modification_time").alias("delivered_at"))
            put_increment(named, target, key)
        put_increment(session.createDataFrame(rows, first.schema), known_path, key)

    stream = file_arrivals(spark, landing, name_glob, files_per_trigger)
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
