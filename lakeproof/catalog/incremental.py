"""Watermarks, logs and streams."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.registry import query
from lakeproof.catalog.staging import file_system
from lakeproof.catalog.tables import table
from lakeproof.operators.mapping import ColumnMap
from lakeproof.plans import ingest, runlog, watermark
from lakeproof.session import scratch_path
from lakeproof.sinks.versions import read_table
from lakeproof.sources.files import FileSelection
from lakeproof.sources.listing import walk_files
from lakeproof.streaming.arrivals import arrival_windows, file_arrivals, ingest_deliveries
from lakeproof.streaming.ingest import file_stream, ingest_available
from lakeproof.streaming.windows import windowed_frequencies

OLD_MARK = datetime(2024, 1, 11)


@query("""
  SELECT 'delta' AS load, event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-11 00:00:00'
  UNION ALL SELECT 'full', event_id, ts FROM events
""")
def delta_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    newer = watermark.delta(events, "ts", 0, OLD_MARK).select(F.lit("delta").alias("load"), "*")
    full = watermark.delta(events, "ts", watermark.FULL_LOAD, OLD_MARK).select(F.lit("full").alias("load"), "*")
    return newer.unionByName(full)


@query("""
  SELECT event_id, event_type, value, CASE WHEN ts <= TIMESTAMP '2024-01-11 00:00:00' THEN 'first' ELSE 'later' END AS increment,
         (SELECT CAST(max(ts) AS VARCHAR) FROM events) AS mark
  FROM events
""")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: the rows known at first, the rows that came later, and nothing new."""
    events = table(spark, sf_dir, "events")
    target, marks = scratch_path(spark, "increments"), scratch_path(spark, "marks")
    known = events.where(F.col("ts") <= F.lit(OLD_MARK).cast("timestamp_ntz"))
    for source in (known, events, events):
        mark = watermark.advance(spark, source, "ts", target, marks, 6, "events")
    increment = F.when(F.col("since").isNull(), "first").otherwise("later")
    return read_table(spark, target, key_column="since").select(
        "event_id", "event_type", "value", increment.alias("increment"), F.lit(mark).alias("mark")
    )


# in the order of their bytes, so that each mark is above the one before
SIGNS = " -/:_"


@query(f"""
  SELECT event_id, event_type AS since, 'A' || substr('{SIGNS}', CAST(user_id % 5 AS BIGINT) + 1, 1) || '1' AS mark,
         CASE WHEN user_id % 5 > 0 THEN 'A' || substr('{SIGNS}', CAST(user_id % 5 AS BIGINT), 1) || '1' END AS loaded_after
  FROM events
""")
def watermark_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs with marks that differ in one sign, over a table that has a column ``since``."""
    target, marks = scratch_path(spark, "signs"), scratch_path(spark, "sign-marks")
    mark = F.concat(F.lit("A"), F.substring(F.lit(SIGNS), (F.col("user_id") % 5 + 1).cast("int"), F.lit(1)), F.lit("1"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("since"), mark.alias("mark"))
    for sign in SIGNS:
        watermark.advance(spark, events.where(F.col("mark") <= f"A{sign}1"), "mark", target, marks, 7, "signs")
    return read_table(spark, target, key_column="loaded_after")


@query("""
  SELECT 'rows' AS kind, CASE WHEN ts <= TIMESTAMP '2024-01-11 00:00:00' THEN 'run-1' ELSE 'run-2' END AS name,
         CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY ALL
  UNION ALL SELECT 'mark', 'events', CAST(max(ts) AS VARCHAR) FROM events
  UNION ALL SELECT * FROM (VALUES ('status', 'run-1', 'Success'), ('status', 'run-2', 'Success'), ('status', 'run-3', 'Failed'),
    ('status', 'run-4', 'Success'), ('error', 'run-3/Map', 'KEY_NOT_EXISTS'))
""")
def load_table_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load, a delta, a run that fails, and its retry: rows by run, the mark, statuses and errors."""
    events = table(spark, sf_dir, "events")
    lake, log, errors, marks = (scratch_path(spark, n) for n in ("lake", "load-log", "load-errors", "load-marks"))
    mapping = [ColumnMap("event_id", "EVENT_ID", "bigint"), ColumnMap("ts", "TS", "datetime"), ColumnMap("value", "VALUE", "float")]
    broken = [*mapping, ColumnMap("no_such_column", "NOTHING", "string")]
    known = events.where(F.col("ts") <= F.lit(OLD_MARK).cast("timestamp_ntz"))
    for number, (source, columns) in enumerate(((known, mapping), (events, mapping), (events, broken), (events, mapping)), 1):
        load = ingest.TableLoad("WEB", "raw", "events", "NZ", "HH", columns, 0, "TS", 6)
        run = ingest.RunContext(f"run-{number}", datetime(2024, 2, 1, number))
        try:
            published, _ = ingest.load_table(spark, source, load, run, lake, log, errors, marks)
        except PySparkException:
            if columns is mapping:
                raise
    loaded = read_table(spark, published).groupBy(F.col("CreatedBy").alias("name")).agg(F.count("*").cast("string").alias("value"))
    mark = watermark.read_mark(spark, marks, 6, "events")
    parts = {
        "rows": loaded,
        "mark": spark.range(1).select(F.lit("events").alias("name"), F.lit(mark).alias("value")),
        "status": runlog.latest_status(spark.read.parquet(log)).select(F.col("ModuleRunId").alias("name"), F.col("PipelineStatus").alias("value")),
        "error": spark.read.parquet(errors).select(F.col("ActivityRunId").alias("name"), F.col("ErrorCode").alias("value")),
    }
    named = [df.select(F.lit(kind).alias("kind"), "name", "value") for kind, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@query("""
  SELECT 'run-' || o_orderkey AS "ModuleRunId", o_orderdate AS "StartDate",
         o_orderdate + CASE WHEN o_orderstatus = 'P' THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END AS "LastEvent",
         CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failed' END AS "PipelineStatus"
  FROM orders
""")
def run_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order stands for a run: it starts, and unless pending ends an hour later."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "Success").when(F.col("o_orderstatus") == "O", "Failed")

    def events(df: DataFrame, outcome, at) -> DataFrame:
        return df.select(
            F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("ModuleRunId"),
            F.col("o_orderdate").alias("StartDate"), outcome.cast("string").alias("PipelineStatus"), at.alias("event_time"),
        )

    started = events(orders, F.lit(None), F.col("o_orderdate"))
    ended = events(orders.where(status.isNotNull()), status, F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR"))
    path = scratch_path(spark, "runlog")
    started.write.parquet(path)
    ended.write.mode("append").parquet(path)
    return runlog.latest_status(spark.read.parquet(path))


@query("""
  SELECT event_type AS "PipelineName", 'copy_' || CAST(user_id % 10 AS VARCHAR) AS "Activity_Name",
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS "ErrorCode", count(*) AS error_count,
         min(ts) AS first_logged, max(ts) AS last_logged
  FROM events GROUP BY ALL
""")
def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "errors")
    table(spark, sf_dir, "events").select(
        F.concat(F.lit("copy_"), (F.col("user_id") % 10).cast("string")).alias("Activity_Name"),
        F.col("event_id").cast("string").alias("ActivityRunId"), F.lit("Copy").alias("ActivityType"),
        F.floor("value").cast("string").alias("ErrorCode"), F.col("ts").alias("ErrorLoggedTime"),
        F.col("props").alias("ErrorMessage"), F.col("event_type").alias("PipelineName"),
        F.col("user_id").cast("string").alias("PipelineRunId"),
    ).write.mode("append").parquet(path)
    return runlog.error_summary(spark.read.parquet(path))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and a third run with nothing new: every row arrives once."""
    events = table(spark, sf_dir, "events")
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "ingested", "ingest-checkpoint"))
    for delivery in (events.where("event_type = 'error'"), events.where("event_type <> 'error'"), None):
        if delivery is not None:
            delivery.write.mode("append").parquet(landing)
        ingest_available(file_stream(spark, landing, events.schema), target, checkpoint)
    return spark.read.parquet(target)


@query("""
  WITH files AS (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1),
  mark AS (SELECT max(day) + INTERVAL 4 HOUR AS mark FROM files)
  SELECT 'window' AS kind, day AS at, CAST(1 AS BIGINT) AS n FROM files, mark WHERE day + INTERVAL 1 DAY <= mark
  UNION ALL SELECT 'rows', day + INTERVAL 6 HOUR, n FROM files
""")
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each day that arrives at six, half of them put down again half an hour later, in two runs: files by window, and rows by arrival."""
    events, landing = table(spark, sf_dir, "events"), scratch_path(spark, "arrivals")
    daily = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    daily.repartition("day").write.partitionBy("day").parquet(f"{landing}/first")
    arrived = walk_files(spark, f"{landing}/first", "part-*").select("path", F.regexp_extract("path", r"day=([0-9-]+)/", 1).alias("day")).orderBy("day").collect()
    system, path_of = file_system(spark, landing)
    windows, target = scratch_path(spark, "arrival-windows"), scratch_path(spark, "arrival-rows")
    checkpoints = scratch_path(spark, "arrival-checkpoints")
    for run in ("first", "again"):
        for number, row in enumerate(arrived):
            at = int(datetime.fromisoformat(row["day"]).replace(tzinfo=UTC).timestamp()) * 1000 + 6 * 3_600_000
            path = row["path"]
            if run == "again":
                if number % 2:
                    continue
                path, at = f"{landing}/again/{row['path'].rsplit('/', 1)[1]}", at + 1_800_000
                system.mkdirs(path_of(f"{landing}/again"))
                spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, path_of(row["path"]), system, path_of(path), False, spark._jsc.hadoopConfiguration())
            system.setTimes(path_of(path), at, -1)
        ingest_available(arrival_windows(file_arrivals(spark, landing, "part-*"), "1 day", "2 hours"), windows, f"{checkpoints}/windows")
        ingest_deliveries(spark, landing, events.schema, target, f"{checkpoints}/rows", name_glob="part-*")
    counted = spark.read.parquet(windows).select(F.lit("window").alias("kind"), F.col("window_start").cast("timestamp_ntz").alias("at"), F.col("files").alias("n"))
    rows = read_table(spark, target).groupBy(F.col("delivered_at").cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("n"))
    return counted.unionByName(rows.select(F.lit("rows").alias("kind"), "at", "n"))


HOURS_SQL = """
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
         count(*) AS freq
  FROM events
  WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
  GROUP BY ALL
"""


@query(HOURS_SQL)
def stream_event_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly frequencies of all windows the watermark has closed."""
    stream = file_stream(
        spark, sf_dir, table(spark, sf_dir, "events").schema, selection=FileSelection(name_glob="events.parquet")
    )
    target, checkpoint = scratch_path(spark, "freq"), scratch_path(spark, "freq-checkpoint")
    ingest_available(windowed_frequencies(stream, "ts", "event_type"), target, checkpoint)
    return _wall_clock(spark.read.parquet(target))


def _wall_clock(frequencies: DataFrame) -> DataFrame:
    return frequencies.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("""
  WITH mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS first_mark FROM events WHERE event_type <> 'error'),
  accepted AS (SELECT e.*, date_trunc('hour', ts) AS h FROM events e, mark
    WHERE event_type <> 'error' OR date_trunc('hour', ts) + INTERVAL 1 HOUR > first_mark)
  SELECT h AS window_start, h + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS freq
  FROM accepted WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
  GROUP BY ALL
""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors arrive after everything else, so most of them are late and dropped."""
    events = table(spark, sf_dir, "events")
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("late-landing", "late", "late-checkpoint"))
    for delivery in (events.where("event_type <> 'error'"), events.where("event_type = 'error'")):
        delivery.write.mode("append").parquet(landing)
        stream = file_stream(spark, landing, events.schema)
        ingest_available(windowed_frequencies(stream, "ts", "event_type"), target, checkpoint)
    return _wall_clock(spark.read.parquet(target))
