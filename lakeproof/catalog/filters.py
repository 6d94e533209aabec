"""Selections over control records, listings and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.registry import query
from lakeproof.catalog.tables import CONFIG, CONFIG_COLUMNS, LISTING, config_documents, listing, table
from lakeproof.operators import inventory
from lakeproof.operators.acid import MARKER_FILE, table_dirs
from lakeproof.sinks.retention import retention_candidates as past_retention
from lakeproof.sources.control import active_rows, config_for_source, parse_config
from lakeproof.sources.files import CsvDialect, read_csv
from lakeproof.session import scratch_path
from lakeproof.sinks.files import write_csv


@query(f"SELECT * FROM ({CONFIG}) WHERE SourceType = 'Oracle'")
def config_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_for_source(parse_config(config_documents(spark, sf_dir)), "Oracle").select(*CONFIG_COLUMNS)


@query("""
  SELECT p_brand AS container, 'published_' || lower(p_type) AS schema_name, p_name AS table_name,
         'p_partkey' AS primary_key, 'parquet' AS file_format, '/' || CAST(p_partkey AS VARCHAR) AS file_path, '1' AS active
  FROM part WHERE p_size < 25
""")
def config_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("container"), F.concat(F.lit("published_"), F.lower("p_type")).alias("schema_name"),
        F.col("p_name").alias("table_name"), F.lit("p_partkey").alias("primary_key"),
        F.lit("parquet").alias("file_format"),
        F.concat(F.lit("/"), F.col("p_partkey").cast("string")).alias("file_path"),
        F.when(F.col("p_size") < 25, "1").otherwise("0").alias("active"),
    )
    path = scratch_path(spark, "config")
    write_csv(config, path)
    return active_rows(read_csv(spark, path, CsvDialect()), 6)


@query(f"SELECT * FROM ({LISTING}) WHERE path NOT LIKE '/Test\\_Validation%' ESCAPE '\\'")
def listing_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.exclude_results(listing(spark, sf_dir))


@query(f"SELECT * FROM ({LISTING}) WHERE contains(regexp_extract(path, '[^/]*$'), 'zip')")
def listing_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.name_contains(listing(spark, sf_dir), "zip")


@query(f"SELECT * FROM ({LISTING}) WHERE CAST(modified AS DATE) < DATE '1998-07-01'")
def stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.stale_files(listing(spark, sf_dir), F.lit("1998-07-01 09:30:00").cast("timestamp_ntz"))


@query(f"""
  WITH expected AS (SELECT regexp_replace(path, '\\.zip$', '.parquet') AS path FROM ({LISTING}))
  SELECT e.path, CASE WHEN e.path IN (SELECT path FROM ({LISTING})) THEN 'FileFound' ELSE 'FileNotFound' END AS status
  FROM expected e
""")
def expected_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = listing(spark, sf_dir)
    expected = present.select(F.regexp_replace("path", r"\.zip$", ".parquet").alias("path"))
    return inventory.expected_outputs(expected, present)


@query("""
  WITH named AS (
    SELECT event_type, ts, unnest(string_split('KPI_' || event_type || ';AGG_' || CAST(user_id AS VARCHAR), ';')) AS name,
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y') WHEN 'view' THEN strftime(ts, '%Y/%m')
                WHEN 'error' THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%Y/%m/%d/%H') END AS dir
    FROM events)
  SELECT event_type AS "FunctionName", name,
         concat_ws('/', event_type, name, dir, name || '_' || strftime(ts, '%Y%m%d%H%M') || '.csv') AS path
  FROM named
""")
def transformation_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    runs = table(spark, sf_dir, "events").select(
        kind.alias("FunctionName"),
        F.concat(F.lit("KPI_"), kind, F.lit(";AGG_"), F.col("user_id").cast("string")).alias("FileTransformationName"),
        F.when(kind == "click", "YY").when(kind == "view", "MM").when(kind == "error", "DD").otherwise("HH")
        .alias("TransformationPathGranularity"),
        F.col("ts").alias("OutputUpdateDate"),
    )
    return inventory.transformation_outputs(runs)


@query(f"""
  SELECT count(*) AS missing, count(*) = 0 AS complete FROM ({LISTING}) WHERE path LIKE '%.zip'
""")
def outputs_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.all_outputs_present(expected_outputs(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def expected_tables_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    wanted = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return inventory.members_of(orders, wanted, "c_custkey").withColumnRenamed("c_custkey", "o_custkey")


@query("""
  SELECT coalesce(c.k, o.k) AS custkey, CASE WHEN o.k IS NULL THEN 'left_only' ELSE 'right_only' END AS _merge
  FROM (SELECT DISTINCT c_custkey AS k FROM customer) c
  FULL OUTER JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') o ON c.k = o.k
  WHERE c.k IS NULL OR o.k IS NULL
""")
def table_list_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    ordering = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return inventory.list_difference(customers, ordering, "custkey")


@query(f"""
  SELECT DISTINCT regexp_replace(path, '[^/]*$', '') AS table_dir FROM ({LISTING}) WHERE path LIKE '%.zip'
""")
def acid_table_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders with an archive stand for transactional tables: their marker sits beside it."""
    files = listing(spark, sf_dir)
    markers = files.where(F.endswith("path", F.lit(".zip"))).select(
        F.regexp_replace("path", "[^/]+$", MARKER_FILE).alias("path")
    )
    return table_dirs(files.select("path").unionByName(markers))


@query(f"""
  SELECT regexp_extract(path, '^(.*/\\d{{4}}/\\d{{2}}/\\d{{2}})/', 1) AS folder, CAST(modified AS DATE) AS folder_date,
         count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
  FROM ({LISTING}) WHERE CAST(modified AS DATE) <= DATE '1998-07-01' - INTERVAL 7 DAY
  GROUP BY ALL
""")
def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return past_retention(listing(spark, sf_dir), F.lit("1998-07-01").cast("date"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_linenumber, l_extendedprice LIMIT 10")
def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows in key order; Spark keeps ten rows per task, no full sort."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.orderBy("l_orderkey", "l_linenumber", "l_extendedprice").limit(10)
