"""The given tables, and data that Spark derives from them, each with its SQL.

The derived data stands in for what the operators meet in a lake: a drifted
copy of a table, a file listing, control records, raw text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_UPDATE = "2024-01-02 03:04:05"
CREATED_BY = "run-0001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- a copy that lost some rows, drifted in one measure and gained audit columns

ORDERS_COPY = f"""
  SELECT o_orderkey, o_custkey, o_orderstatus,
         o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS o_totalprice,
         o_orderdate, o_orderpriority, '{LAST_UPDATE}' AS LastUpdate, '{CREATED_BY}' AS CreatedBy
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
"""


def orders_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    kept = orders.where(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")))
    drift = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    return kept.withColumns({
        "o_totalprice": F.col("o_totalprice") + drift,
        "LastUpdate": F.lit(LAST_UPDATE), "CreatedBy": F.lit(CREATED_BY),
    })


LINEITEM_COPY = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
         l_extendedprice + CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END AS l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')
"""


def lineitem_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    kept = lineitem.where(~((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")))
    drift = F.when(F.col("l_returnflag") == "A", 1.0).otherwise(0.0)
    return kept.withColumn("l_extendedprice", F.col("l_extendedprice") + drift)


# --- events with blank and missing text

BLANKED_EVENTS = """
  SELECT event_id, ts, user_id,
         CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE event_type END AS event_type,
         value, props
  FROM events
"""


def blanked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    blanked = F.when(kind == "error", "").when(kind == "view", F.lit(None)).otherwise(kind)
    return table(spark, sf_dir, "events").withColumn("event_type", blanked)


# --- orders as raw text, with amounts that do not convert

RAW_ORDERS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'n/a'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
  FROM orders
"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.select(
        F.col("o_orderkey").cast("string"),
        F.when((F.col("o_orderstatus") == "P") & urgent, "n/a")
        .when((F.col("o_orderstatus") == "O") & urgent, F.lit(None))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


# --- a listing of dated lake files, one per order, with odd names among them

LISTING = """
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '/Test_Validation' WHEN '2-HIGH' THEN '/Raw' ELSE '/Published' END
         || '/NZ/Full/ERP/' || o_orderstatus || '/' || strftime(o_orderdate, '%Y/%m/%d')
         || '/' || lpad(CAST(hour(o_orderdate) AS VARCHAR), 2, '0')
         || '/ERP_' || o_orderkey || '_' || strftime(o_orderdate, '%Y_%m_%d_%H_%M')
         || CASE o_orderpriority WHEN '3-MEDIUM' THEN '' WHEN '2-HIGH' THEN '.zip' ELSE '.parquet' END AS path,
         CAST(round(o_totalprice * 100) AS BIGINT) AS size,
         o_orderdate AS modified
  FROM orders
"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    zone = F.when(priority == "1-URGENT", "/Test_Validation").when(priority == "2-HIGH", "/Raw").otherwise("/Published")
    extension = F.when(priority == "3-MEDIUM", "").when(priority == "2-HIGH", ".zip").otherwise(".parquet")
    return orders.select(
        F.concat(
            zone, F.lit("/NZ/Full/ERP/"), "o_orderstatus", F.lit("/"), F.date_format("o_orderdate", "yyyy/MM/dd/HH"),
            F.lit("/ERP_"), F.col("o_orderkey").cast("string"), F.lit("_"),
            F.date_format("o_orderdate", "yyyy_MM_dd_HH_mm"), extension,
        ).alias("path"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size"),
        F.col("o_orderdate").alias("modified"),
    )


# --- control records, two per part: a full and a delta load

CONFIG = """
  SELECT CAST(p_partkey % 7 AS INTEGER) AS FwkSourceId,
         CASE WHEN p_size < 20 THEN 'Oracle' WHEN p_size < 35 THEN 'PostgreSQL' ELSE 'SFTP' END AS SourceType,
         CAST(p_partkey * 2 + load_kind AS INTEGER) AS FwkConfigId,
         upper(replace(p_name, ' ', '_')) AS SrcObject, 'published_' || lower(p_type) AS SchemaName,
         CAST(load_kind AS INTEGER) AS TypeLoad, CASE WHEN p_size = 1 THEN 'N' ELSE 'Y' END AS ActiveFlag,
         CASE WHEN p_size < 10 THEN 'YY' WHEN p_size < 20 THEN 'MM' WHEN p_size < 40 THEN 'DD' ELSE 'HH' END
           AS SinkPathGranularity,
         CAST(p_size % 5 AS INTEGER) AS FwkTriggerId, CAST(p_size AS INTEGER) AS BatchGroupId,
         CASE WHEN p_size < 25 THEN 'SE Asia Standard Time' ELSE 'China Standard time' END AS TimezoneName
  FROM (SELECT *, unnest([0, 1]) AS load_kind FROM part)
"""

CONFIG_COLUMNS = (
    "FwkSourceId", "SourceType", "FwkConfigId", "SrcObject", "SchemaName", "TypeLoad", "ActiveFlag",
    "SinkPathGranularity", "FwkTriggerId", "BatchGroupId", "TimezoneName",
)


def config_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array per part, with its two records."""
    size = F.col("p_size")

    def record(load_kind: int):
        return F.struct(
            (F.col("p_partkey") % 7).alias("FwkSourceId"),
            F.when(size < 20, "Oracle").when(size < 35, "PostgreSQL").otherwise("SFTP").alias("SourceType"),
            (F.col("p_partkey") * 2 + load_kind).alias("FwkConfigId"),
            F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("SrcObject"),
            F.concat(F.lit("published_"), F.lower("p_type")).alias("SchemaName"),
            F.lit(load_kind).alias("TypeLoad"),
            F.when(size == 1, "N").otherwise("Y").alias("ActiveFlag"),
            F.when(size < 10, "YY").when(size < 20, "MM").when(size < 40, "DD").otherwise("HH")
            .alias("SinkPathGranularity"),
            (size % 5).alias("FwkTriggerId"),
            size.alias("BatchGroupId"),
            F.when(size < 25, "SE Asia Standard Time").otherwise("China Standard time").alias("TimezoneName"),
        )

    return table(spark, sf_dir, "part").select(F.to_json(F.array(record(0), record(1))).alias("config"))


# --- transactional events of orders: an insert each, then updates and deletes

ACID_EVENTS = """
  SELECT 0 AS operation, o_orderkey AS rowId, 1 AS currentTransaction, o_orderkey, o_custkey, o_totalprice,
         o_orderpriority FROM orders
  UNION ALL
  SELECT 1, o_orderkey, 2, o_orderkey, o_custkey, o_totalprice + 1.0, o_orderpriority
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 2, o_orderkey, 3, NULL, NULL, NULL, NULL
  FROM orders WHERE o_orderpriority = '5-LOW'
"""


def acid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")

    def events(df: DataFrame, operation: int, transaction: int, row) -> DataFrame:
        return df.select(
            F.lit(operation).alias("operation"), F.lit(1).cast("bigint").alias("originalTransaction"),
            F.lit(0).alias("bucket"), F.col("o_orderkey").alias("rowId"),
            F.lit(transaction).cast("bigint").alias("currentTransaction"), row.alias("row"),
        )

    def row(price):
        return F.struct("o_orderkey", "o_custkey", price.alias("o_totalprice"), "o_orderpriority")

    price = F.col("o_totalprice")
    row_type = orders.select(row(price).alias("row")).schema["row"].dataType
    inserted = events(orders, 0, 1, row(price))
    updated = events(orders.where("o_orderstatus = 'F'"), 1, 2, row(price + 1.0))
    deleted = events(orders.where("o_orderpriority = '5-LOW'"), 2, 3, F.lit(None).cast(row_type))
    return inserted.unionByName(updated).unionByName(deleted)
