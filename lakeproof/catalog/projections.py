"""Mapping, casting, cleaning and scalar expressions."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.registry import query
from lakeproof.catalog.tables import (
    ACID_EVENTS, BLANKED_EVENTS, CONFIG, CONFIG_COLUMNS, RAW_ORDERS, acid_events, blanked_events, config_documents,
    raw_orders, table,
)
from lakeproof.functions.casting import safe_cast
from lakeproof.functions.lake_paths import daily_file_name_column, dated_path_column
from lakeproof.functions.naming import field
from lakeproof.functions.zones import local_to_utc, utc_to_local
from lakeproof.operators import cleaning, mapping
from lakeproof.operators.acid import flatten_rows
from lakeproof.operators.mapping import ColumnMap
from lakeproof.sources.control import parse_config

RUN_TIME = datetime(2024, 1, 2, 3, 4, 5)

ORDERS_MAPPING = [
    ColumnMap("orders.o_orderkey", "O_ORDERKEY", "bigint"),
    ColumnMap("orders.o_custkey", "O_CUSTKEY", "decimal", 12, 0),
    ColumnMap("orders.o_totalprice", "O_TOTALPRICE", "decimal", 18, 2),
    ColumnMap("orders.o_orderdate", "O_ORDERDATE", "date"),
    ColumnMap("orders.o_orderpriority", "O_PRIORITY", "nvarchar", width=5),
]


def _dotted(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}.{c}" for c in df.columns])


@query("""
  SELECT o_orderkey AS "O_ORDERKEY", CAST(o_custkey AS DECIMAL(12, 0)) AS "O_CUSTKEY",
         CAST(o_totalprice AS DECIMAL(18, 2)) AS "O_TOTALPRICE", CAST(o_orderdate AS DATE) AS "O_ORDERDATE",
         substr(o_orderpriority, 1, 5) AS "O_PRIORITY", ' ' AS "XML_DATA"
  FROM orders
""")
def map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = _dotted(table(spark, sf_dir, "orders"), "orders")
    return mapping.map_columns(dotted, ORDERS_MAPPING).withColumn("XML_DATA", F.lit(" "))


@query("""
  SELECT c_custkey AS "CUSTKEY", CAST(c_acctbal AS DECIMAL(18, 2)) AS "BALANCE", c_mktsegment AS "SEGMENT" FROM customer
""")
def map_columns_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping itself is data: one document per nation's customer feed."""
    document = json.dumps({"mappings": [
        {"source": {"name": "c_custkey", "type": "Int64"}, "sink": {"name": "CUSTKEY", "type": "Int64"}},
        {"source": {"name": "c_acctbal", "type": "Decimal"},
         "sink": {"name": "BALANCE", "physicalType": "decimal", "precision": 18, "scale": 2}},
        {"source": {"name": "c_mktsegment", "type": "String"}, "sink": {"name": "SEGMENT", "type": "String"}},
    ]})
    mappings = table(spark, sf_dir, "nation").select(
        F.lit("sales").alias("schema_name"), F.lower("n_name").alias("table_name"), F.lit(document).alias("mapping")
    )
    found = mapping.mapping_from_table(mappings, "sales", "nation_0")
    return mapping.map_columns(table(spark, sf_dir, "customer"), found)


@query(f"""
  SELECT CAST(CASE WHEN key <= 32767 THEN key END AS SMALLINT) AS small, price, day, priority, flag
  FROM (SELECT CAST(o_orderkey AS BIGINT) AS key, TRY_CAST(o_totalprice AS DOUBLE) AS price,
               TRY_CAST(o_orderdate AS DATE) AS day, substr(o_orderpriority, 1, 3) AS priority,
               CAST(NULL AS INTEGER) AS flag
        FROM ({RAW_ORDERS}))
""")
def convert_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir).withColumn("is_open", F.col("o_orderpriority") == "1-URGENT")
    cast = lambda name, target, width=None: safe_cast(field(name), raw.schema[name].dataType, target, width)
    return raw.select(
        cast("o_orderkey", "smallint").alias("small"), cast("o_totalprice", "double").alias("price"),
        cast("o_orderdate", "date").alias("day"), cast("o_orderpriority", "string", 3).alias("priority"),
        cast("is_open", "int").alias("flag"),
    )


@query("""
  SELECT p_partkey AS "P_PARTKEY", p_name AS "P_NAME", p_brand AS "P_BRAND", p_type AS "P_TYPE", p_size AS "P_SIZE",
         p_retailprice AS "P_RETAILPRICE"
  FROM part
""")
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = _dotted(table(spark, sf_dir, "part"), "sales.part")
    return mapping.strip_table_prefix(dotted)


@query("""
  SELECT p_partkey AS "Part_Key", p_name AS "Shelf_Bay_Number", p_brand AS "Shelf_Bay_Number_2", p_type AS "Type",
         p_size AS "Size_cm", p_retailprice AS "Retail_Price"
  FROM part
""")
def normalize_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return mapping.normalize_headers(part.toDF("Part Key", "Shelf/Bay Number", "Shelf Bay/Number", " Type ", "Size/cm", "Retail Price"))


@query("""
  SELECT *, '2024-01-02 03:04:05' AS "LastUpdate", 'run-42' AS "CreatedBy", '2024-01-02 03:04:05' AS "Timestamp"
  FROM orders
""")
def add_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return mapping.add_load_timestamp(mapping.add_audit_columns(orders, RUN_TIME, "run-42"), RUN_TIME)


@query("""SELECT *, DATE '2024-01-02' AS "LoadDate" FROM customer""")
def add_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.add_load_date(table(spark, sf_dir, "customer"), date(2024, 1, 2))


@query(f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM ({ACID_EVENTS})")
def acid_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_rows(acid_events(spark, sf_dir))


@query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS remark FROM supplier")
def void_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.lit(None).alias("remark"))
    return cleaning.void_to_string(supplier)


@query(f"""
  SELECT event_id, ts, user_id, CASE WHEN event_type = '' THEN 'null' ELSE event_type END AS event_type, value, props
  FROM ({BLANKED_EVENTS})
""")
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.blank_to_null_text(blanked_events(spark, sf_dir))


@query("""
  SELECT o_orderkey AS "[1]o_orderkey", o_custkey AS "[2]o_custkey", o_orderstatus AS "[3]o_orderstatus",
         o_totalprice AS "[4]o_totalprice", o_orderdate AS "[5]o_orderdate", o_orderpriority AS "[6]o_orderpriority"
  FROM orders
""")
def schema_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.with_column_ids(table(spark, sf_dir, "orders"))


@query("""
  SELECT p_partkey, CASE WHEN p_size < 25 THEN '1' ELSE '0' END AS curated_flag,
         CASE WHEN p_size < 25 THEN 'curated_' ELSE 'published_' END || lower(p_type) AS schema_name
  FROM part
""")
def config_schema_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") < 25, "1").otherwise("0").alias("curated_flag"),
        F.concat(F.lit("published_"), F.lower("p_type")).alias("schema_name"),
    )
    return cleaning.rewrite_schema_name(config)


@query("""
  SELECT event_id, concat_ws('/', 'Raw', 'NZ', 'Full', 'Web', upper(event_type),
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y') WHEN 'view' THEN strftime(ts, '%Y/%m')
                WHEN 'error' THEN strftime(ts, '%Y/%m/%d') WHEN 'signup' THEN strftime(ts, '%Y/%m/%d/%H') END,
           'ERP_' || upper(event_type) || '_' || strftime(ts, '%Y_%m_%d_%H_%M') || '.parquet') AS path
  FROM events
""")
def dated_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    granularity = (
        F.when(kind == "click", "YY").when(kind == "view", "MM").when(kind == "error", "DD").when(kind == "signup", "HH")
    )
    path = dated_path_column(
        F.lit("Raw"), F.lit("NZ"), F.lit("Web"), F.lit("erp"), kind, F.col("ts"), granularity
    )
    return table(spark, sf_dir, "events").select("event_id", path.alias("path"))


@query("""
  SELECT o_orderkey, 'feed_' || strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') || '.zip' AS file_name FROM orders
""")
def daily_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = daily_file_name_column(F.lit("feed_"), F.to_date("o_orderdate"), F.lit(".zip"))
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))


@query("""
  WITH zoned AS (SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'Asia/Shanghai' WHEN 'view' THEN 'Asia/Bangkok'
    WHEN 'error' THEN 'Asia/Kolkata' WHEN 'signup' THEN 'Asia/Singapore' ELSE 'UTC' END AS zone FROM events),
  local AS (SELECT event_id, timezone(zone, timezone('UTC', ts)) AS moment FROM zoned)
  SELECT event_id, strftime(moment, '%Y') AS yyyy, strftime(moment, '%m') AS mm, strftime(moment, '%d') AS dd,
         strftime(moment - INTERVAL 7 DAY, '%Y-%m-%d') AS last_week, TRUE AS round_trip
  FROM local
""")
def local_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    zone = (
        F.when(kind == "click", "China Standard Time").when(kind == "view", "SE Asia Standard time")
        .when(kind == "error", "India Standard Time").when(kind == "signup", "Singapore Standard Time").otherwise("UTC")
    )
    at = utc_to_local(F.col("ts"), zone)
    local = table(spark, sf_dir, "events").select("event_id", "ts", at.alias("at"), zone.alias("zone"))
    return local.select(
        "event_id", F.date_format("at", "yyyy").alias("yyyy"), F.date_format("at", "MM").alias("mm"),
        F.date_format("at", "dd").alias("dd"),
        F.date_format(F.date_sub("at", 7), "yyyy-MM-dd").alias("last_week"),
        (local_to_utc(F.col("at"), F.col("zone")) == F.col("ts").cast("timestamp")).alias("round_trip"),
    )


@query(f"SELECT * FROM ({CONFIG})")
def config_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_config(config_documents(spark, sf_dir)).select(*CONFIG_COLUMNS)
