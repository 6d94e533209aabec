"""Sinks and load modes: write, then read back what was stored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.registry import query
from lakeproof.catalog.staging import write_json_arrays
from lakeproof.catalog.sqltext import categorical_sql, union_all
from lakeproof.catalog.tables import RAW_ORDERS, orders_copy, raw_orders, table
from lakeproof.operators.mapping import ColumnMap, split_incompatible
from lakeproof.operators.profile import CATEGORICAL_SCHEMA, profile_categorical
from lakeproof.session import scratch_path
from lakeproof.sinks import files, fingerprint, loads, versions
from lakeproof.sinks.versions import read_table

RAW_MAPPING = [
    ColumnMap("o_orderkey", "ORDERKEY", "bigint"),
    ColumnMap("o_totalprice", "TOTALPRICE", "float"),
    ColumnMap("o_orderdate", "ORDERDATE", "date"),
    ColumnMap("o_orderpriority", "PRIORITY", "nvarchar", width=20),
]


@query(union_all([f"SELECT '{origin}' AS origin, * FROM orders" for origin in ("csv", "json", "parquet", "xml")]))
def convert_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table with all its types from four formats, each converted to Parquet."""
    orders = table(spark, sf_dir, "orders")
    converted = []
    for origin in ("csv", "json", "parquet", "xml"):
        source, target = scratch_path(spark, origin), scratch_path(spark, f"{origin}-parquet")
        options = {"row_tag": "order"} if origin == "xml" else {}
        if origin == "csv":
            files.write_csv(orders, source)
        elif origin == "xml":
            orders.write.format("xml").option("rowTag", "order").save(source)
        elif origin == "json":
            write_json_arrays(orders, source)
        else:
            orders.write.parquet(source)
        files.convert_to_parquet(spark, source, origin, target, schema=orders.schema, **options)
        converted.append(spark.read.parquet(target).select(F.lit(origin).alias("origin"), *orders.columns))
    result = converted[0]
    for other in converted[1:]:
        result = result.unionByName(other)
    return result


@query("""
  SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderpriority AS label, o_totalprice AS amount, o_orderdate AS day FROM orders
  UNION ALL SELECT p_partkey, p_name, p_retailprice, NULL FROM part
""")
def convert_orc_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of two tables after their conversion."""
    pairs = {}
    for name in ("orders", "part"):
        source = scratch_path(spark, f"orc-{name}")
        table(spark, sf_dir, name).write.orc(source)
        pairs[source] = scratch_path(spark, f"parquet-{name}")
    files.convert_orc_tables(spark, pairs)
    orders, part = (spark.read.parquet(path) for path in pairs.values())
    return orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_orderpriority").alias("label"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("day"),
    ).unionByName(part.select(
        F.col("p_partkey").cast("bigint").alias("id"), F.col("p_name").alias("label"), F.col("p_retailprice").alias("amount"),
        F.lit(None).cast("timestamp_ntz").alias("day"),
    ))


@query(categorical_sql("documents", ["text", "lang", "source"], "corpus", "documents"))
def metrics_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of any length, with separators, quotes and line breaks, survive the metric files."""
    path = scratch_path(spark, "metrics")
    files.write_metrics(profile_categorical(table(spark, sf_dir, "documents"), "doc_id", "corpus", "documents"), path)
    return files.read_metrics(spark, path, CATEGORICAL_SCHEMA)


@query("SELECT * FROM orders")
def zone_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, published = scratch_path(spark, "Raw"), scratch_path(spark, "Published")
    files.write_parquet(table(spark, sf_dir, "orders"), raw)
    loads.publish(spark, raw, published)
    return read_table(spark, published)


@query(f"""
  SELECT 'whole' AS copy, count(*) AS source_rows, count(*) AS target_rows, TRUE AS consistent FROM lineitem
  UNION ALL SELECT 'drifted', (SELECT count(*) FROM orders),
    (SELECT count(*) FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')), FALSE
  UNION ALL SELECT 'moved', count(*), count(*), FALSE FROM orders
""")
def copy_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, path = table(spark, sf_dir, "lineitem"), scratch_path(spark, "consistent")
    files.write_parquet(lineitem, path)
    whole = fingerprint.copy_consistency(lineitem, spark.read.parquet(path))
    drifted = fingerprint.copy_consistency(table(spark, sf_dir, "orders"), orders_copy(spark, sf_dir))
    # every row has one of two texts; the copy has it in the other column
    first = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    second = F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders")
    moved = fingerprint.copy_consistency(
        orders.select("o_orderkey", first.alias("first"), second.alias("second")),
        orders.select("o_orderkey", second.alias("first"), first.alias("second")),
    )
    results = {"whole": whole, "drifted": drifted, "moved": moved}
    named = [df.select(F.lit(name).alias("copy"), "*") for name, df in results.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("SELECT * FROM part")
def truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading twice leaves one copy."""
    part, path = table(spark, sf_dir, "part"), scratch_path(spark, "truncate")
    loads.truncate_load(part, path)
    loads.truncate_load(part, path)
    return read_table(spark, path)


@query("""
  SELECT 1 AS version, o_orderkey, o_totalprice, o_orderpriority FROM orders
  UNION ALL SELECT 2, o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT 3, o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
""")
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, a writer that dies before its commit, a load of fewer rows, and one that reads the table it replaces."""
    path = scratch_path(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    versions.replace_table(orders, path)
    versions.write_part(orders.where("o_orderpriority = '5-LOW'"), path)
    versions.replace_table(orders.where("o_orderstatus <> 'F'"), path)
    versions.replace_table(read_table(spark, path).where("o_orderstatus = 'O'"), path)
    seen = [read_table(spark, path, number).select(F.lit(number).alias("version"), "o_orderkey", "o_totalprice", "o_orderpriority") for number in (1, 2, 3)]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT * FROM supplier")
def autocreate_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load creates the table, the second appends to it."""
    supplier, name = table(spark, sf_dir, "supplier"), f"supplier_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "autocreate")
    loads.autocreate_append(supplier, name, path)
    loads.autocreate_append(supplier, name, path)
    stored = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {name}")  # the files stay, they belong to the path
    return stored


@query(union_all([
    f"""
  SELECT 'loaded' AS outcome, CAST(o_orderkey AS BIGINT) AS orderkey,
         coalesce(TRY_CAST(o_totalprice AS DOUBLE), 0) AS price, CAST(o_orderdate AS DATE) AS day
  FROM ({RAW_ORDERS}) WHERE o_totalprice IS NULL OR o_totalprice <> 'n/a'""",
    f"""
  SELECT 'rejected', CAST(o_orderkey AS BIGINT), NULL, NULL FROM ({RAW_ORDERS}) WHERE o_totalprice = 'n/a'""",
]))
def load_reject_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = scratch_path(spark, "loaded"), scratch_path(spark, "rejected")
    loads.load_with_threshold(raw_orders(spark, sf_dir), RAW_MAPPING, good, max_rejects=None, reject_path=bad)
    loaded = read_table(spark, good).select(
        F.lit("loaded").alias("outcome"), F.col("ORDERKEY").alias("orderkey"), F.col("TOTALPRICE").alias("price"),
        F.col("ORDERDATE").alias("day"),
    )
    rejected = spark.read.parquet(bad).select(
        F.lit("rejected").alias("outcome"), F.col("o_orderkey").cast("bigint").alias("orderkey"),
        F.lit(None).cast("double").alias("price"), F.lit(None).cast("date").alias("day"),
    )
    return loaded.unionByName(rejected)


@query(union_all([
    f"""
  SELECT '' AS bad_columns, CAST(o_orderkey AS BIGINT) AS orderkey, TRY_CAST(o_totalprice AS DOUBLE) AS price
  FROM ({RAW_ORDERS}) WHERE o_totalprice IS NULL OR o_totalprice <> 'n/a'""",
    f"""
  SELECT 'o_totalprice', CAST(o_orderkey AS BIGINT), NULL FROM ({RAW_ORDERS}) WHERE o_totalprice = 'n/a'""",
]))
def skip_incompatible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejects = split_incompatible(raw_orders(spark, sf_dir), RAW_MAPPING)
    return good.select(
        F.lit("").alias("bad_columns"), F.col("ORDERKEY").alias("orderkey"), F.col("TOTALPRICE").alias("price")
    ).unionByName(rejects.select(
        "bad_columns", F.col("o_orderkey").cast("bigint").alias("orderkey"), F.lit(None).cast("double").alias("price")
    ))


@query("""
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
         CAST(value AS VARCHAR) AS value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, props
  FROM events
""")
def merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries with their columns in different order, merged into two delimited files with all text quoted."""
    path, merged = scratch_path(spark, "parts"), scratch_path(spark, "merged")
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    errors, tabbed = F.col("event_type") == "error", files.CsvDialect(sep="\t")
    files.write_csv(events.where(errors), f"{path}/errors", tabbed)
    files.write_csv(events.where(~errors).select(*reversed(events.columns)), f"{path}/others", tabbed)
    files.merge_text_files(spark, [f"{path}/errors", f"{path}/others"], merged, tabbed, files=2)
    return files.read_csv(spark, merged, tabbed)


@query("SELECT *, 1 AS files FROM customer")
def write_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table on five partitions, in one file with its header."""
    path, customer = scratch_path(spark, "single"), table(spark, sf_dir, "customer")
    files.write_single_csv(customer.repartition(5), path)
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).count()
    return files.read_csv(spark, path, schema=customer.schema).withColumn("files", F.lit(written))


@query("""
  WITH first AS (SELECT * FROM events WHERE event_type <> 'error'), second AS (SELECT * FROM events WHERE event_type <> 'click')
  SELECT 'first' AS version, count(*) AS row_count FROM first UNION ALL SELECT 'second', count(*) FROM second
  UNION ALL SELECT 'merged', (SELECT count(*) FROM first) + (SELECT count(*) FROM second)
""")
def merge_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return loads.merge_versions(events.where("event_type <> 'error'"), events.where("event_type <> 'click'"))[1]


@query("""
  SELECT event_id, event_type FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, event_type FROM events WHERE event_type <> 'click'
""")
def merge_versions_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return loads.merge_versions(events.where("event_type <> 'error'"), events.where("event_type <> 'click'"))[0]
