"""Profiles, counts, type inference and inventories."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.registry import query
from lakeproof.catalog.sqltext import categorical_sql, date_sql, numeric_sql, primary_key_sql, union_all
from lakeproof.catalog.tables import (
    ACID_EVENTS, CONFIG, LISTING, ORDERS_COPY, acid_events, blanked_events, config_documents, listing, orders_copy,
    table,
)
from lakeproof.operators.acid import resolve_rows
from lakeproof.operators import counts, profile_state
from lakeproof.operators.infer import infer_sql_types as infer
from lakeproof.operators.inventory import dir_size as roll_up
from lakeproof.operators.inventory import (
    exclude_results, file_inventory as files_of, folder_inventory as folders_of, latest_partition as newest,
    table_count as count_tables,
)
from lakeproof.operators.profile import profile, profile_categorical as categorical, profile_date as dates
from lakeproof.operators.profile import profile_numeric as numeric
from lakeproof.operators.profile import sort_metrics
from lakeproof.operators.sampling import fair_sample
from lakeproof.plans.watermark import max_watermark as highest
from lakeproof.session import scratch_path
from lakeproof.catalog.staging import make_folders
from lakeproof.sources.listing import relative_to, walk_files, walk_folders
from lakeproof.sources.control import batch_groups, mapping_tables as distinct_tables, parse_config


def rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("value", F.round("value", 4)).drop("exact")


def rounded_sql(sql: str) -> str:
    return f"SELECT schema_name, table_name, column_name, variable, round(value, 4) AS value FROM ({sql})"


COUNTED = {"orders": 6, "customer": 5, "lineitem": 11, "documents": 5, "embeddings": 3}


@query(union_all([
    f"SELECT '{t}' AS tblnm, '{n}' AS columncount, count(*) AS rowcount FROM {t}" for t, n in COUNTED.items()
]))
def row_column_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.row_column_count({t: table(spark, sf_dir, t) for t in COUNTED})


@query(
    "SELECT 'orders' AS tblnm, '6' AS columncount, count(*) AS rowcount FROM orders UNION ALL "
    f"SELECT 'orders_copy', '8', count(*) FROM ({ORDERS_COPY}) UNION ALL "
    "SELECT 'no_orders', '6', count(*) FROM orders WHERE o_totalprice < 0"
)
def row_column_count_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return counts.row_column_count({
        "orders": orders, "orders_copy": orders_copy(spark, sf_dir), "no_orders": orders.where("o_totalprice < 0"),
    })


@query(primary_key_sql("lineitem", ["l_orderkey", "l_linenumber"], 11, "sales", "lineitem"))
def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.check_primary_key(table(spark, sf_dir, "lineitem"), "l_orderkey, l_linenumber", "sales", "lineitem")


@query(primary_key_sql("orders", ["o_orderkey"], 6, "sales", "orders"))
def check_primary_key_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.check_primary_key(table(spark, sf_dir, "orders"), "o_orderkey", "sales", "orders")


@query(categorical_sql("part", ["p_name", "p_brand", "p_type"], "sales", "part"))
def profile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categorical(table(spark, sf_dir, "part"), "p_partkey", "sales", "part")


@query(categorical_sql("documents", ["text", "lang", "source"], "corpus", "documents"))
def profile_categorical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categorical(table(spark, sf_dir, "documents"), "doc_id", "corpus", "documents")


LINEITEM_NUMBERS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(rounded_sql(numeric_sql("lineitem", LINEITEM_NUMBERS, "sales", "lineitem")))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(numeric(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "sales", "lineitem"))


@query(date_sql("events", ["ts"], "web", "events"))
def profile_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates(table(spark, sf_dir, "events"), "event_id", "web", "events")


@query(union_all([
    f"SELECT 'categorical' AS kind, column_name, column_value AS item, '' AS part, CAST(freq AS DOUBLE) AS value "
    f"FROM ({categorical_sql('orders', ['o_orderstatus', 'o_orderpriority'], 'sales', 'orders')})",
    "SELECT 'numeric', column_name, variable, '', round(value, 4) "
    f"FROM ({numeric_sql('orders', ['o_custkey', 'o_totalprice'], 'sales', 'orders')})",
    "SELECT 'date', column_name, column_value, date_type, TRY_CAST(freq AS DOUBLE) "
    f"FROM ({date_sql('orders', ['o_orderdate'], 'sales', 'orders')})",
]))
def profile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile(table(spark, sf_dir, "orders"), "o_orderkey", "sales", "orders")
    kind = lambda name: F.lit(name).alias("kind")
    none = F.lit("").alias("part")
    return (
        found.categorical.select(
            kind("categorical"), "column_name", F.col("column_value").alias("item"), none,
            F.col("freq").cast("double").alias("value"),
        )
        .unionByName(found.numeric.select(
            kind("numeric"), "column_name", F.col("variable").alias("item"), none, F.round("value", 4).alias("value")
        ))
        .unionByName(found.date.select(
            kind("date"), "column_name", F.col("column_value").alias("item"), F.col("date_type").alias("part"),
            F.col("freq").try_cast("double").alias("value"),
        ))
    )


@query(
    "SELECT schema_name, table_name, column_name, column_value, freq FROM "
    f"({categorical_sql('customer', ['c_name', 'c_mktsegment'], 'sales', 'customer')}) "
    "ORDER BY schema_name, table_name, column_name, column_value NULLS FIRST"
)
def metrics_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_metrics(categorical(table(spark, sf_dir, "customer"), "c_custkey", "sales", "customer"))


def _text_rank(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 9
      WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}:\\d{{2}}') AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL THEN 3
      WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST({c} AS DATE) IS NOT NULL THEN 4
      WHEN regexp_full_match({c}, '[+-]?(\\d+\\.\\d*|\\.\\d+)') THEN 5
      WHEN regexp_full_match({c}, '[+-]?\\d+') AND TRY_CAST({c} AS INTEGER) IS NOT NULL THEN 7
      WHEN regexp_full_match({c}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN 6
      WHEN lower({c}) IN ('true', 'false', 't', 'f', 'yes', 'no', 'y', 'n') THEN 8
      WHEN length({c}) <= 255 THEN 2 ELSE 1 END"""


def _double_rank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 9 WHEN abs({c}) >= 1e7 OR (abs({c}) < 1e-3 AND {c} <> 0) THEN 6 ELSE 5 END"


def infer_sql(columns: list[tuple[str, str]], relation: str, name: str) -> str:
    ranks = union_all([
        f"SELECT {i} AS ordinal, '{c}' AS column_name, CAST(coalesce(min({rank}), 9) AS INTEGER) AS type_rank "
        f"FROM {relation}"
        for i, (c, rank) in enumerate(columns, start=1)
    ])
    return (
        f"SELECT '{name}' AS table_name, ordinal, column_name, type_rank, CASE type_rank WHEN 2 THEN 'Varchar(255)' "
        "WHEN 3 THEN 'Datetime' WHEN 4 THEN 'Date' WHEN 5 THEN 'Decimal(18,4)' WHEN 6 THEN 'Bigint' "
        f"WHEN 7 THEN 'Int' WHEN 8 THEN 'Bit' ELSE 'Varchar(MAX)' END AS sql_type FROM ({ranks})"
    )


def _long_rank(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 9 WHEN {c} BETWEEN -2147483648 AND 2147483647 THEN 7 ELSE 6 END"


ORDERS_TEXT = (
    "(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority "
    "FROM orders)"
)


@query(union_all([
    infer_sql(
        [(c, _text_rank(c)) for c in
         ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")],
        ORDERS_TEXT, "orders_as_text",
    ),
    infer_sql(
        [("doc_id", _long_rank("doc_id")), ("text", _text_rank("text")), ("lang", _text_rank("lang")),
         ("source", _text_rank("source")), ("n_chars", _long_rank("n_chars"))], "documents", "documents",
    ),
    infer_sql(
        [("event_id", _long_rank("event_id")), ("ts", "CASE WHEN ts IS NULL THEN 9 ELSE 3 END"),
         ("user_id", _long_rank("user_id")), ("event_type", _text_rank("event_type")),
         ("value", _double_rank("value")), ("props", _text_rank("props"))], "events", "events",
    ),
]))
def infer_sql_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    sources = {
        "orders_as_text": orders.select([F.col(c).cast("string").alias(c) for c in orders.columns]),
        "documents": table(spark, sf_dir, "documents"),
        "events": table(spark, sf_dir, "events"),
    }
    results = [infer(df).withColumn("table_name", F.lit(name)) for name, df in sources.items()]
    return results[0].unionByName(results[1]).unionByName(results[2])


@query(infer_sql(
    [("l_orderkey", _long_rank("l_orderkey")), ("l_partkey", _long_rank("l_partkey")), ("l_suppkey", _long_rank("l_suppkey")), ("l_linenumber", "7"),
     *((c, _double_rank(c)) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
     ("l_returnflag", _text_rank("l_returnflag")), ("l_linestatus", _text_rank("l_linestatus")), ("l_shipdate", "CASE WHEN l_shipdate IS NULL THEN 9 ELSE 3 END")],
    "lineitem", "lineitem",
))
def infer_from_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fair sample of two thousand rows gives the types of the whole table."""
    return infer(table(spark, sf_dir, "lineitem"), sample_rows=2000).withColumn("table_name", F.lit("lineitem"))


@query("SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 1000")
def sample_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thousand orders with the smallest hashes of their keys; the same whoever draws them."""
    orders = table(spark, sf_dir, "orders")
    by = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")
    return fair_sample(orders, 1000, by)


_STATE_NUMBERS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _state_sql() -> str:
    numbers = [
        f"SELECT 'number' AS kind, '{c}' AS column_name, '{name}' AS item, round(CAST({value} AS DOUBLE), 4) AS number, CAST(NULL AS BIGINT) AS n FROM lineitem"
        for c in _STATE_NUMBERS
        for name, value in (("min_value", f"min({c})"), ("max_value", f"max({c})"), ("avg_value", f"avg({c})"), ("stddev_value", f"stddev_samp({c})"), ("null_values", f"count(*) - count({c})"))
    ]
    deciles = [f"SELECT 'decile', '{c}', '{tenth}0th_percentile', NULL, 1" for c in _STATE_NUMBERS for tenth in range(1, 10)]
    values = [f"SELECT 'value', '{c}', {c}, NULL, count(*) FROM lineitem GROUP BY {c}" for c in ("l_returnflag", "l_linestatus")]
    days = [f"SELECT 'date', 'l_shipdate', '{name} ' || {name}(l_shipdate), NULL, count(*) FROM lineitem GROUP BY ALL" for name in ("year", "month", "day")]
    keys = ["SELECT 'records', '', NULL, NULL, count(*) FROM lineitem", "SELECT 'distinct', c, NULL, NULL, 1 FROM (VALUES (''), ('l_partkey'), ('l_suppkey')) AS t(c)"]
    return union_all([*numbers, *deciles, *values, *days, *keys])


@query(_state_sql())
def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three increments profiled apart, one of them twice, and the profile of the whole merged from what was stored.

    Deciles and distinct counts are compared with the exact ones, and count 1 if they are as near as stated.
    """
    lines, path, keys = table(spark, sf_dir, "lineitem"), scratch_path(spark, "states"), ["l_orderkey", "l_linenumber"]
    for part in (0, 1, 1, 2):
        profile_state.store_state(profile_state.state_of(lines.where(F.col("l_suppkey") % 3 == part), keys), path, f"part-{part}")
    state = profile_state.read_state(spark, path)
    found = profile_state.profile_of(state, "sales", "lineitem")

    def shaped(rows: DataFrame, kind: str, item, number=None, n=None) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("kind"), "column_name", (F.lit(None) if item is None else item).cast("string").alias("item"),
            (F.lit(None) if number is None else number).cast("double").alias("number"), (F.lit(None) if n is None else n).cast("bigint").alias("n"),
        )

    is_decile = F.col("variable").endswith("percentile")
    numbers = shaped(found.numeric.where(~is_decile), "number", F.col("variable"), F.round("value", 4))
    exact = numeric(lines, keys, "sales", "lineitem").where(is_decile).select("column_name", "variable", F.col("value").alias("true_value"))
    near = F.abs(F.col("value") - F.col("true_value")) <= profile_state.BIN_ERROR * 1.0001 * F.abs("true_value")
    deciles = shaped(found.numeric.join(exact, ["column_name", "variable"]), "decile", F.col("variable"), n=near.cast("int"))
    values = shaped(found.categorical, "value", F.col("column_value"), n=F.col("freq"))
    days = shaped(found.date.where("date_type <> 'boundary'"), "date", F.concat_ws(" ", "date_type", "column_value"), n=F.col("freq"))
    sizes = profile_state.key_counts(state)
    records = shaped(sizes.where("column_name = ''"), "records", None, n=F.col("records"))
    true_counts = lines.select(F.explode(F.array(
        F.struct(F.lit("").alias("column_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("value")),
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in ("l_partkey", "l_suppkey")],
    )).alias("e")).groupBy("e.column_name").agg(F.count_distinct("e.value").alias("true_count"))
    # four standard errors
    close = F.abs(F.col("distinct_values") - F.col("true_count")) <= 4 * 1.04 / 2 ** (profile_state.SKETCH_BITS / 2) * F.col("true_count") + 1
    distinct = shaped(sizes.join(true_counts, "column_name"), "distinct", None, n=close.cast("int"))
    parts = [numbers, deciles, values, days, records, distinct]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT max(ts) AS max_watermark FROM events")
def max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return highest(table(spark, sf_dir, "events"), "ts")


@query(f"""
  WITH dated AS (
    SELECT regexp_extract(path, '^(.*)/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/(\\d{{2}})/[^/]*(\\d{{4}}_\\d{{2}}_\\d{{2}}_\\d{{2}}_\\d{{2}})\\.parquet$', 1) AS object_dir,
           regexp_extract(path, '/(\\d{{4}}/\\d{{2}}/\\d{{2}}/\\d{{2}})/[^/]*\\.parquet$', 1) AS parts,
           regexp_extract(path, '(\\d{{4}}_\\d{{2}}_\\d{{2}}_\\d{{2}}_\\d{{2}})\\.parquet$', 1) AS stamp
    FROM ({LISTING}) WHERE path LIKE '%.parquet')
  SELECT object_dir, object_dir || '/' || max(parts) AS latest_dir,
         '*' || max_by(stamp, parts || stamp) || '.parquet' AS file_wildcard
  FROM dated GROUP BY object_dir
""")
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(listing(spark, sf_dir))


@query(f"""
  SELECT path AS FilePath, regexp_extract(path, '[^/]*$') AS FileName, size AS SizeBytes,
         CASE WHEN path LIKE '%.%' THEN regexp_extract(path, '[^.]*$') ELSE 'orc' END AS FileType
  FROM ({LISTING})
""")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files_of(listing(spark, sf_dir))


FOLDERS_SQL = """
  WITH files AS (SELECT DISTINCT path, regexp_replace(path, '[^/]*$', '') AS dir FROM ({listing})),
  chain AS (SELECT DISTINCT dir, string_split(dir, '/') AS p FROM files),
  folders AS (
    SELECT DISTINCT array_to_string(p[1:n], '/') || '/' AS folder,
           CASE WHEN n > 1 THEN array_to_string(p[1:n - 1], '/') || '/' END AS parent
    FROM (SELECT p, unnest(range(1, len(p))) AS n FROM chain))
  SELECT f.folder AS "Path",
         (SELECT count(*) FROM folders c WHERE c.parent = f.folder) AS FolderCount,
         (SELECT count(*) FROM files x WHERE x.dir = f.folder) AS FileCount
  FROM folders f
"""


@query(FOLDERS_SQL.format(listing=LISTING))
def folder_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders_of(listing(spark, sf_dir))


@query("""
  SELECT '/' AS "Path", (SELECT count(DISTINCT o_orderstatus) FROM orders) + 1 AS FolderCount, CAST(0 AS BIGINT) AS FileCount
  UNION ALL SELECT '/o_orderstatus=' || o_orderstatus || '/', count(DISTINCT o_orderkey // 1000), CAST(0 AS BIGINT) FROM orders GROUP BY o_orderstatus
  UNION ALL SELECT DISTINCT '/o_orderstatus=' || o_orderstatus || '/thousand=' || o_orderkey // 1000 || '/', CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM orders
  UNION ALL SELECT '/empty/', (SELECT count(DISTINCT s_name) FROM supplier), CAST(0 AS BIGINT)
  UNION ALL SELECT DISTINCT '/empty/' || s_name || '/', CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM supplier
""")
def folder_inventory_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real tree: a table partitioned on two levels, and an empty folder for each supplier."""
    path = scratch_path(spark, "tree")
    orders = table(spark, sf_dir, "orders").withColumn("thousand", F.floor(F.col("o_orderkey") / 1000))
    orders.repartition("o_orderstatus", "thousand").write.partitionBy("o_orderstatus", "thousand").parquet(path)
    make_folders(table(spark, sf_dir, "supplier").select(F.concat(F.lit(f"{path}/empty/"), "s_name").alias("folder")))
    files = relative_to(walk_files(spark, path, "part-*"), path)
    return folders_of(files, relative_to(walk_folders(spark, path), path))


MIXED_PATHS = """
  SELECT '/Raw/T' || o_custkey % 7 AS object_dir,
         CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '/%Y') WHEN 1 THEN strftime(o_orderdate, '/%Y/%m')
           WHEN 2 THEN strftime(o_orderdate, '/%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '/%Y/%m/%d/%H') ELSE '' END AS dated,
         strftime(o_orderdate, '%Y_%m_%d_%H_%M') AS stamp, o_orderkey % 3 = 0 AS csv
  FROM orders
"""


@query(f"""
  SELECT object_dir, object_dir || max_by(dated, stamp || dated) AS latest_dir, '*' || max(stamp) || '.csv' AS file_wildcard
  FROM ({MIXED_PATHS}) WHERE csv GROUP BY object_dir
""")
def latest_partition_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects whose files lie in folders of all granularities, in two formats."""
    day, patterns = F.col("o_orderdate"), ("/yyyy", "/yyyy/MM", "/yyyy/MM/dd", "/yyyy/MM/dd/HH")
    dated = F.lit("")
    for place, pattern in enumerate(patterns):
        dated = F.when(F.col("o_orderkey") % 5 == place, F.date_format(day, pattern)).otherwise(dated)
    paths = table(spark, sf_dir, "orders").select(F.concat(
        F.lit("/Raw/T"), (F.col("o_custkey") % 7).cast("string"), dated, F.lit("/S_T_"), F.date_format(day, "yyyy_MM_dd_HH_mm"),
        F.when(F.col("o_orderkey") % 3 == 0, ".csv").otherwise(".parquet"),
    ).alias("path"))
    return newest(paths, "csv")


@query(f"""
  WITH f AS (SELECT string_split(path, '/') AS p, size FROM ({LISTING}))
  SELECT "Path", CAST(sum(size) AS BIGINT) AS TotalBytes, count(*) AS FileCount
  FROM (SELECT array_to_string(p[1:n], '/') || '/' AS "Path", size
        FROM (SELECT p, size, unnest(range(1, len(p))) AS n FROM f))
  GROUP BY "Path"
""")
def dir_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up(listing(spark, sf_dir))


@query(f"""
  SELECT count(DISTINCT string_split(path, '/')[6]) AS table_count
  FROM ({LISTING}) WHERE path LIKE '/Published/NZ/Full/ERP/%'
""")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tables(exclude_results(listing(spark, sf_dir)), "/Published/NZ/Full/ERP/")


@query("""
  SELECT DISTINCT upper('edl_' || p_type) AS schema_name, p_name AS table_name, p_brand AS source_system,
         replace(p_name, ' ', '_') AS adlsg2_file_name
  FROM part
""")
def mapping_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = table(spark, sf_dir, "part").select(
        F.concat(F.lit("edl_"), "p_type").alias("schema_name"), F.col("p_name").alias("table_name"),
        F.col("p_brand").alias("source_system"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("adlsg2_file_name"),
    )
    return distinct_tables(described)


@query(f"""
  SELECT DISTINCT BatchGroupId FROM ({CONFIG}) WHERE FwkTriggerId = 2 AND ActiveFlag = 'Y' ORDER BY BatchGroupId
""")
def config_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_groups(parse_config(config_documents(spark, sf_dir)), 2)


@query(f"""
  WITH e AS ({ACID_EVENTS}),
  last AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY rowId ORDER BY currentTransaction DESC) = 1)
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM last WHERE operation <> 2
""")
def acid_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_rows(acid_events(spark, sf_dir))


CHECKED_AT = datetime(2024, 1, 2, 3, 4, 5)

VERDICT = """CASE WHEN t.rowcount = s.rowcount AND CAST(t.columncount AS INT) - 2 = CAST(s.columncount AS INT) THEN 'Both matched'
       WHEN t.rowcount <> s.rowcount AND CAST(t.columncount AS INT) - 2 = CAST(s.columncount AS INT) THEN 'Row count not match'
       WHEN t.rowcount = s.rowcount AND CAST(t.columncount AS INT) - 2 <> CAST(s.columncount AS INT) THEN 'Column count not match'
       ELSE 'Both not match' END"""


@query(f"""
  WITH t AS (SELECT 'ORDERS' AS tblnm, '8' AS columncount, count(*) AS rowcount FROM ({ORDERS_COPY})),
  s AS (SELECT 'ORDERS' AS tblnm, '6' AS columncount, count(*) AS rowcount FROM orders)
  SELECT t.tblnm, t.columncount, t.rowcount, s.tblnm AS tblnm_oracle, s.columncount AS columncount_oracle,
         s.rowcount AS rowcount_oracle, {VERDICT} AS "ComparisonResult", 'both' AS _merge,
         TIMESTAMP '2024-01-02 03:04:05' AS "ComparedAt"
  FROM t LEFT JOIN s ON t.tblnm = s.tblnm
""")
def rowcount_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = counts.row_column_count({"ORDERS": orders_copy(spark, sf_dir)})
    source = counts.row_column_count({"SALES.ORDERS": table(spark, sf_dir, "orders")})
    checked_at = F.lit(CHECKED_AT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return counts.compare_counts(target, source, "oracle", checked_at=checked_at)


@query("""
  SELECT column_name, column_value, freq FROM (
    SELECT 'event_type' AS column_name, CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE event_type END
           AS column_value, count(*) AS freq FROM events GROUP BY ALL
    UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY props)
""")
def profile_categorical_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = categorical(blanked_events(spark, sf_dir), "event_id", "web", "events")
    return found.select("column_name", "column_value", "freq")
