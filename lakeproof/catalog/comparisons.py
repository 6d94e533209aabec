"""Joins of metric tables and the differences between the two sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.catalog.aggregates import FOLDERS_SQL, VERDICT, rounded_sql
from lakeproof.catalog.registry import query
from lakeproof.catalog.sqltext import (
    categorical_sql, date_sql, differences_sql, joined_sql, numeric_sql, primary_key_sql, union_all,
)
from lakeproof.catalog.tables import (
    BLANKED_EVENTS, LINEITEM_COPY, LISTING, ORDERS_COPY, blanked_events, lineitem_copy, listing, orders_copy, table,
)
from lakeproof.operators import compare
from lakeproof.operators.cleaning import blank_to_null_text
from lakeproof.operators.counts import check_primary_key, compare_counts, row_column_count
from lakeproof.operators.differences import differences
from lakeproof.operators.inventory import file_inventory, folder_inventory
from lakeproof.operators.profile import profile_categorical, profile_date, profile_numeric
from lakeproof.plans.reconcile import reconcile_stored, store_metrics, table_metrics
from lakeproof.session import scratch_path

COUNTS_SIDE = """
  WITH t AS (SELECT 'orders' AS tblnm, '8' AS columncount, count(*) AS rowcount FROM ({copy})
             UNION ALL SELECT 'lineitem', '11', count(*) FROM lineitem
             UNION ALL SELECT 'events', '8', count(*) FROM events),
  s AS (SELECT 'orders' AS tblnm, '6' AS columncount, count(*) AS rowcount FROM orders
        UNION ALL SELECT 'lineitem', '11', count(*) FROM lineitem
        UNION ALL SELECT 'events', '6', count(*) FROM events
        UNION ALL SELECT 'part', '6', count(*) FROM part)
""".format(copy=ORDERS_COPY)


def _counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events, lineitem = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    audited = events.withColumns({"LastUpdate": F.lit("now"), "CreatedBy": F.lit("run")})
    target = row_column_count({"orders": orders_copy(spark, sf_dir), "lineitem": lineitem, "events": audited})
    source = row_column_count({
        "sales.orders": table(spark, sf_dir, "orders"), "sales.lineitem": lineitem,
        "web.events": events, "sales.part": table(spark, sf_dir, "part"),
    })
    return target, source


def _counts_sql(how: str, side: str) -> str:
    return f"""{COUNTS_SIDE}
  SELECT t.tblnm, t.columncount, t.rowcount, s.tblnm AS tblnm_{side}, s.columncount AS columncount_{side},
         s.rowcount AS rowcount_{side}, {VERDICT} AS "ComparisonResult",
         CASE WHEN t.tblnm IS NULL THEN 'right_only' WHEN s.tblnm IS NULL THEN 'left_only' ELSE 'both' END AS _merge
  FROM t {how} JOIN s ON t.tblnm = s.tblnm"""


@query(_counts_sql("LEFT", "oracle"))
def rowcount_compare_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_counts(*_counts(spark, sf_dir), side="oracle")


@query(_counts_sql("RIGHT", "ftp"))
def rowcount_compare_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_counts(*_counts(spark, sf_dir), side="ftp", how="right")


@query(joined_sql(
    primary_key_sql("orders", ["o_orderkey"], 6, "hive", "orders"),
    primary_key_sql(f"({ORDERS_COPY})", ["o_orderkey"], 8, "lake", "orders"),
    compare.METADATA_KEYS, ["schema_name", "column_value", "freq"], differences_sql("freq"),
))
def compare_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_metadata(
        check_primary_key(table(spark, sf_dir, "orders"), "o_orderkey", "hive", "orders"),
        check_primary_key(orders_copy(spark, sf_dir), "o_orderkey", "lake", "orders"),
    )


NUMBERS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEY = ["l_orderkey", "l_linenumber"]


def _rounded_numeric(relation: str, schema: str) -> str:
    return rounded_sql(numeric_sql(relation, NUMBERS, schema, "lineitem"))


@query(joined_sql(
    _rounded_numeric("lineitem", "hive"), _rounded_numeric(f"({LINEITEM_COPY})", "lake"),
    compare.NUMERIC_KEYS, ["schema_name", "value"], differences_sql("value"),
))
def compare_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_numeric(
        profile_numeric(table(spark, sf_dir, "lineitem"), LINE_KEY, "hive", "lineitem"),
        profile_numeric(lineitem_copy(spark, sf_dir), LINE_KEY, "lake", "lineitem"),
    ).drop("exact", "exact_tgt")


def _last_digit_sql(column: str, ends: str, expression: str, drift: str) -> str:
    return union_all([
        f"SELECT '{column}' AS column_name, '{end}_value' AS variable, CAST({end}({expression}) AS VARCHAR) AS exact, "
        f"CAST({end}({expression} + {drift}) AS VARCHAR) AS exact_tgt, CAST(-{drift} AS DOUBLE) AS value_diff FROM orders"
        for end in ends.split()
    ])


@query(union_all([
    _last_digit_sql("big", "min max", "CAST(o_custkey AS BIGINT) + 9007199254740992", "1"),
    _last_digit_sql("amount", "min max", "CAST(o_custkey AS DECIMAL(38,18))", "CAST(0.000000000000000001 AS DECIMAL(38,18))"),
]))
def compare_numeric_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers above 2^53 and long decimals that differ in their last digit only."""
    orders = table(spark, sf_dir, "orders")
    big, amount = F.col("o_custkey").cast("bigint") + 9007199254740992, F.col("o_custkey").cast("decimal(38,18)")
    sides = [
        orders.select("o_orderkey", (big + drift).alias("big"), (amount.cast("decimal(28,18)") + F.lit(f"{drift}E-18").cast("decimal(18,18)")).cast("decimal(38,18)").alias("amount"))
        for drift in (0, 1)
    ]
    compared = compare.compare_numeric(*(profile_numeric(df, "o_orderkey", "sales", "orders") for df in sides))
    return compared.where(F.col("variable").isin("min_value", "max_value")).select(
        "column_name", "variable", "exact", "exact_tgt", "value_diff"
    )


ORDERS_TEXT = ["o_orderstatus", "o_orderpriority"]
COPY_TEXT = [*ORDERS_TEXT, "LastUpdate", "CreatedBy"]


def _categorical(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        profile_categorical(table(spark, sf_dir, "orders"), "o_orderkey", "hive", "orders"),
        profile_categorical(orders_copy(spark, sf_dir), "o_orderkey", "lake", "orders"),
    )


@query(joined_sql(
    categorical_sql("orders", ORDERS_TEXT, "hive", "orders"),
    categorical_sql(f"({ORDERS_COPY})", COPY_TEXT, "lake", "orders"),
    compare.CATEGORICAL_KEYS, ["schema_name", "freq"], differences_sql("freq"),
))
def compare_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_categorical(*_categorical(spark, sf_dir))


@query(joined_sql(
    categorical_sql("events", ["event_type", "props"], "hive", "events"),
    categorical_sql(f"({BLANKED_EVENTS})", ["event_type", "props"], "lake", "events"),
    compare.CATEGORICAL_KEYS, ["schema_name", "freq"], differences_sql("freq"),
))
def reconcile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.reconcile_categorical(
        table(spark, sf_dir, "events"), blanked_events(spark, sf_dir), "event_id", "hive", "events", "lake"
    )


CLEANED_EVENTS = f"""
  (SELECT * REPLACE (CASE WHEN event_type = '' THEN 'null' ELSE event_type END AS event_type) FROM ({BLANKED_EVENTS}))
"""


@query(union_all([
    "SELECT 'categorical' AS kind, column_name, column_value AS item, _merge, value_diff, percent_diff FROM (" + joined_sql(
        categorical_sql("events", ["event_type", "props"], "hive", "events"),
        categorical_sql(CLEANED_EVENTS, ["event_type", "props"], "lake", "events"),
        compare.CATEGORICAL_KEYS, ["freq"], differences_sql("freq"),
    ) + ")",
    "SELECT 'numeric', column_name, variable, _merge, value_diff, percent_diff FROM (" + joined_sql(
        rounded_sql(numeric_sql("events", ["user_id", "value"], "hive", "events")),
        rounded_sql(numeric_sql(CLEANED_EVENTS, ["user_id", "value"], "lake", "events")),
        compare.NUMERIC_KEYS, ["value"], differences_sql("value"),
    ) + ")",
    "SELECT 'metadata', '', measure, _merge, value_diff, percent_diff FROM (" + joined_sql(
        primary_key_sql("events", ["event_id"], 6, "hive", "events"),
        primary_key_sql(CLEANED_EVENTS, ["event_id"], 6, "lake", "events"),
        compare.METADATA_KEYS, ["freq"], differences_sql("freq"),
    ) + ")",
    "SELECT 'date', column_name, date_type || ' ' || column_value, _merge, CASE WHEN same THEN 0.0 ELSE 1.0 END, CAST(NULL AS DOUBLE) FROM (" + joined_sql(
        date_sql("events", ["ts"], "hive", "events"), date_sql(CLEANED_EVENTS, ["ts"], "lake", "events"),
        compare.DATE_KEYS, ["freq"], "s.freq IS NOT DISTINCT FROM t.freq AS same",
    ) + ")",
]))
def compare_stored_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source side delivers metric files, the target side compares its table with them."""
    path = scratch_path(spark, "delivered")
    store_metrics(table_metrics(table(spark, sf_dir, "events"), "event_id", "hive", "events"), path, "Hive", "events")
    found = reconcile_stored(spark, path, "Hive", blanked_events(spark, sf_dir), "event_id", "lake", "events")
    shown = ["_merge", "value_diff", "percent_diff"]
    return found.categorical.select(
        F.lit("categorical").alias("kind"), "column_name", F.col("column_value").alias("item"), *shown
    ).unionByName(found.numeric.select(
        F.lit("numeric").alias("kind"), "column_name", F.col("variable").alias("item"), *shown
    )).unionByName(found.metadata.select(
        F.lit("metadata").alias("kind"), F.lit("").alias("column_name"), F.col("measure").alias("item"), *shown
    )).unionByName(found.date.select(
        F.lit("date").alias("kind"), "column_name", F.concat_ws(" ", "date_type", "column_value").alias("item"), "_merge",
        F.when(F.col("value_diff"), 0.0).otherwise(1.0).alias("value_diff"), F.lit(None).cast("double").alias("percent_diff"),
    ))


@query(joined_sql(
    date_sql("orders", ["o_orderdate"], "hive", "orders"),
    date_sql(f"({ORDERS_COPY})", ["o_orderdate"], "lake", "orders"),
    compare.DATE_KEYS, ["schema_name", "freq"], "s.freq IS NOT DISTINCT FROM t.freq AS value_diff",
))
def compare_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_date(
        profile_date(table(spark, sf_dir, "orders"), "o_orderkey", "hive", "orders"),
        profile_date(orders_copy(spark, sf_dir), "o_orderkey", "lake", "orders"),
    )


@query(joined_sql(
    categorical_sql("orders", ORDERS_TEXT, "sales", "orders"),
    categorical_sql(f"({ORDERS_COPY})", COPY_TEXT, "sales", "orders"),
    ["schema_name", *compare.CATEGORICAL_KEYS], ["freq"], differences_sql("freq"), "LEFT",
))
def compare_left_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_categorical(
        profile_categorical(table(spark, sf_dir, "orders"), "o_orderkey", "sales", "orders"),
        profile_categorical(orders_copy(spark, sf_dir), "o_orderkey", "sales", "orders"),
        keys=["schema_name", *compare.CATEGORICAL_KEYS], how="left",
    )


@query(
    "SELECT * FROM (" + joined_sql(
        categorical_sql("events", ["event_type", "props"], "hive", "events"),
        categorical_sql(
            f"(SELECT * REPLACE (CASE WHEN event_type = '' THEN 'null' ELSE event_type END AS event_type) "
            f"FROM ({BLANKED_EVENTS}))", ["event_type", "props"], "lake", "events",
        ),
        compare.CATEGORICAL_KEYS, ["schema_name", "freq"], differences_sql("freq"),
    ) + ") WHERE column_value = 'null'"
)
def compare_null_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = blank_to_null_text(table(spark, sf_dir, "events"))
    target = blank_to_null_text(blanked_events(spark, sf_dir))
    return compare.null_slice(compare.compare_categorical(
        profile_categorical(source, "event_id", "hive", "events"),
        profile_categorical(target, "event_id", "lake", "events"),
    ))


@query("""
  WITH s AS (SELECT o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY ALL),
  t AS (SELECT o_orderpriority, sum(o_totalprice) AS v FROM ({copy}) GROUP BY ALL)
  SELECT s.o_orderpriority, round(s.v / NULLIF(t.v, 0) * 100, 4) AS ratio_percent
  FROM s LEFT JOIN t ON s.o_orderpriority = t.o_orderpriority
""".format(copy=ORDERS_COPY))
def ratio_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [
        df.groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("total"))
        for df in (table(spark, sf_dir, "orders"), orders_copy(spark, sf_dir))
    ]
    joined = compare.join_sides(*totals, ["o_orderpriority"], "left")
    ratio = compare.ratio_percent(F.col("total"), F.col("total_tgt"))
    return joined.select("o_orderpriority", F.round(ratio, 4).alias("ratio_percent"))


# The target listing lost the archives and its large files shrank.
TARGET_LISTING = f"""
  SELECT path, CASE WHEN size > 20000000 THEN size - 1000 ELSE size END AS size, modified
  FROM ({LISTING}) WHERE path NOT LIKE '%.zip'
"""


def target_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("size")
    kept = listing(spark, sf_dir).where(~F.endswith("path", F.lit(".zip")))
    return kept.withColumn("size", F.when(size > 20000000, size - 1000).otherwise(size))


def _inventory_sql(relation: str) -> str:
    return (
        "SELECT path AS FilePath, regexp_extract(path, '[^/]*$') AS FileName, size AS SizeBytes, "
        "CASE WHEN path LIKE '%.%' THEN regexp_extract(path, '[^.]*$') ELSE 'orc' END AS FileType "
        f"FROM ({relation})"
    )


@query(joined_sql(
    _inventory_sql(LISTING), _inventory_sql(TARGET_LISTING), ["FilePath"], ["FileName", "SizeBytes", "FileType"],
    differences_sql("SizeBytes", "FileSize"),
))
def file_size_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_file_sizes(
        file_inventory(listing(spark, sf_dir)), file_inventory(target_listing(spark, sf_dir))
    )


@query(joined_sql(
    FOLDERS_SQL.format(listing=LISTING), FOLDERS_SQL.format(listing=TARGET_LISTING), ['"Path"'],
    ["FolderCount", "FileCount"],
    differences_sql("FolderCount", "FolderCount") + ", " + differences_sql("FileCount", "FileCount"),
))
def folder_count_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_folder_counts(
        folder_inventory(listing(spark, sf_dir)), folder_inventory(target_listing(spark, sf_dir))
    )




# --- a copy in which clusters of keys lost rows, changed them or got more

_LINE_VALUES = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
DAMAGED_LINES = f"""
  SELECT * REPLACE (l_extendedprice + CASE WHEN l_orderkey % 5000 BETWEEN 100 AND 109 THEN 1.0 ELSE 0.0 END AS l_extendedprice,
    CASE WHEN l_orderkey % 5000 <> 105 THEN l_returnflag END AS l_returnflag)
  FROM lineitem WHERE l_orderkey % 5000 >= 20
  UNION ALL SELECT * REPLACE (l_linenumber + 100 AS l_linenumber) FROM lineitem WHERE l_orderkey % 5000 BETWEEN 200 AND 204
"""


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, place = table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 5000
    kept = lines.where(place >= 20).withColumns({
        "l_extendedprice": F.col("l_extendedprice") + F.when(place.between(100, 109), 1.0).otherwise(0.0),
        "l_returnflag": F.when(place != 105, F.col("l_returnflag")),
    })
    return kept.unionByName(lines.where(place.between(200, 204)).withColumn("l_linenumber", F.col("l_linenumber") + 100))


def _rows_by_key(rows: str) -> str:
    values = "{" + ", ".join(f"'{c}': {c}" for c in _LINE_VALUES) + "}"
    return f"""SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(CAST(v AS VARCHAR))) AS all_rows, any_value(v) AS v
      FROM (SELECT l_orderkey, l_linenumber, {values} AS v FROM ({rows})) GROUP BY ALL"""


@query(f"""
  WITH s AS ({_rows_by_key("FROM lineitem")}), t AS ({_rows_by_key(DAMAGED_LINES)})
  SELECT l_orderkey, l_linenumber, CASE WHEN s.n IS NULL THEN 'added' WHEN t.n IS NULL THEN 'lost' ELSE 'changed' END AS state,
    coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
    CASE WHEN s.n = 1 AND t.n = 1 THEN concat_ws(',', {", ".join(f"CASE WHEN s.v.{c} IS DISTINCT FROM t.v.{c} THEN '{c}' END" for c in _LINE_VALUES)}) END AS changed_columns
  FROM s FULL JOIN t USING (l_orderkey, l_linenumber) WHERE s.all_rows IS DISTINCT FROM t.all_rows
""")
def copy_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a copy lost, changed or got, found by hashes of key ranges."""
    return differences(table(spark, sf_dir, "lineitem"), damaged_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], few_rows=5000)
