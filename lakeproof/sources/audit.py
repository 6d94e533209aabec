"""Which files of a folder were read, and which were not or only in part."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field
from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.files import FileSelection, read_parquet
from lakeproof.sources.listing import walk_files
from lakeproof.sources.remote import resolve

FILES_PER_TASK = 200
READ, EMPTY, PARTLY, UNREADABLE = "read", "empty", "partly read", "unreadable"
_SCHEME = r"^[A-Za-z0-9+.-]+:(//[^/]*)?"


class FilesSkipped(RuntimeError):
    """More files than allowed were not read, or only in part."""


def _below(path: Column, root: str) -> Column:
    """A file's path below a root, however the address of either is written."""
    whole = F.regexp_replace(path, _SCHEME, "")
    return F.substring(whole, F.lit(len(re.sub(_SCHEME, "", root.rstrip("/"))) + 1), F.length(whole))


def footer_rows(files: DataFrame) -> DataFrame:
    """(path, rows_stored) of the Parquet files in a listing, from their footers; null where there is none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch["path"].to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(map(_rows_of, paths), pa.int64())], ["path", "rows_stored"])

    return dealt_out(files.select("path"), ["path"], F.lit(1), FILES_PER_TASK).mapInArrow(read, "path string, rows_stored bigint")


def _rows_of(address: str) -> int | None:
    filesystem, path = resolve(address)
    try:
        with filesystem.open_input_file(path) as stream:
            return pq.ParquetFile(stream).metadata.num_rows
    except (pa.ArrowException, OSError):
        return None


def audit_files(spark: SparkSession, path: str, schema: T.StructType | str, name_glob: str = "*") -> DataFrame:
    """(file, size, state, rows_read, rows_stored) of every file below a folder that a read which skips corrupt files meets.

    All columns of all rows are decoded, and rows are counted per file: a file that breaks off in
    the middle gives its first rows and no error, which only its footer's count shows. Hidden files
    (``_...``, ``.``...) are none of the table's.
    """
    files = walk_files(spark, path, name_glob).where(~F.substring_index("path", "/", -1).rlike(r"^[_.]"))
    rows = read_parquet(spark, path, FileSelection(recursive=True, name_glob=name_glob, skip_corrupt=True), schema)
    decoded = F.xxhash64(*[field(c) for c in rows.columns])
    # the address that Spark reports is encoded, but for a plus sign
    address = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    # the remainder is always 0, but a count that doesn't need the values would not have them read
    counted = rows.select(F.col("_metadata.file_path").alias("file_path"), decoded.alias("h")).groupBy("file_path").agg(
        (F.count("*") + F.max(F.col("h") % 1)).alias("rows_read")
    )
    read = counted.select(_below(address, path).alias("file"), "rows_read")
    stored = footer_rows(files).select(_below(F.col("path"), path).alias("file"), "rows_stored")
    listed = files.select(_below(F.col("path"), path).alias("file"), "size")
    found = listed.join(stored, "file", "left").join(read, "file", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0).cast("bigint")))
    state = (
        F.when(F.col("rows_stored").isNull(), UNREADABLE).when(F.col("rows_read") < F.col("rows_stored"), F.when(F.col("rows_read") == 0, UNREADABLE).otherwise(PARTLY))
        .when(F.col("rows_stored") == 0, EMPTY).otherwise(READ)
    )
    return found.select("file", "size", state.alias("state"), "rows_read", "rows_stored")


def require_read(audit: DataFrame, most_skipped: int = 0, named: int = 10) -> int:
    """The number of files that were not read whole; an error that names some of them if they are more than allowed."""
    bad = audit.where(F.col("state").isin(UNREADABLE, PARTLY))
    count = bad.count()
    if count > most_skipped:
        some = ", ".join(f"{r['file']} ({r['state']})" for r in bad.orderBy("file").limit(named).collect())
        raise FilesSkipped(f"{count} files were not read, {most_skipped} allowed: {some}")
    return count
