"""Write Parquet, metric files and merged text files; convert formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lakeproof.operators.cleaning import void_to_string
from lakeproof.sources.files import ALL_FILES, CSV, PIPE, CsvDialect, FileSelection, read_csv, read_files, read_orc

METRIC_ROWS_PER_FILE = 1_000_000


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> None:
    writer = void_to_string(df).write.mode(mode).option("compression", "snappy")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(
    df: DataFrame, path: str, dialect: CsvDialect = CSV, mode: str = "overwrite", rows_per_file: int | None = None
) -> None:
    """Text as it is: blanks at the ends of values stay, and empty text is told from missing."""
    writer = df.write.mode(mode).options(**dialect.options()).option("quoteAll", dialect.quote_all)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Pipe-separated with a header. The number of files follows the size of the
    metrics: adaptive execution merges small partitions, and a frequency table
    with billions of values is spread over many files."""
    write_csv(df, path, PIPE, rows_per_file=METRIC_ROWS_PER_FILE)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read metric files back with a fixed schema.

    Unquoted empty text means missing. Values may hold line breaks, so a file
    is read by one task; ``write_metrics`` keeps files small for that.
    """
    return read_csv(spark, path, PIPE, schema, multiline=True, keep_empty=True)


def write_single_csv(df: DataFrame, path: str, dialect: CsvDialect = CSV) -> None:
    """One CSV file, as its reader wants it. The rows are computed in parallel, and one task streams them out."""
    write_csv(df.repartition(1), path, dialect)


def convert_to_parquet(
    spark: SparkSession, source: str, file_format: str, target: str,
    selection: FileSelection = ALL_FILES, schema: str | None = None, **options: str,
) -> None:
    write_parquet(read_files(spark, source, file_format, selection, schema, **options), target)


def convert_orc_tables(spark: SparkSession, tables: Mapping[str, str], at_once: int = 4) -> None:
    """ORC folder to Parquet folder, for every (source, target) pair; old output is replaced.

    A few tables are converted at the same time, so that small ones do not leave the cluster idle.
    """
    with ThreadPoolExecutor(at_once) as pool:
        jobs = [pool.submit(lambda s, t: write_parquet(read_orc(spark, s), t), *pair) for pair in tables.items()]
        for job in jobs:
            job.result()


def merge_text_files(
    spark: SparkSession, sources: list[str], target: str, dialect: CsvDialect = CSV,
    out_dialect: CsvDialect | None = None, files: int = 1, multiline: bool = False,
) -> None:
    """Merge deliveries of one shape into ``files`` files, all with the header.

    The number of files is what the caller says: one, as a receiver of a merged
    file expects, is written by one task however large the input is; give more
    for a large input. Each source is read by its own header and columns are
    matched by name. Sources with other columns than the first are an error.
    Without a header columns are matched by place.
    """
    read = [read_csv(spark, path, dialect, multiline=multiline) for path in sources]
    for path, df in zip(sources, read):
        if sorted(df.columns) != sorted(read[0].columns):
            raise ValueError(f"{path} has the columns {df.columns}, not {read[0].columns}")
    merged = reduce(DataFrame.unionByName, read).repartition(files)
    write_csv(merged, target, out_dialect or CsvDialect(dialect.sep, dialect.quote, dialect.escape, quote_all=True))
