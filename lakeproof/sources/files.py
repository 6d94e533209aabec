"""Delimited text, Parquet, ORC, JSON and XML files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions import naming
from lakeproof.sources.drift import read_drifted

_MALFORMED = "_malformed_row"
_NEVER_TEXT = "\0"


@dataclass(frozen=True)
class CsvDialect:
    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    header: bool = True
    line_sep: str | None = None
    quote_all: bool = False

    def options(self) -> dict[str, str]:
        chosen = {
            "sep": self.sep, "quote": self.quote, "escape": self.escape, "header": str(self.header).lower(),
        }
        if self.line_sep is not None:
            chosen["lineSep"] = self.line_sep
        return chosen


CSV = CsvDialect()
TSV = CsvDialect(sep="\t")
SLASH_ESCAPED = CsvDialect(escape="/")
DOUBLED_QUOTE = CsvDialect(escape='"')
PIPE = CsvDialect(sep="|")


@dataclass(frozen=True)
class FileSelection:
    """Which files below a path to read. ``recursive`` also turns partition discovery off."""

    recursive: bool = False
    name_glob: str | None = None
    modified_from: str | None = None
    modified_before: str | None = None
    skip_corrupt: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        chosen = dict(self.extra)
        if self.recursive:
            chosen["recursiveFileLookup"] = "true"
        if self.name_glob:
            chosen["pathGlobFilter"] = self.name_glob
        if self.modified_from:
            chosen["modifiedAfter"] = self.modified_from
        if self.modified_before:
            chosen["modifiedBefore"] = self.modified_before
        if self.skip_corrupt:
            chosen["ignoreCorruptFiles"] = "true"
        return chosen


ALL_FILES = FileSelection()


def _reader(spark: SparkSession, selection: FileSelection, schema: T.StructType | str | None) -> DataFrameReader:
    reader = spark.read.options(**selection.options())
    return reader if schema is None else reader.schema(schema)


def read_csv(
    spark: SparkSession, path: str | list[str], dialect: CsvDialect = CSV,
    schema: T.StructType | str | None = None, selection: FileSelection = ALL_FILES,
    multiline: bool = False, drop_malformed: bool = False, keep_empty: bool = False,
) -> DataFrame:
    """Delimited text; all columns are text unless a schema is given.

    ``multiline`` allows line breaks inside quotes but makes every file one
    task, so leave it off for large files. ``drop_malformed`` leaves out rows
    with a wrong number of fields or a value that does not fit. ``keep_empty``
    reads quoted empty text as empty; otherwise it is missing, like a field
    with nothing in it.
    """
    if drop_malformed and schema is None:
        raise ValueError("only a schema tells which rows are malformed")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if drop_malformed:
        declared = T.StructType([*declared, T.StructField(_MALFORMED, T.StringType())])
    reader = _reader(spark, selection, declared).options(**dialect.options()).option("multiLine", multiline)
    if keep_empty:
        reader = reader.option("nullValue", _NEVER_TEXT)
    if not drop_malformed:
        return reader.csv(path)
    rows = reader.option("columnNameOfCorruptRecord", _MALFORMED).csv(path)
    # Spark judges a row by the columns a query reads, so this reads all of them in every query
    names = [f.name for f in declared if f.name != _MALFORMED]
    all_read = F.size(F.array(*[naming.field(n).isNull() for n in names])) == len(names)
    return rows.where(F.col(_MALFORMED).isNull() & all_read).drop(_MALFORMED)


def read_parquet(
    spark: SparkSession, path: str, selection: FileSelection = ALL_FILES, schema: T.StructType | str | None = None
) -> DataFrame:
    return _reader(spark, selection, schema).parquet(path)


def read_orc(
    spark: SparkSession, path: str | list[str], selection: FileSelection = ALL_FILES, schema: T.StructType | str | None = None
) -> DataFrame:
    return _reader(spark, selection, schema).orc(path)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    selection: FileSelection = ALL_FILES, array_of_documents: bool = True,
) -> DataFrame:
    """Files that hold one JSON array each, or one document per line.

    A file with an array is one task; line files are split. Give a schema to
    spare the pass that infers it.
    """
    return _reader(spark, selection, schema).option("multiLine", array_of_documents).json(path)


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None,
    selection: FileSelection = ALL_FILES,
) -> DataFrame:
    """XML records, without validation; namespace prefixes stay in the names."""
    reader = _reader(spark, selection, schema).option("rowTag", row_tag).option("ignoreNamespace", False)
    return reader.format("xml").load(path)


def read_files(
    spark: SparkSession, path: str, file_format: str, selection: FileSelection = ALL_FILES,
    schema: T.StructType | str | None = None, **options: str,
) -> DataFrame:
    """Dispatch on a control-table format name."""
    if file_format == "csv":
        return read_csv(spark, path, schema=schema, selection=selection)
    if file_format in {"tsv", "txt"}:
        return read_csv(spark, path, TSV, schema, selection)
    if file_format == "parquet":
        return read_parquet(spark, path, selection, schema)
    if file_format == "parquet-drift":
        return read_drifted(spark, path)
    if file_format == "orc":
        return read_orc(spark, path, selection, schema)
    if file_format == "orc-acid":
        return read_orc(spark, path, FileSelection(**{**selection.__dict__, "recursive": True}), schema)
    if file_format == "json":
        return read_json(spark, path, schema, selection)
    if file_format == "xml":
        return read_xml(spark, path, options["row_tag"], schema, selection)
    raise ValueError(f"unknown file format: {file_format!r}")
