"""Parquet files whose columns and types have drifted, read as one table.

The schemas are in the files' footers, which tasks read. Columns of one name get the least type
that holds every file's values, by a stated order of widening, and then the files are read with that
schema: all at once where the Parquet reader widens by itself, and the files of each odd schema apart
where a column has to be converted. Columns that a file lacks are null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from lakeproof.functions.naming import field
from lakeproof.session import scratch_path
from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.listing import walk_files
from lakeproof.sources.remote import resolve

FOOTERS_PER_TASK = 200
FOOTER_SCHEMA = "path string, fields array<struct<name: string, type: string>>"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_WHOLE = tuple(_DIGITS)


class SchemaConflict(ValueError):
    """Two files hold one column in types that only text has in common."""


def common_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both; None if there is none.

    Whole numbers widen to the larger one, with a decimal to a decimal that has room for both, up to
    38 digits and to double beyond, with a float or double to double. Decimals take the most digits
    before and after the point. A date becomes the other's timestamp, a local timestamp one with
    a zone. Structs, arrays and maps widen inside. Nothing but null goes with anything.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = (type(one), type(other))
    if all(k in _DIGITS for k in kinds):
        return max(one, other, key=lambda t: _DIGITS[type(t)])
    if all(k in _DIGITS or k is T.DecimalType for k in kinds):
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (one, other)]
        before, after = (max(s[k] for s in sizes) for k in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    numeric = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
    if all(k in numeric for k in kinds):
        return T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if all(k in times for k in kinds):
        return times[max(times.index(k) for k in kinds)]()
    if kinds == (T.ArrayType, T.ArrayType):
        inner = common_type(one.elementType, other.elementType)
        return inner and T.ArrayType(inner)
    if kinds == (T.MapType, T.MapType):
        key, value = common_type(one.keyType, other.keyType), common_type(one.valueType, other.valueType)
        return key and value and T.MapType(key, value)
    if kinds == (T.StructType, T.StructType):
        fields: dict[str, tuple[str, T.DataType | None]] = {}
        for f in (*one, *other):
            name, known = fields.get(f.name.lower(), (f.name, T.NullType()))
            fields[f.name.lower()] = (name, known and common_type(known, f.dataType))
        return T.StructType([T.StructField(n, t) for n, t in fields.values()]) if all(t for _, t in fields.values()) else None
    return None


def reader_widens(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether Spark's Parquet reader turns a column of one type into the other, value for value."""
    if stored == wanted:
        return True
    if isinstance(wanted, T.DecimalType):
        if isinstance(stored, T.DecimalType):
            return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
        return type(stored) in _DIGITS and wanted.precision - wanted.scale >= max(10, _DIGITS[type(stored)])
    if type(stored) in _DIGITS and type(wanted) in _DIGITS:
        return _DIGITS[type(wanted)] >= _DIGITS[type(stored)]
    if isinstance(wanted, T.DoubleType):
        return isinstance(stored, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType))
    return isinstance(stored, T.DateType) and isinstance(wanted, T.TimestampNTZType)


def footer_schemas(spark: SparkSession, path: str, name_glob: str = "*.parquet") -> DataFrame:
    """(path, fields) of every Parquet file below a folder: its columns and their Spark types, as JSON. Only footers are read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
        for batch in batches:
            paths = batch["path"].to_pylist()
            fields = [[{"name": f.name, "type": f.dataType.json()} for f in _schema_of(p)] for p in paths]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(fields, kind)], ["path", "fields"])

    return dealt_out(walk_files(spark, path, name_glob).select("path"), ["path"], F.lit(1), FOOTERS_PER_TASK).mapInArrow(read, FOOTER_SCHEMA)


def _schema_of(address: str) -> T.StructType:
    filesystem, path = resolve(address)
    with filesystem.open_input_file(path) as stream:
        file = pq.ParquetFile(stream)
        noted = (file.metadata.metadata or {}).get(_SPARK_SCHEMA)
        if noted:
            return T.StructType.fromJson(json.loads(noted))
        old = {c.name for c in (file.schema.column(k) for k in range(len(file.schema))) if c.physical_type == "INT96"}
        return T.StructType([
            T.StructField(f.name, T.TimestampType() if f.name in old else _spark_type(f.type)) for f in file.schema_arrow
        ])


def _spark_type(arrow: pa.DataType) -> T.DataType:
    if pa.types.is_unsigned_integer(arrow):  # one size up, as Spark reads them
        return {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType()}.get(arrow.bit_width, T.DecimalType(20, 0))
    return from_arrow_type(arrow, prefer_timestamp_ntz=True)


def unified_schema(schemas: Mapping[str, list[T.DataType]], strict: bool = False) -> T.StructType:
    """One type for each column of those it has in some files. Text where they have nothing in common, or an error if ``strict``."""
    found = []
    for name, kinds in schemas.items():
        kind = reduce(lambda a, b: a and common_type(a, b), kinds)
        if kind is None and strict:
            raise SchemaConflict(f"column {name!r} is {', '.join(sorted({k.simpleString() for k in kinds}))}")
        found.append(T.StructField(name, T.StringType() if kind is None or isinstance(kind, T.NullType) else kind))
    return T.StructType(found)


def read_drifted(spark: SparkSession, path: str, strict: bool = False, name_glob: str = "*.parquet") -> DataFrame:
    """All Parquet files below a folder as one table, whatever types their columns have.

    Columns are those of all files, in the order of their first file by path, names compared without case. Types:
    see ``common_type``; what has only text in common is text, or an error if ``strict``. Without files
    there is nothing to read, which is an error.

    One row per different schema reaches the driver, and where the reader can't widen a column by
    itself the paths of the files, which Spark lists there anyhow.
    """
    footers = footer_schemas(spark, path, name_glob).select("path", F.transform("fields", lambda f: F.struct(F.lower(f["name"]).alias("key"), f["name"].alias("name"), f["type"].alias("type"))).alias("fields"))
    footers = _written(footers)
    rows = footers.groupBy("fields").agg(F.min("path").alias("first")).orderBy("first").collect()
    if not rows:
        raise FileNotFoundError(f"{path} holds no {name_glob}")
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    schemas = [{f["key"]: _type_of(f["type"]) for f in row["fields"]} for row in rows]
    for row, schema in zip(rows, schemas):
        for f in row["fields"]:
            names.setdefault(f["key"], f["name"])
            types.setdefault(f["key"], []).append(schema[f["key"]])
    unified = T.StructType([T.StructField(names[f.name], f.dataType) for f in unified_schema(types, strict)])
    # a column that the reader can't widen is read as it is stored, and files that store it alike are read together
    groups: dict[tuple, list] = {}
    for row, schema in zip(rows, schemas):
        odd = tuple((k, schema[k]) for k, f in zip(names, unified) if k in schema and not reader_widens(schema[k], f.dataType))
        groups.setdefault(odd, []).append(row["fields"])
    if len(groups) == 1 and () in groups:
        return spark.read.schema(unified).option("recursiveFileLookup", True).option("pathGlobFilter", name_glob).parquet(path)
    parts = []
    numbers = {json.dumps([f.asDict() for f in fields]): n for n, (_, members) in enumerate(groups.items()) for fields in members}
    listed = footers.select("path", F.to_json("fields").alias("said")).collect()
    for number, odd in enumerate(groups):
        stored = dict(odd)
        paths = [r["path"] for r in listed if numbers[json.dumps(json.loads(r["said"]))] == number]
        schema = T.StructType([T.StructField(f.name, stored.get(k, f.dataType)) for k, f in zip(names, unified)])
        read = spark.read.schema(schema).parquet(*paths)
        parts.append(read.select([field(f.name).cast(f.dataType).alias(f.name) for f in unified]))
    return reduce(DataFrame.unionByName, parts)


def _type_of(text: str) -> T.DataType:
    return T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": json.loads(text), "nullable": True, "metadata": {}}]})[0].dataType


def _written(footers: DataFrame) -> DataFrame:
    """The rows, written down, so that footers are read once."""
    path = scratch_path(footers.sparkSession, "footers")
    footers.write.parquet(path)
    return footers.sparkSession.read.schema(footers.schema).parquet(path)
