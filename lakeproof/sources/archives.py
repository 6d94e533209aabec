"""Zip archives: list their members, then read every member as its own task.

The directory at the end of an archive says where each member starts, so a task
reads one member as a stream. Neither an archive nor a member is ever held in
memory as a whole.
"""

from __future__ import annotations

import csv
import io
import sys
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.files import CsvDialect
from lakeproof.sources.remote import resolve

MEMBER_SCHEMA = "archive string, member string, member_size bigint"
LINE_SCHEMA = "archive string, member string, line_no bigint, line string"
LINES_PER_BATCH = 10_000
# Archives are listed, and members read, by as many tasks as that takes.
ARCHIVES_PER_TASK = 4
BYTES_PER_TASK = 128 * 1024 * 1024
# A member costs a task something even if it is empty.
MEMBER_BYTES = BYTES_PER_TASK // 4


def list_members(archives: DataFrame) -> DataFrame:
    """(archive, member, member_size) of the archives in a listing."""
    dealt = dealt_out(archives.select("path"), ["path"], F.lit(1), ARCHIVES_PER_TASK)
    return dealt.mapInPandas(_members, MEMBER_SCHEMA)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for address in batch["path"]:
            filesystem, path = resolve(address)
            with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                found = [(address, m.filename, m.file_size) for m in archive.infolist() if not m.is_dir()]
                for start in range(0, len(found), LINES_PER_BATCH):
                    yield pd.DataFrame(found[start:start + LINES_PER_BATCH], columns=["archive", "member", "member_size"])


def _chosen(archives: DataFrame, member_suffix: str | None) -> DataFrame:
    """The members to read, dealt out by the bytes they hold."""
    members = list_members(archives)
    if member_suffix is not None:
        members = members.where(F.endswith("member", F.lit(member_suffix)))
    work = F.greatest(F.col("member_size"), F.lit(MEMBER_BYTES))
    return dealt_out(members, ["archive", "member"], work, BYTES_PER_TASK)


def member_lines(
    archives: DataFrame, member_suffix: str | None = None, encoding: str = "utf-8", row_delimiter: str = "\n",
) -> DataFrame:
    """(archive, member, line_no, line) of all members, in parallel by member."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield from _stream_member(row.archive, row.member, encoding, row_delimiter)

    return _chosen(archives, member_suffix).mapInPandas(lines, LINE_SCHEMA)


def _stream_member(address: str, member: str, encoding: str, row_delimiter: str) -> Iterator[pd.DataFrame]:
    filesystem, path = resolve(address)
    with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as packed:
        numbers, lines = [], []
        for number, line in enumerate(_split(io.TextIOWrapper(packed, encoding, newline=""), row_delimiter), start=1):
            numbers.append(number)
            lines.append(line)
            if len(lines) == LINES_PER_BATCH:
                yield _line_batch(address, member, numbers, lines)
                numbers, lines = [], []
        if lines:
            yield _line_batch(address, member, numbers, lines)


def _split(text: io.TextIOBase, delimiter: str) -> Iterator[str]:
    rest = ""
    while chunk := text.read(1 << 20):
        *whole, rest = (rest + chunk).split(delimiter)
        yield from whole
    if rest:
        yield rest


def _line_batch(address: str, member: str, numbers: list[int], lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"archive": address, "member": member, "line_no": numbers, "line": lines})


def read_zipped_csv(
    archives: DataFrame, schema: str, dialect: CsvDialect = CsvDialect(sep="\t", escape='"', header=False),
    member_suffix: str | None = None, encoding: str = "utf-8",
) -> DataFrame:
    """Delimited members, parsed with a schema; ``archive`` and ``member`` come first.

    Members are parsed as streams, so a quoted value may hold separators and line
    breaks. With a header the columns of the schema are found by name, and a
    column that a member lacks is null; without one they are taken by place. An
    empty field is null, and so is a value that doesn't fit its type. An escape
    other than a doubled quote counts before a quote only.
    """
    declared = T.StructType.fromDDL(schema)
    names = [f.name for f in declared]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for row in batch.to_pylist():
                yield from _parse_member(row["archive"], row["member"], names, dialect, encoding)

    parsed = _chosen(archives, member_suffix).mapInArrow(rows, "archive string, member string, fields array<string>")
    typed = [F.get("fields", F.lit(n)).try_cast(f.dataType).alias(f.name) for n, f in enumerate(declared)]
    return parsed.select("archive", "member", *typed)


def _parse_member(
    address: str, member: str, names: list[str], dialect: CsvDialect, encoding: str
) -> Iterator[pa.RecordBatch]:
    filesystem, path = resolve(address)
    with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as packed:
        text = io.TextIOWrapper(packed, encoding, newline="")
        lines: Iterator[str] = text if dialect.line_sep in (None, "\n", "\r\n") else _split(text, dialect.line_sep)
        if dialect.escape != dialect.quote:
            lines = (line.replace(dialect.escape + dialect.quote, 2 * dialect.quote) for line in lines)
        parsed = csv.reader(lines, delimiter=dialect.sep, quotechar=dialect.quote, doublequote=True)
        places = list(range(len(names)))
        if dialect.header:
            header = next(parsed, [])
            places = [header.index(n) if n in header else sys.maxsize for n in names]
        found: list[list[str | None]] = []
        for values in parsed:
            if values:
                found.append([(values[p] or None) if p < len(values) else None for p in places])
            if len(found) == LINES_PER_BATCH:
                yield _row_batch(address, member, found)
                found = []
        if found:
            yield _row_batch(address, member, found)


def _row_batch(address: str, member: str, found: list[list[str | None]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "archive": pa.array([address] * len(found)), "member": pa.array([member] * len(found)),
        "fields": pa.array(found, pa.list_(pa.string())),
    })
