"""Quoted CSV and JSON arrays that many tasks share, equal to what one task reads."""

import io
import json
import random

import pytest

from lakeproof.catalog import readers, staging
from lakeproof.sources import files
from lakeproof.sources.files import DOUBLED_QUOTE, CsvDialect
from lakeproof.sources.listing import walk_files
from lakeproof.sources.splitting import JsonArray, QuotedLines, read_csv_chunks, read_json_chunks, split_records

BACKSLASH = CsvDialect()


def pieces(data, kind, size):
    """The records of some bytes, from chunks of a size, with lists and loops."""
    stretches = []
    for low in range(0, max(len(data), 1), size):
        start = 0 if low == 0 else data.find(kind.border, low, low + size) + 1
        if low == 0 or start:
            stretches.append(start)
    found, state = [], (False, 0)
    for start, end in zip(stretches, [*stretches[1:], len(data)]):
        rest = io.BytesIO(data[end:])
        found += kind.records(data[start:end], state, lambda: rest.read(7))
        quoted, depth = kind.scan(data[start:end], (state[0], 0))
        state = (quoted, state[1] + depth)
    return found


def csv_text(rows, dialect):
    def value(v):
        inner = v.replace("\\", "\\\\") if dialect.escape == "\\" else v
        return f'"{inner.replace(chr(34), dialect.escape + chr(34))}"'

    return "".join(",".join(value(v) if random.Random(v).random() < 0.7 or set(v) & set(',"\n\r\\') else v for v in row) + "\n" for row in rows)


def texts(seed, count):
    draw = random.Random(seed)
    return ["".join(draw.choice('ab,"\n\\é ') for _ in range(draw.randint(1, 12))) for _ in range(count)]


@pytest.mark.parametrize("dialect", [BACKSLASH, DOUBLED_QUOTE])
def test_records_are_the_same_for_any_chunks(dialect):
    kind = QuotedLines(dialect)
    for seed in range(60):
        some = texts(seed, 24)
        data = csv_text([some[k:k + 2] for k in range(0, 24, 2)], dialect).encode()
        data = data[:-1] if seed % 3 == 0 else data
        whole = pieces(data, kind, len(data) + 1)
        assert b"".join(whole) == data and len(whole) == 12
        assert all(pieces(data, kind, size) == whole for size in (1, 2, 3, 5, 8, 13, 40, 200))
    assert pieces(b"", kind, 5) == [] and pieces(b'"open\nand never closed', kind, 4) == [b'"open\nand never closed']


def test_elements_are_the_same_for_any_chunks():
    kind = JsonArray()
    for seed in range(60):
        draw = random.Random(seed)
        rows = [{"t": t, "list": [1, [t], {"x": '],[{"'}], "n": draw.randint(0, 9)} for t in texts(seed, draw.randint(0, 9))]
        data = json.dumps(rows, indent=draw.choice([None, 1]), ensure_ascii=draw.random() < 0.5).encode()
        for size in (1, 2, 3, 7, 20, 100, 10_000):
            assert [json.loads(r) for r in pieces(data, kind, size)] == rows, (seed, size)
    assert pieces(b" [ ] ", kind, 2) == [] and [r.strip() for r in pieces(b'[1, "a,b" , null]', kind, 3)] == [b"1", b'"a,b"', b"null"]


@pytest.mark.parametrize("dialect", [BACKSLASH, DOUBLED_QUOTE])
def test_a_file_is_read_by_many_tasks(spark, tmp_path, dialect):
    rows = [[str(k), t or "x"] for k, t in enumerate(texts(5, 3000))]
    for name, some in (("a.csv", rows[:2500]), ("b.csv", rows[2500:]), ("empty.csv", [])):
        (tmp_path / name).write_bytes(("id,text\n" + csv_text(some, dialect)).encode() if some else b"")
    found = read_csv_chunks(spark, str(tmp_path), "id int, text string", dialect, chunk_bytes=1000)
    expected = files.read_csv(spark, str(tmp_path), dialect, "id int, text string", multiline=True)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) and found.count() == 3000
    shared = split_records(walk_files(spark, str(tmp_path), "a.csv"), QuotedLines(dialect), 1000)
    assert shared.select("number").distinct().count() > 20 and shared.rdd.getNumPartitions() > 20


def test_an_array_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"id": k, "text": t, "inner": {"a": [k, k + 1]}} for k, t in enumerate(texts(6, 2000))]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    (tmp_path / "two.json").write_text(json.dumps(rows[:50], indent=2))
    schema = "id bigint, text string, inner struct<a: array<bigint>>"
    found = read_json_chunks(spark, str(tmp_path), schema, chunk_bytes=2000)
    expected = files.read_json(spark, str(tmp_path), schema)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.count() == 2050


def written_in(monkeypatch, spark, query, writer):
    """How many files a query writes, and the rows it reads back, where a file holds 20 kB at most."""
    parts, write = [], getattr(readers, writer)
    monkeypatch.setattr(staging, "FILE_BYTES", 20_000, raising=False)
    monkeypatch.setattr(readers, writer, lambda df, path: parts.append(df.rdd.getNumPartitions()) or write(df, path))
    return query(spark, "/root/testdata/sf0.001").select("doc_id", "text"), parts[0]


def test_csv_files_grow_in_number_with_the_table(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found, parts = written_in(monkeypatch, spark, readers.src_csv_chunks, "write_csv")
    assert parts > 4 and sorted(found.collect()) == sorted(documents.collect())


def test_json_files_grow_in_number_with_the_table(spark, monkeypatch):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found, parts = written_in(monkeypatch, spark, readers.src_json_chunks, "write_json_arrays")
    assert parts > 4 and sorted(found.collect()) == sorted(documents.collect())


def test_many_small_chunks_are_read_by_few_tasks(spark, tmp_path):
    rows = [[str(k), t or "x"] for k, t in enumerate(texts(7, 3000))]
    (tmp_path / "a.csv").write_text("id,text\n" + csv_text(rows, BACKSLASH), newline="")
    records = split_records(walk_files(spark, str(tmp_path)), QuotedLines(BACKSLASH), 40)
    assert records.select("number").distinct().count() > 400 and records.rdd.getNumPartitions() <= 400
    assert records.count() == 3001
