"""Files as they arrive, files that arrive twice, and files that were not read."""

import os
import shutil
from datetime import UTC, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeproof.session import scratch_path
from lakeproof.sinks import versions
from lakeproof.sinks.versions import read_table
from lakeproof.sources.audit import FilesSkipped, audit_files, require_read
from lakeproof.streaming.arrivals import arrival_windows, file_arrivals, ingest_deliveries
from lakeproof.streaming.ingest import ingest_available


def put(spark, folder, name, rows, at):
    """One Parquet file of some ids, modified at a time of 2024-01-01 (hours, minutes)."""
    os.makedirs(folder, exist_ok=True)
    made = scratch_path(spark, "made")
    spark.createDataFrame([(r,) for r in rows], "id int").coalesce(1).write.parquet(made)
    part = next(f for f in os.listdir(made) if f.startswith("part-"))
    shutil.copy(f"{made}/{part}", f"{folder}/{name}")
    touch(f"{folder}/{name}", at)


def touch(path, at):
    when = datetime(2024, 1, 1, *at, tzinfo=UTC).timestamp()
    os.utime(path, (when, when))


def again(source, target, at):
    os.makedirs(os.path.dirname(target), exist_ok=True)
    shutil.copy(source, target)
    touch(target, at)


def test_a_file_that_comes_twice_counts_once(spark, tmp_path):
    landing, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    put(spark, f"{landing}/x", "a.parquet", [1], (0, 30))
    put(spark, f"{landing}/x", "b.parquet", [2], (1, 0))  # a window's start belongs to it
    again(f"{landing}/x/a.parquet", f"{landing}/y/a.parquet", (0, 50))
    run = lambda: ingest_available(arrival_windows(file_arrivals(spark, landing), "1 hour", "2 hours"), target, checkpoint)
    run()
    again(f"{landing}/x/b.parquet", f"{landing}/z/b.parquet", (1, 40))  # a later run, within the watermark
    put(spark, f"{landing}/x", "c.parquet", [3], (2, 59))
    run()
    put(spark, f"{landing}/x", "end.parquet", [4], (9, 0))
    run()
    found = sorted((r["window_start"].hour, r["window_end"].hour, r["files"]) for r in spark.read.parquet(target).collect())
    assert found == [(0, 1, 1), (1, 2, 1), (2, 3, 1)]


def test_rows_of_a_delivery_are_loaded_once_however_late(spark, tmp_path):
    landing, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: ingest_deliveries(spark, landing, "id int", target, checkpoint)
    put(spark, f"{landing}/x", "a.parquet", [1, 1], (5, 0))
    again(f"{landing}/x/a.parquet", f"{landing}/y/a.parquet", (5, 1))
    run()
    again(f"{landing}/x/a.parquet", f"{landing}/z/a.parquet", (23, 0))
    put(spark, f"{landing}/x", "b.parquet", [2], (0, 1))
    run()
    run()
    again(f"{landing}/x/b.parquet", f"{landing}/y/b.parquet", (1, 1))
    run()
    found = sorted((r["id"], r["delivered_name"], r["delivered_at"].hour) for r in read_table(spark, target).collect())
    assert found == [(1, "a.parquet", 5), (1, "a.parquet", 5), (2, "b.parquet", 0)]


def test_a_batch_that_is_run_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    from lakeproof.streaming import arrivals

    landing, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    put(spark, f"{landing}/x", "a.parquet", [1], (5, 0))
    put_whole, calls = arrivals.put_increment, []

    def die(df, path, key, notes=None):
        calls.append(path)
        if len(calls) == 2:  # the rows are in, the deliveries are not
            raise RuntimeError("lost")
        return put_whole(df, path, key, notes)

    monkeypatch.setattr(arrivals, "put_increment", die)
    with pytest.raises(Exception, match="lost"):
        ingest_deliveries(spark, landing, "id int", target, checkpoint)
    assert read_table(spark, target).count() == 1
    ingest_deliveries(spark, landing, "id int", target, checkpoint)
    assert [r["id"] for r in read_table(spark, target).collect()] == [1] and len(versions.version_of(spark, target).parts) == 1


def test_stray_and_broken_files_are_named(spark, tmp_path):
    good = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)
    good.write.option("parquet.block.size", 100_000).option("compression", "none").parquet(str(tmp_path / "good"))
    good.limit(0).write.parquet(str(tmp_path / "none"))
    part = next(p for p in (tmp_path / "good").iterdir() if p.name.startswith("part-"))
    data = bytearray(part.read_bytes())
    (tmp_path / "a b+c%").mkdir()
    (tmp_path / "a b+c%" / "fine.parquet").write_bytes(data)
    (tmp_path / "stray.parquet").write_text("not a table")
    (tmp_path / "cut.parquet").write_bytes(data[:len(data) // 2])
    groups = pq.ParquetFile(part).metadata.num_row_groups
    assert groups > 2
    column = pq.ParquetFile(part).metadata.row_group(groups - 1).column(1)
    start = column.dictionary_page_offset or column.data_page_offset
    data[start:start + column.total_compressed_size] = b"\xff" * column.total_compressed_size
    (tmp_path / "broken.parquet").write_bytes(data)
    audit = audit_files(spark, str(tmp_path), good.schema, "*.parquet")
    found = {r["file"]: r["state"] for r in audit.collect()}
    assert found.pop("/stray.parquet") == found.pop("/cut.parquet") == "unreadable" and found.pop("/broken.parquet") in ("partly read", "unreadable")
    assert found.pop("/a b+c%/fine.parquet") == "read" and sorted(found.values()) == ["empty", "read"]
    with pytest.raises(FilesSkipped, match=r"3 files were not read, 2 allowed: .*/cut.parquet \(unreadable\)"):
        require_read(audit, most_skipped=2)
    assert require_read(audit, most_skipped=3) == 3
