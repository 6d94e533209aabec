"""Snapshots of transactional tables: which folders count, and what they hold."""

import pytest
from pyspark.sql import functions as F

from lakeproof.operators.acid import read_snapshot, resolve_rows, snapshot_folders
from lakeproof.session import scratch_path


def states(spark, folders, failed=(), as_of=None):
    paths = [(f"/t/{f}/bucket_00000" if "/" not in f else f"/t/{f}",) for f in folders]
    found = snapshot_folders(spark.createDataFrame(paths, "path string"), failed, as_of).collect()
    return {r["folder"]: r["state"] for r in found}


def test_newest_base_and_what_is_above_it(spark):
    assert states(spark, ["base_0000005", "base_0000010_v0000022", "delta_0000010_0000010_0000", "delta_0000011_0000011", "delete_delta_0000012_0000012_0001"]) == {
        "base_0000005": "old base", "base_0000010_v0000022": "live", "delta_0000010_0000010_0000": "in base", "delta_0000011_0000011": "live",
        "delete_delta_0000012_0000012_0001": "live",
    }
    assert states(spark, ["base_0000005_v0000001", "base_0000005_v0000002"]) == {"base_0000005_v0000001": "old base", "base_0000005_v0000002": "live"}


def test_compacted_deltas_cover_their_parts(spark):
    found = states(spark, [
        "delta_0000001_0000001_0000", "delta_0000001_0000001_0001", "delta_0000002_0000004", "delta_0000003_0000003", "delta_0000002_0000004_v0000009",
        "delta_0000005_0000005_0000", "delta_0000005_0000005_v0000010", "delete_delta_0000003_0000003", "delta_0000004_0000006",
    ])
    assert {f for f, s in found.items() if s == "covered"} == {
        "delta_0000002_0000004", "delta_0000003_0000003", "delta_0000005_0000005_0000", "delta_0000005_0000005_v0000010",
    }


def test_writes_that_failed_or_came_later(spark):
    found = states(spark, ["base_0000003", "base_0000009", "delta_0000004_0000004", "delta_0000005_0000005", "delta_0000005_0000006", "delta_0000008_0000008"], failed=[4, 5], as_of=7)
    assert found == {
        "base_0000003": "live", "base_0000009": "after", "delta_0000004_0000004": "failed", "delta_0000005_0000005": "failed",
        "delta_0000005_0000006": "live", "delta_0000008_0000008": "after",
    }


def test_partitions_and_other_files(spark):
    found = states(spark, ["p=1/base_0000002/bucket_0", "p=2/delta_0000001_0000001/bucket_0", "p=2/delta_0000001_0000001/_flush_length", "_orc_acid_version", "x/000000_0", "p=1/delta_x_1/b"])
    assert found == {"base_0000002": "live", "delta_0000001_0000001": "live"} and states(spark, []) == {}


def write(spark, path, folder, rows):
    schema = "operation int, originalTransaction bigint, bucket int, rowId bigint, currentTransaction bigint, row struct<id: int, v: string>"
    spark.createDataFrame([(op, 1, 0, key, at, value) for op, key, at, value in rows], schema).write.orc(f"{path}/{folder}")


def test_a_snapshot_as_of_a_write(spark):
    path = scratch_path(spark, "acid")
    write(spark, path, "p=1/delta_0000001_0000003", [(0, 1, 1, (1, "a")), (0, 2, 2, (2, "b")), (2, 1, 3, None)])
    write(spark, path, "p=1/delta_0000004_0000004", [(0, 4, 4, (4, "d"))])

    def rows(**options):
        return sorted(tuple(r) for r in resolve_rows(read_snapshot(spark, path, **options)).collect())

    assert rows() == [(2, "b"), (4, "d")] and rows(as_of=2) == [(1, "a"), (2, "b")] and rows(as_of=3, failed=[2]) == []
    write(spark, path, "p=1/base_0000004", [(0, 2, 2, (2, "b")), (0, 4, 4, (4, "d"))])
    assert rows() == [(2, "b"), (4, "d")] and rows(as_of=2) == [(1, "a"), (2, "b")]
    write(spark, path, "p=2/base_0000005", [(0, 9, 5, (9, "z"))])
    assert rows() == [(2, "b"), (4, "d"), (9, "z")]
    with pytest.raises(FileNotFoundError, match="compacted"):
        read_snapshot(spark, path, as_of=3)
    other = scratch_path(spark, "no-events")
    spark.range(1).write.parquet(f"{other}/p=1")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, other)


def test_many_folders_of_one_table(spark):
    paths = spark.range(3000).select(F.format_string("/t/delta_%07d_%07d_0000/bucket_0", F.col("id") + 1, F.col("id") + 1).alias("path"))
    wide = spark.range(30).select(F.format_string("/t/delta_%07d_%07d_v0009999/bucket_0", F.col("id") * 100 + 1, F.col("id") * 100 + 50).alias("path"))
    counts = {r["state"]: r["count"] for r in snapshot_folders(paths.union(wide)).groupBy("state").count().collect()}
    assert counts == {"live": 1500 + 30, "covered": 1500}
