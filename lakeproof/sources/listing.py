"""File and folder listings. Contents are never read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fnmatch import fnmatch
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.session import scratch_path
from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.remote import resolve

LISTING_SCHEMA = "path string, size bigint, modified timestamp"
_LISTING = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])
_FOLDER = pa.schema([("folder", pa.string())])

# A few folders may hold large trees, so they get tasks of their own; starting a task takes as long as
# listing hundreds of small ones, so of many folders each task takes more.
FOLDERS_PER_TASK = 4
LISTING_TASKS = 400
MOST_FOLDERS_PER_TASK = 10_000
ROWS_PER_BATCH = 10_000


def walk_files(spark: SparkSession, root: str, name_glob: str = "*", spread_levels: int = 2) -> DataFrame:
    """(path, size, modified) of every file below a folder, listed by tasks.

    Spark's own file index lives on the driver and leaves out empty files and
    names that start with ``_`` or ``.``, which an inventory must show. Here the
    first folder levels are expanded one after the other, and the folders found
    are dealt out to tasks; the driver sees none of them.
    """
    return _work(spark, root, spread_levels).mapInArrow(_files_below(name_glob), LISTING_SCHEMA)


def walk_folders(spark: SparkSession, root: str, spread_levels: int = 2) -> DataFrame:
    """(path) of a folder and of every folder below it, empty ones too, each ending in a slash."""
    return _work(spark, root, spread_levels).mapInArrow(_folders_below, "path string")


def _work(spark: SparkSession, root: str, spread_levels: int) -> DataFrame:
    """(folder, deep) on many tasks: folders to list alone, and folders whose whole tree one task lists."""
    if spread_levels < 1:
        raise ValueError("a tree is listed by more than one task")
    levels = [spark.range(1).select(F.lit(root.rstrip("/") or "/").alias("folder"))]
    for _ in range(spread_levels):
        path = scratch_path(spark, "folders")
        dealt = levels[-1] if len(levels) == 1 else dealt_out(levels[-1], ["folder"], F.lit(1), FOLDERS_PER_TASK, LISTING_TASKS, MOST_FOLDERS_PER_TASK)
        dealt.mapInArrow(_sub_folders, "folder string").write.parquet(path)
        levels.append(spark.read.schema("folder string").parquet(path))
    # folders that were expanded list their own files, the last level lists whole trees
    work = levels[-1].withColumn("deep", F.lit(True))
    for level in levels[:-1]:
        work = work.unionByName(level.withColumn("deep", F.lit(False)))
    return dealt_out(work, ["folder"], F.lit(1), FOLDERS_PER_TASK, LISTING_TASKS, MOST_FOLDERS_PER_TASK)


def _children(folder: str) -> tuple[Callable[[str], str], list[pafs.FileInfo]]:
    """What a folder holds, and how to make an address of a child's path."""
    filesystem, path = resolve(folder)
    prefix = folder[: len(folder.rstrip("/")) - len(path.rstrip("/"))]
    return (lambda child: prefix + child), filesystem.get_file_info(pafs.FileSelector(path))


def _sub_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[str]:
        for batch in batches:
            for folder in batch["folder"].to_pylist():
                address, infos = _children(folder)
                yield from (address(i.path) for i in infos if i.type == pafs.FileType.Directory)

    for some in _batched(found()):
        yield pa.RecordBatch.from_pydict({"folder": some}, _FOLDER)


def _files_below(name_glob: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[str, pafs.FileInfo]]:
            for batch in batches:
                for row in batch.to_pylist():
                    waiting = [row["folder"]]
                    while waiting:
                        address, infos = _children(waiting.pop())
                        if row["deep"]:
                            waiting += [address(i.path) for i in infos if i.type == pafs.FileType.Directory]
                        yield from (
                            (address(i.path), i) for i in infos if i.type == pafs.FileType.File and fnmatch(i.base_name, name_glob)
                        )

        for some in _batched(found()):
            yield pa.RecordBatch.from_pydict({
                "path": [path for path, _ in some],
                "size": [i.size for _, i in some],
                "modified": [i.mtime for _, i in some],
            }, _LISTING)

    return walk


def _folders_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[str]:
        for batch in batches:
            for row in batch.to_pylist():
                waiting = [row["folder"]]
                while waiting:
                    folder = waiting.pop()
                    yield folder.rstrip("/") + "/"
                    if row["deep"]:
                        address, infos = _children(folder)
                        waiting += [address(i.path) for i in infos if i.type == pafs.FileType.Directory]

    for some in _batched(found()):
        yield pa.RecordBatch.from_pydict({"path": some})


def _batched(found: Iterator) -> Iterator[list]:
    """What a task finds in all of its folders, in lists that make one batch each."""
    while some := list(islice(found, ROWS_PER_BATCH)):
        yield some


def modified_between(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Files that changed in [start, end)."""
    return listing.where((F.col("modified") >= F.lit(start).cast("timestamp")) & (F.col("modified") < F.lit(end).cast("timestamp")))


def relative_to(listing: DataFrame, root: str) -> DataFrame:
    """Cut the root off the paths, so that listings of two places can be compared."""
    return listing.withColumn("path", F.substring("path", F.lit(len(root.rstrip("/")) + 1), F.length("path")))
