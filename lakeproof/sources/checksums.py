"""Checksums and byte copies of files, in fixed-size pieces.

The pieces of a file are shared among tasks, so one huge file does not hold up
the job, and each task reads a few megabytes at a time. The number of tasks
follows from the bytes to read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileType
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.session import scratch_path
from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.remote import resolve

PIECE_BYTES = 256 * 1024 * 1024
READ_BYTES = 4 * 1024 * 1024
# Rows of a listing that a task works off; a piece is a quarter of a gigabyte at most.
PIECES_PER_TASK = 4
PIECE_SCHEMA = "path string, piece bigint, piece_bytes bigint, sha256 string"


def file_pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, piece, piece_bytes, sha256) of the files in a listing. An empty file has one empty piece."""
    last = F.greatest(F.ceil(F.col("size") / piece_bytes), F.lit(1)) - 1
    pieces = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    spread = dealt_out(pieces, ["path", "piece"], F.lit(1), PIECES_PER_TASK)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(p, n, *_digest(p, n * piece_bytes, piece_bytes)) for p, n in zip(batch["path"], batch["piece"])],
                columns=["path", "piece", "piece_bytes", "sha256"],
            )

    return spread.mapInPandas(digest, PIECE_SCHEMA)


def _digest(address: str, start: int, length: int) -> tuple[int, str]:
    filesystem, path = resolve(address)
    digest, left = hashlib.sha256(), length
    with filesystem.open_input_file(path) as stream:
        stream.seek(start)
        while left and (block := stream.read(min(left, READ_BYTES))):
            digest.update(block)
            left -= len(block)
    return length - left, digest.hexdigest()


def compare_pieces(source: DataFrame, target: DataFrame, key: str = "file") -> DataFrame:
    """Per file: pieces of each side and pieces that are equal.

    Both sides carry ``key``, a name that does not depend on the folder.
    """
    tagged = source.select(key, "piece", "sha256", F.lit(True).alias("is_source")).unionByName(
        target.select(key, "piece", "sha256", F.lit(False).alias("is_source"))
    )
    pieces = tagged.groupBy(key, "piece").agg(
        F.count_if("is_source").alias("in_source"), F.count_if(~F.col("is_source")).alias("in_target"),
        (F.min("sha256") == F.max("sha256")).alias("same"),
    )
    both = (F.col("in_source") > 0) & (F.col("in_target") > 0)
    return pieces.groupBy(key).agg(
        F.sum("in_source").alias("source_pieces"), F.sum("in_target").alias("target_pieces"),
        F.count_if(both & F.col("same")).alias("equal_pieces"),
    )


COPY_SCHEMA = "source string, target string, bytes bigint"
BLOCK_SCHEMA = "source string, target string, block bigint, name string, bytes bigint"


def copy_files(files: DataFrame) -> DataFrame:
    """Copy ``source`` to ``target`` addresses, a few files per task; lazy until used.

    Each copy is written under a temporary name and then renamed, so a task
    that is run again after a lost executor leaves no half file. Object stores
    have no write at an offset, so one file is one task's stream.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(s, t, _copy(s, t)) for s, t in zip(batch["source"], batch["target"])],
                columns=["source", "target", "bytes"],
            )

    dealt = dealt_out(files.select("source", "target"), ["source"], F.lit(1), PIECES_PER_TASK)
    return dealt.mapInPandas(copy, COPY_SCHEMA)


def _copy(source: str, target: str) -> int:
    read_fs, read_path = resolve(source)
    write_fs, write_path = resolve(target)
    write_fs.create_dir(write_path.rsplit("/", 1)[0], recursive=True)
    partial = f"{write_path}.{uuid.uuid4().hex}.partial"
    copied = 0
    with read_fs.open_input_stream(read_path) as reader, write_fs.open_output_stream(partial) as writer:
        while block := reader.read(READ_BYTES):
            writer.write(block)
            copied += len(block)
    write_fs.move(partial, write_path)
    return copied


def copy_in_blocks(files: DataFrame, block_bytes: int = PIECE_BYTES) -> DataFrame:
    """Copy ``source`` to ``target`` addresses, each file by as many tasks as it has blocks; (source, target, bytes).

    ``files`` has the ``size`` too. Every block is copied under a name of its own beside the target;
    which attempt's counts is written down before anything is joined, so a task that runs again does
    no harm. Then a file's blocks become one: without moving a byte where the file system can
    concatenate (HDFS), by one task's stream where it can't. Files of one block are renamed. Runs when called.
    """
    spark = files.sparkSession
    last = F.greatest(F.ceil(F.col("size") / block_bytes), F.lit(1)) - 1
    blocks = files.select("source", "target", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(s, t, n, *_copy_block(s, t, n * block_bytes, block_bytes)) for s, t, n in zip(batch["source"], batch["target"], batch["block"])],
                columns=["source", "target", "block", "name", "bytes"],
            )

    written = scratch_path(spark, "blocks")
    dealt_out(blocks, ["source", "block"], F.lit(1), PIECES_PER_TASK).mapInPandas(copy, BLOCK_SCHEMA).write.parquet(written)
    copied = spark.read.schema(BLOCK_SCHEMA).parquet(written)
    parts = copied.groupBy("source", "target").agg(F.array_sort(F.collect_list(F.struct("block", "name"))).alias("parts"), F.sum("bytes").alias("bytes"))
    joined = scratch_path(spark, "joined")
    for row in parts.where(F.size("parts") > 1).toLocalIterator():
        if not _concatenated(spark, row["target"], [part["name"] for part in row["parts"]]):
            break

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for target, names in zip(batch["target"], batch["parts"]):
                _join_blocks(target, [part["name"] for part in names])
            yield batch[["source", "target", "bytes"]]

    dealt_out(parts, ["source"], F.lit(1), PIECES_PER_TASK).mapInPandas(join, COPY_SCHEMA).write.parquet(joined)
    return spark.read.schema(COPY_SCHEMA).parquet(joined)


def _copy_block(source: str, target: str, start: int, length: int) -> tuple[str, int]:
    read_fs, read_path = resolve(source)
    write_fs, write_path = resolve(target)
    write_fs.create_dir(write_path.rsplit("/", 1)[0], recursive=True)
    name = f"{target}.{start:020d}.{uuid.uuid4().hex}.block"
    left = length
    with read_fs.open_input_file(read_path) as reader, write_fs.open_output_stream(resolve(name)[1]) as writer:
        reader.seek(start)
        while left and (data := reader.read(min(left, READ_BYTES))):
            writer.write(data)
            left -= len(data)
    return name, length - left


def _concatenated(spark: SparkSession, target: str, names: list[str]) -> bool:
    """Whether the file system has made one file of the blocks by itself; it changes the list of a file's blocks, no data."""
    jvm = spark._jvm
    first, *others = (jvm.org.apache.hadoop.fs.Path(name) for name in names)
    system = first.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(others))
    for number, other in enumerate(others):
        listed[number] = other
    try:
        system.concat(first, listed)
    except UnsupportedOperationException:
        return False
    return system.rename(first, jvm.org.apache.hadoop.fs.Path(target))


def _join_blocks(target: str, names: list[str]) -> None:
    """Make one file of its blocks. A task that runs again finds the file, or the blocks that are left beside it."""
    filesystem, path = resolve(target)
    blocks = [resolve(name)[1] for name in names]
    left = [block for block, info in zip(blocks, filesystem.get_file_info(blocks)) if info.type == FileType.File]
    if len(left) < len(blocks):  # joined before: blocks go only after the file is in place
        for block in left:
            filesystem.delete_file(block)
        return
    if len(blocks) == 1:
        filesystem.move(blocks[0], path)
        return
    partial = f"{path}.{uuid.uuid4().hex}.partial"
    with filesystem.open_output_stream(partial) as writer:
        for block in blocks:
            with filesystem.open_input_stream(block) as reader:
                while data := reader.read(READ_BYTES):
                    writer.write(data)
    filesystem.move(partial, path)
    for block in blocks:
        filesystem.delete_file(block)
