"""Write given tables in the foreign forms that the readers are tried on."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from py4j.java_gateway import JavaObject
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.sources.dealing import dealt_out
from lakeproof.sources.remote import resolve

FOLDERS_PER_TASK = 2000
FILE_BYTES = 128 * 1024 * 1024


def in_files(df: DataFrame, row_bytes: Column, least: int) -> DataFrame:
    """A table in one partition per file to write: ``least`` files, and so many more that each has about ``FILE_BYTES`` at most."""
    total = df.agg(F.sum(row_bytes)).first()[0] or 0
    return df.repartition(max(least, -(-total // FILE_BYTES)))


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One file per partition, holding one JSON array of its rows."""
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    texts = df.select(F.to_json(F.struct("*"), {"timestampNTZFormat": whole}).alias("value"))
    texts.mapInPandas(_bracketed, "value string").write.text(path)


def _bracketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turn a partition of documents into the lines of one JSON array."""
    opened = False
    for batch in batches:
        if len(batch):
            lines = ["," + text for text in batch["value"]]
            if not opened:
                lines[0] = "[" + lines[0][1:]
                opened = True
            yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]" if opened else "[]"]})


def zip_partition(folder: str):
    """Write each partition as an archive with one tab-separated member per batch, headed by its column names.

    The name follows the partition and the archive is renamed into place, so a
    task that runs again replaces what it wrote before.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = resolve(folder)
        filesystem.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"{root}/part-{context.partitionId():05d}.zip"
        partial = f"{name}.{context.taskAttemptId()}"
        with filesystem.open_output_stream(partial) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
            for number, batch in enumerate(batches):
                text = io.StringIO()
                batch.to_csv(text, sep="\t", index=False)
                archive.writestr(f"member_{number}/event.tsv", text.getvalue())
                archive.writestr(f"member_{number}/readme.txt", "not a table\n")
        filesystem.move(partial, name)
        yield pd.DataFrame({"archive": [name]})

    return write


def make_folders(folders: DataFrame) -> None:
    """Make the (folder) addresses."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                filesystem, path = resolve(folder)
                filesystem.create_dir(path, recursive=True)
            yield batch

    dealt_out(folders, ["folder"], F.lit(1), FOLDERS_PER_TASK).mapInPandas(make, "folder string").count()


def file_system(spark: SparkSession, folder: str) -> tuple[JavaObject, Callable[[str], JavaObject]]:
    """Hadoop's file system of a folder, and how to make one of its paths: to set times and copy files as they arrive."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path
