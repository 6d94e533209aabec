"""Tables whose content changes in one step: data folders, and commits that name those that count.

A table folder holds ``data-...`` folders of Parquet files, and ``_commits`` with one small JSON
file per version. A commit lists the folders of its version, in order, each under a key, and the
table's schema. Rows are written first and the commit is put in place by a rename that never
replaces a file, so a writer that dies leaves the old version readable, of two writers that start
from one version only one succeeds, and a reader that has read a commit sees that version alone.
The file system must rename without overwriting, as HDFS does; one writer at a time needs no more.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field
from lakeproof.operators.cleaning import void_to_string

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed the version first. Nothing of the table has changed."""


class NoVersion(FileNotFoundError):
    """The folder holds no committed version."""


@dataclass(frozen=True)
class Part:
    """A data folder of a version. ``key`` is what the folder stands for, such as the mark an increment starts from."""

    folder: str
    key: str | None = None


@dataclass(frozen=True)
class Version:
    """One state of a table: its parts in order, and what the writer noted."""

    number: int
    parts: tuple[Part, ...]
    schema: T.StructType
    notes: dict[str, str | None]


class _Folder:
    """The few calls on Hadoop's file system that commits need, on the driver."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self.path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, below: str) -> list[str]:
        """What a folder holds; nothing if it isn't there."""
        folder = self.path(f"{self.root}/{below}")
        return [status.getPath().getName() for status in self.system.listStatus(folder)] if self.system.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(f"{self.root}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file of that name, whole or not at all, unless there is one."""
        target, partial = self.path(f"{self.root}/{name}"), self.path(f"{self.root}/{name}.{uuid.uuid4().hex}")
        stream = self.system.create(partial, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
            context.rename(partial, target, _array(self.jvm, rename))
        except Exception as error:
            self.system.delete(partial, False)
            if self.system.exists(target):
                raise CommitConflict(f"{self.root}: {name} is there already") from error
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(f"{self.root}/{name}"), True)


def _array(jvm, rename):
    """Java's array of one rename option."""
    made = jvm.java.lang.reflect.Array.newInstance(rename.getClass(), 1)
    jvm.java.lang.reflect.Array.set(made, 0, rename)
    return made


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(stem) for stem, dot, end in (n.partition(".") for n in folder.names(COMMITS)) if end == "json" and stem.isdigit())


def _commit_name(number: int) -> str:
    return f"{COMMITS}/{number:010d}.json"


def version_of(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version of a table, or the one of that number."""
    folder = _Folder(spark, path)
    known = _numbers(folder)
    if not known or number is not None and number not in known:
        raise NoVersion(f"{path} has no version" + (f" {number}" if number is not None else ""))
    number = known[-1] if number is None else number
    said = json.loads(folder.read(_commit_name(number)))
    return Version(
        number, tuple(Part(p["folder"], p["key"]) for p in said["parts"]), T.StructType.fromJson(said["schema"]), said["notes"]
    )


def write_part(df: DataFrame, path: str, key: str | None = None) -> Part:
    """Write rows below a table folder, in a folder that no version names yet."""
    part = Part(f"data-{uuid.uuid4().hex}", key)
    void_to_string(df).write.option("compression", "snappy").parquet(f"{path.rstrip('/')}/{part.folder}")
    return part


def read_part(spark: SparkSession, path: str, part: Part, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{part.folder}")


def commit(
    spark: SparkSession, path: str, parts: Sequence[Part], schema: T.StructType, notes: dict[str, str | None] | None = None,
    after: int | None = None,
) -> Version:
    """Make these parts the table's next version. ``after`` is the version they were made from, if any."""
    folder = _Folder(spark, path)
    known = _numbers(folder)
    newest = known[-1] if known else 0
    if after is not None and after != newest:
        raise CommitConflict(f"{path} is at version {newest}, not {after}")
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
    said = {"parts": [{"folder": p.folder, "key": p.key} for p in parts], "schema": json.loads(schema.json()), "notes": notes or {}}
    folder.create(_commit_name(newest + 1), json.dumps(said))
    return Version(newest + 1, tuple(parts), schema, notes or {})


def newest_version(spark: SparkSession, path: str) -> Version | None:
    """The newest version of a table, if there is any."""
    try:
        return version_of(spark, path)
    except NoVersion:
        return None


def replace_table(df: DataFrame, path: str, notes: dict[str, str | None] | None = None) -> Version:
    """Replace the whole content of a table by these rows. They may come from the table itself."""
    spark, before = df.sparkSession, newest_version(df.sparkSession, path)
    part = write_part(df, path)
    return commit(spark, path, [part], void_to_string(df).schema, notes, before.number if before else 0)


def put_increment(df: DataFrame, path: str, key: str | None, notes: dict[str, str | None] | None = None) -> Version:
    """Add rows under a key, in place of what is there under that very key.

    The columns are those of the table, by name.
    """
    spark, before = df.sparkSession, newest_version(df.sparkSession, path)
    if before is not None and sorted(df.columns) != sorted(before.schema.names):
        raise ValueError(f"{path} has the columns {before.schema.names}, not {df.columns}")
    part = write_part(df, path, key)
    kept = [p for p in before.parts if p.key != key] if before else []
    return commit(spark, path, [*kept, part], before.schema if before else void_to_string(df).schema, notes, before.number if before else 0)


def read_table(spark: SparkSession, path: str, number: int | None = None, key_column: str | None = None) -> DataFrame:
    """The rows of the newest version, or of one that is still kept.

    ``key_column`` adds each row's key, under a name that the table must not have.
    """
    version = version_of(spark, path, number)
    root = path.rstrip("/")
    if key_column is None:
        folders = [f"{root}/{p.folder}" for p in version.parts]
        return spark.read.schema(version.schema).parquet(*folders) if folders else spark.createDataFrame([], version.schema)
    if key_column.lower() in (name.lower() for name in version.schema.names):
        raise ValueError(f"{path} has a column {key_column!r} of its own")
    # one scan; the folder tells the key, and there is one row per folder to look it up in
    names = {p.folder: p.key for p in version.parts if p.key is not None}
    rows = read_table(spark, path, version.number).select("*", F.col("_metadata.file_path").alias(f"{key_column}_file"))
    folder = F.regexp_extract(field(f"{key_column}_file"), r"/(data-[0-9a-f]+)/[^/]*$", 1)
    keys = spark.createDataFrame(list(names.items()), f"{key_column}_folder string, {key_column} string")
    named = rows.withColumn(f"{key_column}_folder", folder).join(F.broadcast(keys), f"{key_column}_folder", "left")
    return named.select(*[field(c) for c in version.schema.names], field(key_column))


def compact(spark: SparkSession, path: str) -> Version:
    """One part in place of many, with the same rows."""
    version = version_of(spark, path)
    return replace_table(read_table(spark, path, version.number), path, version.notes)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Forget all but the newest versions and delete data that none of these names; the numbers that went.

    Readers of an older version lose its files, and so does a writer that has not committed yet; run it alone.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    folder = _Folder(spark, path)
    known = _numbers(folder)
    gone, kept = known[:-keep], known[-keep:]
    for number in gone:
        folder.delete(_commit_name(number))
    named = {p.folder for number in kept for p in version_of(spark, path, number).parts}
    for name in folder.names(""):
        if name.startswith("data-") and name not in named:
            folder.delete(name)
    return gone
