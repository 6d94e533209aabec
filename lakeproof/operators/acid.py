"""Transactional ORC: the files of a snapshot, the row struct, and each row's last version.

Below a table folder, or each of its partition folders, compaction leaves folders side by side:
``base_N`` holds all rows up to write N, ``delta_A_B`` and ``delete_delta_A_B`` the events of the
writes from A to B, and a compacted one covers those it was made of. A snapshot is the newest base
and the deltas above it that no other covers, as of a write and without the writes that failed.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.functions.naming import field
from lakeproof.operators.cleaning import void_to_string
from lakeproof.sources.files import FileSelection, read_files, read_orc
from lakeproof.sources.listing import walk_files

DELETE_OPERATION = 2
ROW_ID = ("originalTransaction", "bucket", "rowId")
# The event columns of a transactional file, before its row struct.
EVENT_COLUMNS = ("operation", *ROW_ID, "currentTransaction")
MARKER_FILE = "_orc_acid_version"
# Folders of a transactional table, with the first and last write, the statement, and the write that made them visible.
EVENT_FOLDER = r"^(.*)/((base|delta|delete_delta)_(\d+)(?:_(\d+))?(?:_(\d+))?(?:_v(\d+))?)/[^/]+$"
#: Whether a folder belongs to a snapshot, and if not why.
LIVE, AFTER, FAILED, OLD_BASE, IN_BASE, COVERED = "live", "after", "failed", "old base", "in base", "covered"


def flatten_rows(df: DataFrame) -> DataFrame:
    """The fields of the last column, a struct. Every event is kept as it is."""
    last = df.schema[-1]
    if not isinstance(last.dataType, T.StructType):
        raise ValueError(f"last column {last.name!r} is no struct")
    inner = field(last.name)
    return void_to_string(df.select([inner.getField(f.name).alias(f.name) for f in last.dataType]))


def snapshot_folders(listing: DataFrame, failed: Iterable[int] = (), as_of: int | None = None) -> DataFrame:
    """(parent, folder, kind, first, last, statement, files, state) of every event folder in a file listing.

    ``state`` is ``live`` for what a reader of write ``as_of`` (default: all) must read. Others are
    after that write, hold the writes in ``failed`` only, are a base that is not the newest, lie below
    the base, or are covered by a folder of the same kind with a wider range, or with the same range
    and no statement (compaction keeps none) or made visible later. Files outside event folders, and
    hidden files, count for nothing. Folders of different parents (partitions) don't meet.
    """
    def part(group: int) -> Column:
        return F.regexp_extract("path", EVENT_FOLDER, group)

    hidden = F.regexp_extract("path", r"([^/]*)$", 1).rlike(r"^[_.]")
    folders = listing.where(F.col("path").rlike(EVENT_FOLDER) & ~hidden).select(
        part(1).alias("parent"), part(2).alias("folder"), part(3).alias("kind"), part(4).try_cast("bigint").alias("low"),
        part(5).try_cast("bigint").alias("high"), part(6).try_cast("bigint").alias("statement"), F.coalesce(part(7).try_cast("bigint"), F.lit(0)).alias("shown"),
    ).groupBy("parent", "folder", "kind", "low", "high", "statement", "shown").agg(F.count("*").alias("files"))
    is_base = F.col("kind") == "base"
    named = folders.withColumns({"first": F.when(is_base, F.lit(0).cast("bigint")).otherwise(F.col("low")), "last": F.when(is_base, F.col("low")).otherwise(F.col("high"))})
    lost = F.array(*[F.lit(w).cast("bigint") for w in sorted(set(failed))]).cast("array<bigint>")
    # writes are counted, not listed: a compacted delta may cover millions
    lost_inside = F.size(F.filter(lost, lambda w: (w >= F.col("first")) & (w <= F.col("last"))))
    after = F.lit(False) if as_of is None else F.when(is_base, F.col("last") > as_of).otherwise(F.col("first") > as_of)
    usable = named.withColumn("out", F.when(after, AFTER).when(~is_base & (lost_inside > F.col("last") - F.col("first")), FAILED))
    in_parent = Window.partitionBy("parent")
    newest = F.max(F.when(is_base & F.col("out").isNull(), F.struct("last", "shown"))).over(in_parent)
    based = usable.withColumn("base", newest).withColumn(
        "out", F.coalesce(
            "out", F.when(is_base & (F.struct("last", "shown") != F.col("base")), OLD_BASE),
            F.when(~is_base & (F.col("last") <= F.coalesce(F.col("base.last"), F.lit(0))), IN_BASE),
        ),
    )
    # of folders with one range, those of statements only count where none was compacted, and the last that was shown
    one_range = Window.partitionBy("parent", "kind", F.col("out").isNull(), "first", "last")
    compacted = F.max(F.when(F.col("statement").isNull(), F.col("shown"))).over(one_range)
    latest = F.max("shown").over(Window.partitionBy("parent", "kind", F.col("out").isNull(), "first", "last", "statement"))
    repeated = F.when(F.col("statement").isNull(), F.col("shown") < F.col("compacted")).otherwise(F.col("compacted").isNotNull() | (F.col("shown") < F.col("latest")))
    # a range is covered if one that begins no later, and is not the same, ends no earlier
    wider = Window.partitionBy("parent", "kind", F.col("out").isNull()).orderBy("first", F.desc("last")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reach = F.max(F.struct("last", (-F.col("first")).alias("from_first"))).over(wider)
    covered = (F.col("reach.last") > F.col("last")) | (F.col("reach.last") == F.col("last")) & (-F.col("reach.from_first") < F.col("first"))
    marked = based.withColumns({"compacted": compacted, "latest": latest, "reach": reach})
    is_covered = ~is_base & (repeated | covered)
    return marked.select(
        "parent", "folder", "kind", "first", "last", "statement", "files", F.coalesce("out", F.when(is_covered, COVERED), F.lit(LIVE)).alias("state")
    )


def read_snapshot(spark: SparkSession, path: str, failed: Iterable[int] = (), as_of: int | None = None) -> DataFrame:
    """The events of a table's snapshot, see ``snapshot_folders``; none if it has no event folder.

    The names of live folders, a few for each partition of the table, pass through the driver, where
    Spark lists the files it reads. Events of failed or later writes in a folder that holds others too are left out.
    """
    failed = sorted(set(failed))
    states = snapshot_folders(walk_files(spark, path), failed, as_of)
    needed = states.where((F.col("state") == LIVE) | (F.col("state") == AFTER) & (F.col("kind") == "base")).orderBy("parent", "folder").collect()
    live = [r for r in needed if r["state"] == LIVE]
    if not live:
        raise FileNotFoundError(f"{path} has no base and no delta" + (f" up to write {as_of}" if as_of is not None else ""))
    compacted = {r["parent"] for r in needed if r["state"] == AFTER} - {r["parent"] for r in live if r["kind"] == "base" or r["first"] == 1}
    if compacted:
        raise FileNotFoundError(f"{min(compacted)}: what write {as_of} saw has been compacted into a later base")
    events = _identified(read_orc(spark, [f"{r['parent']}/{r['folder']}" for r in live], FileSelection(recursive=True)))
    if as_of is not None:
        events = events.where(F.col("currentTransaction") <= as_of)
    return events.where(~F.col("currentTransaction").isin(failed)) if failed else events


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events below a table folder, whatever folders hold them; for a table as it stands see ``read_snapshot``.

    The ORC library knows transactional files by their six column names, and
    reads them wrongly when a reader asks for fewer. The filter says what holds
    for every valid event, and so keeps all six from being pruned.
    """
    return _identified(read_files(spark, path, "orc-acid"))


def _identified(events: DataFrame) -> DataFrame:
    payload = field(events.schema[-1].name)
    identified = reduce(Column.__and__, [F.col(c).isNotNull() for c in EVENT_COLUMNS])
    return events.where(identified & (payload.isNotNull() | (F.col("operation") == DELETE_OPERATION)))


def resolve_rows(df: DataFrame) -> DataFrame:
    """The table as of the last transaction: newest event per row, without deleted rows.

    ``max_by`` combines events before the shuffle, so a row that was rewritten
    a billion times does not gather in one task.
    """
    payload = df.schema[-1].name
    latest = df.groupBy(*ROW_ID).agg(
        F.max_by(F.struct("operation", field(payload).alias("payload")), "currentTransaction").alias("event")
    )
    live = latest.where(F.col("event.operation") != DELETE_OPERATION)
    return flatten_rows(live.select(F.col("event.payload").alias(payload)))


def table_dirs(listing: DataFrame, path: str = "path") -> DataFrame:
    """Folders that hold a transactional table, by their marker file."""
    marked = listing.where(F.col(path).endswith("/" + MARKER_FILE))
    return marked.select(F.regexp_replace(path, MARKER_FILE + "$", "").alias("table_dir")).distinct()
