"""File and folder inventories, freshness and completeness of a lake.

A listing is a DataFrame with at least ``path``, ``size`` and ``modified``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.functions.lake_paths import output_path_column

# Folders that hold the results of validation and conversion runs.
RESULT_FOLDERS = ("Test_Validation", "ORC_ACID_to_Parquet_Conversion")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_type(path: Column) -> Column:
    """Last extension; a name without one is an ORC part file."""
    name = file_name(path)
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).otherwise("orc")


def folder_of(path: Column) -> Column:
    """Everything up to and including the last slash."""
    return F.substring(path, F.lit(1), F.length(path) - F.length(file_name(path)))


def exclude_results(listing: DataFrame, prefixes: Sequence[str] = RESULT_FOLDERS) -> DataFrame:
    """Leave out paths below the given top-level folders, with or without a leading slash."""
    relative = F.ltrim(F.col("path"), F.lit("/"))
    kept = F.lit(True)
    for prefix in prefixes:
        kept = kept & ~F.startswith(relative, F.lit(prefix))
    return listing.where(kept)


def name_contains(listing: DataFrame, part: str) -> DataFrame:
    return listing.where(F.contains(file_name(F.col("path")), F.lit(part)))


def stale_files(listing: DataFrame, now: Column) -> DataFrame:
    """Files last changed before today."""
    return listing.where(F.to_date(now) > F.to_date("modified"))


def file_inventory(listing: DataFrame) -> DataFrame:
    path = F.col("path")
    return listing.select(
        path.alias("FilePath"), file_name(path).alias("FileName"),
        F.col("size").alias("SizeBytes"), file_type(path).alias("FileType"),
    )


def ancestors(path: Column) -> Column:
    """All folders above a file, root first, each ending in a slash.

    ``/a/b/f`` gives ``/``, ``/a/`` and ``/a/b/``.
    """
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.transform(
        F.sequence(F.lit(1), depth),
        lambda n: F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/")),
    )


def folder_inventory(listing: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """(Path, FolderCount, FileCount): direct children of every folder.

    A listing of files alone doesn't know of empty folders; ``folders`` has the
    (path) of all, as ``walk_folders`` lists them. Each file names its folder, and each folder its parent. Links are made
    distinct before the count per parent, and both steps combine before they
    shuffle, so a folder with a third of all files stays cheap. Files and links
    come from the same distinct paths, so that the tree is listed once.
    """
    leaf = folder_of(F.col("path"))
    paths = listing.select("path").distinct()
    files = (
        paths.groupBy(leaf.alias("Path")).agg(F.count("*").alias("files"))
        .withColumn("folders", F.lit(0).cast("bigint"))
    )
    links = F.transform(
        F.sequence(F.lit(1), F.size("chain")),
        lambda n: F.struct(F.when(n > 1, F.get("chain", n - 2)).alias("Path"), F.get("chain", n - 1).alias("child")),
    )
    leaves = paths.select(leaf.alias("leaf"))
    if folders is not None:
        leaves = leaves.unionByName(folders.select(F.col("path").alias("leaf")))
    named = (
        leaves.distinct()
        .select(ancestors(F.col("leaf")).alias("chain"))
        .select(F.inline(links)).distinct()
    )
    # a folder counts for its parent, and has a row of its own even if nothing is in it
    counted = named.select(F.inline(F.array(
        F.struct("Path", F.lit(1).alias("folders")), F.struct(F.col("child").alias("Path"), F.lit(0).alias("folders")),
    ))).where(F.col("Path").isNotNull()).groupBy("Path").agg(F.sum("folders").alias("folders")).withColumn(
        "files", F.lit(0).cast("bigint")
    )
    return files.unionByName(counted).groupBy("Path").agg(
        F.sum("folders").alias("FolderCount"), F.sum("files").alias("FileCount")
    )


def dir_size(listing: DataFrame) -> DataFrame:
    """(Path, TotalBytes, FileCount): everything below each folder.

    Sizes are summed per direct folder first, and only those sums climb the tree.
    """
    direct = (
        listing.select(folder_of(F.col("path")).alias("folder"), "size")
        .groupBy("folder").agg(F.sum("size").alias("bytes"), F.count("*").alias("files"))
    )
    climbed = direct.select(F.explode(ancestors(F.col("folder"))).alias("Path"), "bytes", "files")
    return climbed.groupBy("Path").agg(F.sum("bytes").alias("TotalBytes"), F.sum("files").alias("FileCount"))


def table_count(listing: DataFrame, master_path: str) -> DataFrame:
    """Number of table folders directly below a path."""
    below = F.col("path").substr(F.lit(len(master_path) + 1), F.length("path"))
    tables = listing.where(F.startswith("path", F.lit(master_path)) & F.contains(below, F.lit("/")))
    return tables.agg(F.count_distinct(F.substring_index(below, "/", 1)).alias("table_count"))


# a file's stem ends in the stamp of its load, and its folder in a year, month, day or hour, or in none of them
_STAMP = r"^\d{4}_\d{2}_\d{2}_\d{2}_\d{2}$"
_STAMP_CHARS = len("yyyy_MM_dd_HH_mm")
_DATED = r"(/\d{4}(?:/\d{2}){0,3})$"
_DATED_CHARS = len("/yyyy/MM/dd/HH")


def latest_partition(listing: DataFrame, extension: str = "parquet") -> DataFrame:
    """Newest folder and file stamp per object folder, for all granularities of dated paths.

    One maximum over the date parts taken together, so the parts always belong
    to one folder. What a folder coarser than an hour leaves open comes from
    the stamp, so that layouts of several granularities in one object compare.
    Files of another extension and names without a stamp are not dated.
    """
    path, ending = F.col("path"), f".{extension}"
    name = F.substring_index("path", "/", -1)
    # patterns look at a few characters, not at whole paths
    stamp = F.right(F.left("name", F.length("name") - len(ending)), F.lit(_STAMP_CHARS))
    dated = F.regexp_extract(F.right("dir", F.lit(_DATED_CHARS)), _DATED, 1)
    hour = F.concat(F.lit("/"), F.replace(F.substring("stamp", 1, 13), F.lit("_"), F.lit("/")))
    parts = F.concat("dated", F.substring(hour, F.length("dated") + 1, F.lit(_DATED_CHARS)))
    found = (
        listing.where(path.endswith(ending) & path.contains("/")).select("path", name.alias("name"))
        .select("name", F.left("path", F.length("path") - F.length("name") - 1).alias("dir")).select("dir", stamp.alias("stamp"))
        .where(F.col("stamp").rlike(_STAMP)).select("stamp", "dir", dated.alias("dated"))
        .select(F.left("dir", F.length("dir") - F.length("dated")).alias("object_dir"), "dated", "stamp")
        .select("object_dir", F.struct(parts.alias("parts"), "stamp", "dated").alias("newest"))
    )
    newest = found.groupBy("object_dir").agg(F.max("newest").alias("newest"))
    return newest.select(
        "object_dir", F.concat("object_dir", "newest.dated").alias("latest_dir"),
        F.concat(F.lit("*"), F.col("newest.stamp"), F.lit(f".{extension}")).alias("file_wildcard"),
    )


def transformation_outputs(runs: DataFrame) -> DataFrame:
    """One expected path per name in the semicolon list of each transformation run.

    ``runs`` has FunctionName, FileTransformationName, TransformationPathGranularity and OutputUpdateDate.
    """
    named = runs.withColumn("name", F.explode(F.split("FileTransformationName", ";")))
    path = output_path_column(
        F.col("FunctionName"), F.col("name"), F.col("OutputUpdateDate"), F.col("TransformationPathGranularity")
    )
    return named.select("FunctionName", "name", path.alias("path"))


def expected_outputs(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Label every expected path ``FileFound`` or ``FileNotFound``."""
    present = listing.select("path").distinct().withColumn("present", F.lit(True))
    label = F.when(F.col("present"), "FileFound").otherwise("FileNotFound")
    return expected.join(present, "path", "left").select(*expected.columns, label.alias("status"))


def all_outputs_present(labelled: DataFrame) -> DataFrame:
    """One row: is every expected output there?"""
    missing = F.count_if(F.col("status") == "FileNotFound")
    return labelled.agg(missing.alias("missing"), (missing == 0).alias("complete"))


def members_of(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a list.

    The list is joined as it is: both sides then come straight from a shuffle,
    which is what lets adaptive execution split a hot key of ``df``.
    """
    return df.join(wanted.select(key), key, "left_semi")


def list_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Names that only one of two lists holds, and which one.

    Grouping both lists together needs one shuffle and matches null to null.
    """
    both = left.select(F.col(key), F.lit(1).alias("in_left"), F.lit(0).alias("in_right")).unionByName(
        right.select(F.col(key), F.lit(0).alias("in_left"), F.lit(1).alias("in_right"))
    )
    found = both.groupBy(key).agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    side = F.when(F.col("in_left") == 1, "left_only").otherwise("right_only")
    return found.where(F.col("in_left") != F.col("in_right")).select(key, side.alias("_merge"))
