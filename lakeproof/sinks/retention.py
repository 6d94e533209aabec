"""Find dated folders past their retention, and delete them when told to."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.sources.remote import resolve

_DATED_FOLDER = r"^(.*/\d{4}/\d{2}/\d{2})/"


def retention_candidates(
    listing: DataFrame, today: Column, days: int = 7, exact_day: bool = False
) -> DataFrame:
    """(folder, folder_date, files, bytes) of dated folders at least ``days`` old.

    ``exact_day`` takes only the folder that is exactly that old, which is what
    a daily clean-up job deletes.
    """
    folder, day = F.regexp_extract("path", _DATED_FOLDER, 1), F.substring("folder", -len("yyyy/MM/dd"), len("yyyy/MM/dd"))
    # a path that is not dated has no folder date, and so is never due
    dated = listing.select(folder.alias("folder"), "size").withColumn(
        "folder_date", F.replace(day, F.lit("/"), F.lit("-")).try_cast("date")
    )
    limit = F.date_sub(F.to_date(today), days)
    due = dated.where(F.col("folder_date") == limit if exact_day else F.col("folder_date") <= limit)
    return due.groupBy("folder", "folder_date").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def delete_folders(folders: DataFrame, dry_run: bool = True, address: str = "folder") -> DataFrame:
    """(folder, deleted). Deletes in tasks, when the result is used; a dry run deletes nothing."""
    if dry_run:
        return folders.select(F.col(address).alias("folder"), F.lit(False).alias("deleted"))

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gone = []
            for folder in batch["folder"]:
                filesystem, path = resolve(folder)
                # a task that runs again finds its folder already gone
                if filesystem.get_file_info(path).type.name == "Directory":
                    filesystem.delete_dir(path)
                gone.append((folder, True))
            yield pd.DataFrame(gone, columns=["folder", "deleted"])

    return folders.select(F.col(address).alias("folder")).mapInPandas(remove, "folder string, deleted boolean")
