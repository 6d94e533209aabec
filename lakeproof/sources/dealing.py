"""Deal addresses out to tasks by the work behind them.

Adaptive execution sizes partitions by the bytes of the rows. An address is a
few bytes, whatever it takes to read the file, so a shuffle of addresses would
end in one task. A stated number of partitions is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeproof.session import scratch_path

# What a driver can schedule in one stage; beyond that each task takes more.
MOST_TASKS = 50_000


def dealt_out(
    rows: DataFrame, keys: list[str], work: Column, per_task: float, enough_tasks: int = MOST_TASKS, most_per_task: float = float("inf"),
) -> DataFrame:
    """The rows on as many partitions as their summed work takes, by a hash of the keys.

    The rows are written to the shared folder first, so that whatever listed
    them runs once. Where starting a task takes longer than its work, ``enough_tasks`` take
    more than ``per_task``; there are more of them only from ``most_per_task`` on.
    """
    path = scratch_path(rows.sparkSession, "dealt")
    rows.write.parquet(path)
    kept = rows.sparkSession.read.schema(rows.schema).parquet(path)
    total = kept.agg(F.sum(work)).first()[0] or 0
    tasks = max(1, -(-total // per_task))
    if tasks > enough_tasks:
        tasks = max(enough_tasks, -(-total // most_per_task))
    return kept.repartition(int(min(tasks, MOST_TASKS)), *keys)
