"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeproof.session import scratch_path

#: Rows of a record batch that a task works on at a time, so that its results stay small.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that reach Python at a time while a table is staged: texts are long, and both sides hold a batch.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, tasks pass rows to Python in batches of at most ``BATCH_ROWS``."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    Work behind it is done once, and a lost executor costs no recomputation of it.
    """
    path = scratch_path(frame.sparkSession, label)
    with small_batches(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks for rows whose work says more than their bytes: what the cluster sets for a shuffle before any are merged."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first or 0))


#: Rows of one or two numbers up to which a table is broadcast, a few dozen MB.
BROADCAST_ROWS = 500_000


def sized_join(large: DataFrame, small: DataFrame, keys: str | list[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """A join that broadcasts the short rows of ``small`` if they are counted to be few, and shuffles else."""
    small = staged(small, "sized")
    return large.join(F.broadcast(small) if small.count() <= most else small, keys, how)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).alias("text")


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether a row is kept from training: by the crc32 of its key as text. A null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % modulus == remainder, F.lit(True))


def training_sample(documents: DataFrame, labels: DataFrame, label: str, kept_out: Column, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of each class that aren't held out.

    The rows are those with the smallest hashes of their ids, so the choice does not
    depend on how the tables are partitioned. Conflicting labels of one document count
    as 1, null labels and null ids not at all. Only the ids pass through one task; they
    are as many as the parameter says, which is also what bounds the broadcast.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
        .where(~kept_out).groupBy("doc_id").agg(F.max("label").alias("label"))
        .withColumn("drawn", F.xxhash64("doc_id"))
    )
    chosen = [known.where(F.col("label") == value).orderBy("drawn", "doc_id").limit(per_class) for value in (0, 1)]
    return documents.select("doc_id", text_of()).join(
        F.broadcast(chosen[0].unionByName(chosen[1]).select("doc_id", "label")), "doc_id"
    )


def fit_logistic(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one value by Newton steps, with a small ridge."""
    design = np.stack([values, np.ones_like(values)], axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (labels - p) - beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        beta = beta + np.linalg.solve(hessian, gradient)
    return float(beta[0]), float(beta[1])
