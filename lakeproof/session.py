"""Session defaults for local use and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "lakeproof", **conf: str) -> SparkSession:
    """A session for tests and benches. Clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders made for local masters, by application; they go when Python ends.
_FALLBACKS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be invisible to the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if spark.sparkContext.applicationId not in _FALLBACKS:
        made = _FALLBACKS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lakeproof-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return _FALLBACKS[spark.sparkContext.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the application's own part of the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/lakeproof/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged, once no result that reads it is needed any more."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
