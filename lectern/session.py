"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Temporary folders of local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def build_session(master: str = "local[8]", app: str = "lectern", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster supplies its own."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster a
    machine-local folder would be lost with the machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        # A running session does not take this setting, so the folder is kept here.
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_DIRS:
            _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        named = _LOCAL_DIRS[application]
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


# Rows of a task in steps that keep several copies of each: a distinct, a sort and a window come to about 1 KB a row.
ROWS_PER_TASK = 200_000


def tasks_for(table: DataFrame, times: float = 1) -> int:
    """Tasks for ``times`` the rows of a written table, so that a task's memory doesn't grow with the table.

    Adaptive execution sizes tasks by compressed bytes, and of narrow rows with few values tens of millions are a few megabytes.
    """
    return tasks_of(table.count() * times)


def tasks_of(rows: float) -> int:
    """Tasks for so many rows, see ``tasks_for``."""
    return max(1, math.ceil(rows / ROWS_PER_TASK))


# Shuffle files of a query go when it ends, else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run to their end inside leave no shuffle files."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Later steps read the columns they need from it instead of computing it again, and a lost
    executor costs no more than that. What was shuffled to make the table is removed once it stands.
    """
    path = new_folder(df.sparkSession, "step")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
