"""Where jobs keep intermediate tables: the shared folder the session names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Whether shuffle files go with the end of the statement that wrote them.
REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else a folder below its warehouse.

    Every executor can reach either; a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` to the shared folder and continue from the written table.

    Plans built on it stay short, and losing an executor costs nothing that has been written. Unlike
    a checkpointed RDD, the table has a known size: a small one is broadcast without a hint.
    """
    path = scratch(frame.sparkSession, "table")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a written table has shuffled is removed once it is written, not when the driver collects garbage."""
    own = spark.conf.get(REMOVAL, "false")
    spark.conf.set(REMOVAL, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVAL, own)
