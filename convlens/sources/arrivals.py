"""Which files of a raw folder are new: their listing against a log of what has been read.

A file is known by its path, the time it was written and its size, so that a late file is new whatever
its age, and so is one that was written again. The listing opens no file, and only new files are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.sources.tables import table_exists, with_arrival

FILE = ["file_path", "modified", "size"]
LOG = "feed string, load long, file_path string, modified timestamp, size long"
#: New files that are handed to the reader by name. More than that are found again among the
#: folder's files by the times between which they were written, and by their names.
NAMED = 10_000


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, file_path, modified, size)`` of the files in a folder, from their metadata alone."""
    if not table_exists(spark, folder):
        return spark.createDataFrame([], "path string, file_path string, modified timestamp, size long")
    meta = {"file_path": "file_path", "modified": "file_modification_time", "size": "file_size"}
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", *[F.col(f"_metadata.{m}").alias(name) for name, m in meta.items()])
    )


def unseen(spark: SparkSession, folder: str, log: str, feed: str, load: int) -> DataFrame:
    """The files of a folder that no load before ``load`` has read.

    Entries of ``load`` itself come from a run that was lost before it ended, and do not count.
    """
    files = listing(spark, folder)
    if not table_exists(spark, log):
        return files
    seen = spark.read.schema(LOG).parquet(log).filter((F.col("feed") == feed) & (F.col("load") < load))
    return files.join(seen.select(*FILE).distinct(), FILE, "left_anti")


def remember(files: DataFrame, log: str, feed: str, load: int) -> None:
    files.select(F.lit(feed).alias("feed"), F.lit(load).cast("long").alias("load"), *FILE).write.mode("append").parquet(log)


def read_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The text rows of ``files`` (a written table) with their ``arrival``; other files are not opened."""
    span = files.agg(F.min("modified"), F.max("modified"), F.count(F.lit(1))).first()
    if span[2] == 0:
        return with_arrival(spark.read.text(folder).limit(0)) if table_exists(spark, folder) else _nothing(spark)
    if span[2] <= NAMED:
        return with_arrival(spark.read.text([r["path"] for r in files.select("path").collect()]))
    bounds = files.agg(F.min("modified").alias("first"), F.max("modified").alias("last"))
    first, last = bounds.select(F.unix_micros("first"), F.unix_micros("last")).first()
    written = F.col("_metadata.file_modification_time").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)))
    rows = with_arrival(spark.read.text(folder).filter(written))
    names = files.select(F.col("file_path").alias("own"))
    return rows.join(names, F.col("arrival.file_path") == F.col("own"), "left_semi")


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "value string, arrival struct<file_modification_time: timestamp, file_path: string, file_block_start: bigint>",
    )
