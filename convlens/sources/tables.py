"""Reading and writing the stored tables: parquet, one folder per day."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from convlens.functions.expr import ts_lit
from convlens.operators.ingest import expired

DAY = "day"
#: Buckets of a key index, and its columns.
BUCKETS = 64
INDEX = f"key_hash long, {DAY} date, bucket int"

# The columns each family of reports reads.
PATTERN_COLUMNS = [
    "click_id",
    "revenue",
    "payout",
    "custom_var_3",
    "country_code",
    "device",
    "os",
    "browser",
    "isp",
    "connection_type",
    "postback_timestamp",
]


def with_arrival(files: DataFrame) -> DataFrame:
    """Text rows with ``arrival``: when their file was written, its name, and where they stand in it.

    Only the file itself can tell: Spark hands out files by size, not by age.
    """
    place = [f"_metadata.{c}" for c in ("file_modification_time", "file_path", "file_block_start")]
    return files.select("value", F.struct(*place).alias("arrival"))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON lines as text, so that the original row can be kept, with their ``arrival``."""
    return with_arrival(spark.read.text(path))


def scan_projected(
    conversions: DataFrame,
    as_of: datetime,
    *,
    days: int = 30,
    columns: list[str] = PATTERN_COLUMNS,
) -> DataFrame:
    """Only the needed columns of the conversions since ``as_of - days`` (inclusive).

    On a stored table the bound holds for the day folders too, and older ones are not opened.
    """
    since = as_of - timedelta(days=days)
    kept = conversions.filter(F.col("postback_timestamp") >= ts_lit(since))
    if DAY in conversions.columns:
        kept = kept.filter(F.col(DAY) >= F.lit(since.date()))
    return kept.select(*columns)


def located(spark: SparkSession, path: str):
    """A path as the file system knows it, and that file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def table_exists(spark: SparkSession, path: str) -> bool:
    files, location = located(spark, path)
    return files.exists(location)


def delete_path(spark: SparkSession, path: str) -> None:
    files, location = located(spark, path)
    files.delete(location, True)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table by its declared schema: no file is opened to infer one."""
    return spark.read.schema(StructType([*schema.fields, StructField(DAY, DateType())])).parquet(
        path
    )


def write_table(frame: DataFrame, path: str, ts: str) -> None:
    frame.withColumn(DAY, F.col(ts).cast("date")).write.mode("append").partitionBy(DAY).parquet(
        path
    )


def overwrite_days(frame: DataFrame, path: str) -> None:
    """Replace the day folders that ``frame`` has rows for."""
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def drop_days(spark: SparkSession, path: str, days: Iterable[date | None]) -> None:
    for day in days:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
        delete_path(spark, f"{path}/{DAY}={name}")


def of_days(days: Iterable[date | None]) -> Column:
    """Rows of these days; a literal list, which prunes folders."""
    dated = [d for d in days if d is not None]
    inside = F.col(DAY).isin(dated) if dated else F.lit(False)
    return inside | F.col(DAY).isNull() if None in days else inside


# --- where keys are stored -------------------------------------------------------------------


def _index_folder(path: str) -> str:
    return f"{path}_keys"


def _pairs(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """The distinct key hashes of rows with their buckets, beside ``more`` columns."""
    key = F.xxhash64(*keys)
    bucket = F.pmod(key, F.lit(BUCKETS)).cast("int").alias("bucket")
    return rows.select(key.alias("key_hash"), *more, bucket).distinct()


def _generation(spark: SparkSession, path: str) -> int:
    files, pattern = located(spark, f"{_index_folder(path)}/gen=*")
    found = files.globStatus(pattern) or []
    return max((int(f.getPath().getName().split("=")[1]) for f in found), default=0)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(key_hash, day, bucket)``: the days under which a table holds, or has held, a key."""
    return spark.read.schema(INDEX).parquet(f"{_index_folder(path)}/gen={_generation(spark, path)}")


def rebuild_index(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> None:
    """Index a stored table anew from its key columns, and forget what has expired.

    The new index takes the old one's place when it is whole.
    """
    now = _generation(spark, path)
    folder = _index_folder(path)
    pairs = _pairs(read_table(spark, path, schema), keys, DAY)
    pairs.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/building")
    files, building = located(spark, f"{folder}/building")
    files.rename(building, located(spark, f"{folder}/gen={now + 1}")[1])
    if now:
        delete_path(spark, f"{folder}/gen={now}")


def touched_index(spark: SparkSession, path: str, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The index's entries for the keys of a batch; only the buckets that these fall into are read."""
    own = _pairs(batch, keys)
    buckets = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # BUCKETS at most
    index = read_index(spark, path).filter(F.col("bucket").isin(buckets) if buckets else F.lit(False))
    return index.join(own.select("key_hash"), "key_hash", "left_semi")


def _extend_index(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], touched: DataFrame | None
) -> None:
    """Add a batch's keys and days to the index; ``touched`` are its entries for these keys."""
    new = _pairs(batch, keys, DAY)
    if touched is not None:
        same = F.expr(f"n.key_hash = k.key_hash and n.{DAY} <=> k.{DAY}")
        new = new.alias("n").join(touched.alias("k"), same, "left_anti")
    target = f"{_index_folder(path)}/gen={max(1, _generation(spark, path))}"
    new.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(target)  # one file per bucket


def upsert_table(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: StructType,
    keys: list[str],
    ts: str,
    *,
    noted: Callable[[DataFrame], None] | None = None,
    written: bool = False,
) -> int:
    """Merge a de-duplicated batch into a stored table, rewriting only the days it touches; returns its rows.

    A row is stored under the day of its time. Where the time is one of the keys, a key's day is
    known from the batch. Elsewhere an index says under which days a key is stored: a side table in
    buckets by key hash, of which a merge reads those that its keys fall into, and no column of the
    table itself. It is extended before rows are written, so it names a day too many after a lost
    run, never one too few. A row whose time was corrected moves to its new day.

    Merging the same batch again changes nothing, and completes a merge that was lost half-way.
    ``noted`` is given the times (column ``ts``) of the rows that come in and of those they replace, before
    anything is changed. ``written``: the batch is read from written tables, so that each of the steps below
    reads the few columns it needs from there; another batch is held while they run.
    """
    names = schema.fieldNames()
    batch = batch.select(*names).withColumn(DAY, F.col(ts).cast("date"))
    # Read several times below; what a lost executor held is read from the source again.
    batch = batch if written else batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _merge(spark, batch, path, schema, keys, ts, noted)
    finally:
        if not written:
            batch.unpersist()


def _merge(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: StructType,
    keys: list[str],
    ts: str,
    noted: Callable[[DataFrame], None] | None,
) -> int:
    names = schema.fieldNames()
    counts = {r[DAY]: r["count"] for r in batch.groupBy(DAY).count().collect()}  # one value per day of data
    own = set(counts)
    if not own and table_exists(spark, path):
        return 0
    indexed, exists = ts not in keys, table_exists(spark, path)
    if indexed and exists and not _generation(spark, path):
        rebuild_index(spark, path, schema, keys)
    touched = None
    if indexed and _generation(spark, path):
        touched = touched_index(spark, path, batch, keys).persist(StorageLevel.MEMORY_AND_DISK)
    held: set[date | None] = set()
    if exists:
        held = {r[DAY] for r in touched.select(DAY).distinct().collect()} if indexed else own
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"t.{key}").eqNullSafe(F.col(f"b.{key}"))
    new = batch.alias("b")
    old = read_table(spark, path, schema).filter(of_days(own | held)).alias("t") if held else None
    if noted is not None:
        times = batch.select(F.col(ts).alias("ts"))
        if old is not None:
            times = times.unionByName(old.join(new, same, "left_semi").select(F.col(ts).alias("ts")))
        noted(times)
    if indexed:
        _extend_index(spark, path, batch, keys, touched)
    if touched is not None:
        touched.unpersist()
    if old is None:
        batch.write.mode("append").partitionBy(DAY).parquet(path)
    else:
        rest = old.join(new, same, "left_anti")
        left = held - own  # days that rows only leave
        still = {r[DAY] for r in rest.filter(of_days(left)).select(DAY).distinct().collect()} if left else set()
        overwrite_days(rest.select(*names, DAY).unionByName(batch), path)
        drop_days(spark, path, left - still)
    return sum(counts.values())


def expire_table(
    spark: SparkSession, path: str, schema: StructType, ts: str, as_of: datetime, *, days: int = 90
) -> int:
    """Delete a stored table's rows past the retention; returns how many.

    Only days up to the one that the retention ends in are opened. The days before it lose their folder, and
    that one is rewritten. Rows without a time are under no day, and never expire.
    """
    if not table_exists(spark, path):
        return 0
    last = (as_of - timedelta(days=days)).date()
    table = read_table(spark, path, schema).filter(F.col(DAY) <= F.lit(last))
    per_day = (
        table.groupBy(DAY)
        .agg(F.count_if(expired(ts, as_of, days)).alias("gone"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("gone") > 0)
        .collect()  # one row per day of data
    )
    partly = [r[DAY] for r in per_day if r["gone"] < r["n"]]
    if partly:
        overwrite_days(table.filter(of_days(partly)).filter(~expired(ts, as_of, days)), path)
    drop_days(spark, path, [r[DAY] for r in per_day if r["gone"] == r["n"]])
    return sum(r["gone"] for r in per_day)


FORMATS = ("parquet", "csv", "json")
#: Times in text files keep their microseconds.
TEXT_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
}


def write_report(
    report: DataFrame, path: str, fmt: str = "parquet", *, by: list[str] | None = None, order: list[str] | None = None
) -> None:
    """A report as parquet, csv or json files; another format is an error.

    ``by``: columns that become folders; ``order``: columns by which the rows of a file are sorted.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown report format {fmt!r}; known are {', '.join(FORMATS)}")
    rows = report.repartition(*by) if by else report
    rows = rows.sortWithinPartitions(*(by or []), *order) if order else rows
    writer = rows.write.mode("overwrite").format(fmt).options(**TEXT_TIMES if fmt != "parquet" else {})
    if fmt == "csv":
        writer = writer.option("header", True)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)


def read_report(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A written report by its schema, with the columns in its order."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown report format {fmt!r}; known are {', '.join(FORMATS)}")
    reader = spark.read.schema(schema).format(fmt).options(**TEXT_TIMES if fmt != "parquet" else {})
    if fmt == "csv":  # NULL is written as nothing and an empty text as two quotes; only the former is NULL
        reader = reader.options(header=True, emptyValue="", nullValue="\u0000")
    return reader.load(path).select(*schema.fieldNames())
