"""Parquet tables: scans with row ordinals, staged tables, size checks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Compressed Parquet may take ten times as much in memory.
BROADCAST_LIMIT = 16 * 1024 * 1024

def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``.

    Only a session whose tasks run in this very process may go without it; it is
    then given a temporary folder that is removed at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    folder = tempfile.mkdtemp(prefix="riskmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; a path that is not there yet is an empty one, any other problem is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A new folder for the tables of one job, deleted when the job ends, whether it succeeds or not."""
    folder = new_folder(spark, label)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    partitions: int | None = None,
    hex_columns: tuple[str, ...] = (),
) -> DataFrame:
    """Write once, read back: later plans start from files and survive lost executors.

    With ``partition_by`` the rows are range-partitioned on those columns plus
    ``sort_by`` first. A plain hash on the partition column would send a hot
    partition to one task; the range split spreads it over many files, each
    sorted so that Parquet row groups can be skipped. ``hex_columns`` (upper-case
    hex) travel as bytes.
    """
    spark = df.sparkSession
    layout = [*partition_by, *sort_by]
    columns = df.columns
    if layout:
        df = df.withColumns({c: F.unhex(c) for c in hex_columns})
        # Without a fixed count, adaptive execution may merge small partitions.
        df = df.repartitionByRange(partitions, *layout) if partitions else df.repartitionByRange(*layout)
        df = df.sortWithinPartitions(*layout)
        df = df.withColumns({c: F.hex(c) for c in hex_columns}).select(*columns)
    # Hashes in hex: zstd stores them in half the bytes, snappy does not.
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/riskmart-{label}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame) -> DataFrame:
    """Splits the rows of a scan with fewer tasks than cores before CPU-heavy work; a larger scan is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_with_ordinals(spark: SparkSession, path: str, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 1 in file order, without a shuffle of the rows.

    Parquet carries each row's position in its file. The first numbers of the
    files, one row each, are written and read back under their true size for the
    checked broadcast.
    """
    df = spark.read.parquet(path)
    columns = df.columns
    df = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    counts = df.groupBy("_path").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_path", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    starts = write_table(starts, new_folder(spark, "file-starts"))
    return df.join(broadcast_if_small(starts), "_path").select(*columns, (F.col("_start") + F.col("_row") + 1).alias(name))


def hash_side(df: DataFrame) -> DataFrame:
    """The unique side of a shuffle join as hash tables by partition: the larger side is neither sorted nor spilled."""
    return df.hint("shuffle_hash")


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only behind a size check.

    Beyond the limit the join stays a shuffle join, where adaptive execution
    splits skewed keys.
    """
    return F.broadcast(df) if planned_bytes(df) <= limit else df
