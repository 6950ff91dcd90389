"""Streaming sinks on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from candlewick.operators.records import latest_version
from candlewick.sources.files import replace_parts

VERSION = ("generation", "batch_id")
_GENERATION = "table-generation"


def parquet_writer(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                   files: int | None = None) -> DataStreamWriter:
    """Append-only table; every row is written exactly once, also across restarts.

    ``files``: number of tasks that write a micro-batch, where the query's own number would make many small files.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def append_writer(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  partition_by: Sequence[str] = (), files: int | None = None,
                  extra: Callable[[int], dict[str, Column]] = lambda batch_id: {}) -> DataStreamWriter:
    """Append-only table without the log of ``parquet_writer``, which grows with every file ever written.

    A batch that is repeated after a failure is appended again: for rows that carry a version of their own, where the
    last one counts (``latest_version``). ``extra``: columns to add, from the number of the micro-batch.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns(extra(batch_id))
        if files is not None:
            rows = rows.repartition(files)
        rows.write.mode("append").partitionBy(*partition_by).parquet(path)

    return df.writeStream.outputMode(output_mode).foreachBatch(append).option("checkpointLocation", checkpoint)


def versioned_writer(df: DataFrame, path: str, checkpoint: str, output_mode: str = "update",
                     partition_by: Sequence[str] = (), files: int | None = None) -> DataStreamWriter:
    """Table of row versions for queries that send a row again on every change.

    Each micro-batch is appended with a version: the generation of its checkpoint and its number. Batch numbers grow within
    a checkpoint, and a new checkpoint over the same table gets a higher generation, so no clock takes part. Nothing is read
    back or rewritten while the stream runs. ``read_versioned`` picks the last version. A batch that is repeated after a failure adds
    equal rows of the same version, which changes nothing. ``compact_versioned`` keeps closed parts of the table small.
    """
    number = _generation(df.sparkSession, path, checkpoint)

    def version(batch_id: int) -> dict[str, Column]:
        return {"generation": F.lit(number).cast("long"), "batch_id": F.lit(batch_id).cast("long")}

    return append_writer(df, path, checkpoint, output_mode, partition_by, files, version)


def _generation(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The checkpoint's number for this table: kept beside its state, or one more than the table has seen."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{_GENERATION}")
    files = file.getFileSystem(conf)
    if files.exists(file):
        return int(spark.read.text(file.toString()).first()[0])
    table = jvm.org.apache.hadoop.fs.Path(path)
    held = table.getFileSystem(conf)
    filled = held.exists(table) and any(s.getPath().getName()[0] not in "_." for s in held.listStatus(table))
    last = spark.read.parquet(path).agg(F.max(VERSION[0])).first()[0] if filled else None
    number = (last or 0) + 1
    out = files.create(file, False)
    out.write(bytearray(str(number).encode()))
    out.close()
    return number


def compact_versioned(spark: SparkSession, path: str, identity: Sequence[str], partition_by: Sequence[str], closed: Column) -> None:
    """Leave one row per identity in the partitions for which ``closed`` (a condition on ``partition_by``) holds.

    Versions stay, so rows that come later still win. ``identity`` must contain the partition columns.
    """
    rows = latest_version(spark.read.parquet(path).filter(closed), identity, VERSION)
    replace_parts(spark, rows, path, partition_by, "compacted")


def read_versioned(spark: SparkSession, path: str, identity: Sequence[str]) -> DataFrame:
    """The last version of every row. Filters on partition columns that belong to ``identity`` prune the files."""
    return latest_version(spark.read.parquet(path), identity, VERSION).drop(*VERSION)
