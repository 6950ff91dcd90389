"""Tables of row versions in the catalog, bucketed by the hash of a row's identity.

All versions of a row lie in one bucket, so the last one is found without a shuffle (``latest_version`` with ``BUCKET_KEY`` among
the identity). Compaction writes the rows that are left to a folder of their own and then switches each partition to it in the
catalog: whoever has begun to read goes on with the old files, whoever begins later reads the new ones, and nobody sees a gap.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from candlewick.operators.records import BUCKET_KEY, bucketed, latest_version
from candlewick.sources.catalog import _location, _quoted

#: Fixed value: the folder name of a null partition value.
_NULL = "__HIVE_DEFAULT_PARTITION__"
_IDENTITY, _BUCKETS = "versions.identity", "versions.buckets"
_BUCKET = "__bucket"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, name: str, path: str, schema: T.StructType, identity: Sequence[str], partition_by: Sequence[str],
            buckets: int) -> None:
    number = f" COMMENT '{buckets}'"
    columns = ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}{number * (f.name == BUCKET_KEY)}" for f in schema.fields)
    spark.sql(f"""CREATE TABLE {_quoted(name)} ({columns}) USING parquet
        TBLPROPERTIES ({_text(_IDENTITY)} = {_text(chr(10).join(identity))}, {_text(_BUCKETS)} = {_text(str(buckets))})
        PARTITIONED BY ({', '.join(map(_quoted_column, partition_by))})
        CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS LOCATION {_text(path)}""")


def _quoted_column(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _property(spark: SparkSession, name: str, key: str) -> str:
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").filter(F.col("key") == key).first()
    if found is None:
        raise ValueError(f"{name} is no table of versions")
    return found["value"]


def create_versions(spark: SparkSession, name: str, path: str, schema: T.StructType, identity: Sequence[str],
                    partition_by: Sequence[str], buckets: int = 64) -> None:
    """External table at ``path`` for rows of ``schema``, told apart by ``identity``, which contains the partition columns.

    ``buckets``: as many as bring a bucket of a day to a few hundred MB. A table that exists must agree and is left as it is.
    """
    if not partition_by or not set(partition_by) <= set(identity) or not set(identity) <= set(schema.names):
        raise ValueError("partition_by must name columns of identity, and identity columns of the schema")
    if BUCKET_KEY in schema.names:
        raise ValueError(f"the name {BUCKET_KEY} is taken")
    if spark.catalog.tableExists(name):
        if _property(spark, name, _IDENTITY) != "\n".join(identity) or int(_property(spark, name, _BUCKETS)) != buckets:
            raise ValueError(f"table {name} has another identity or number of buckets")
        return
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name.rsplit('.', 1)[0])}")
    fields = [f for f in schema.fields if f.name not in partition_by]
    last = [next(f for f in schema.fields if f.name == p) for p in partition_by]
    full = T.StructType([*fields, T.StructField(BUCKET_KEY, T.LongType()), *last])
    _create(spark, name, path, full, identity, partition_by, buckets)


def append_versions(rows: DataFrame, name: str) -> None:
    """Add rows to the table. Each bucket of a partition gets one file, a large one several: the rows are rebalanced by both."""
    spark = rows.sparkSession
    identity = _property(spark, name, _IDENTITY).split("\n")
    _insert(rows.withColumn(BUCKET_KEY, F.xxhash64(*identity)), name)


def _insert(keyed: DataFrame, name: str) -> None:
    spark = keyed.sparkSession
    bucket = F.pmod(F.hash(BUCKET_KEY), F.lit(int(_property(spark, name, _BUCKETS))))  # as Spark numbers buckets
    parts = [F.col(c.name) for c in spark.catalog.listColumns(name) if c.isPartition]
    spread = keyed.withColumn(_BUCKET, bucket).hint("rebalance", *parts, F.col(_BUCKET))
    spread.select(*spark.table(name).columns).write.insertInto(name)


def versions_writer(df: DataFrame, name: str, checkpoint: str, output_mode: str = "append") -> DataStreamWriter:
    """Streaming form of ``append_versions``: a batch that is repeated after a failure adds equal versions, which changes nothing."""
    return df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: append_versions(batch, name))


def latest_rows(spark: SparkSession, name: str, version: Sequence[str]) -> DataFrame:
    """The last version of every row, without a shuffle if the buckets are small. Filters on the partition columns prune the files."""
    identity, rows = _property(spark, name, _IDENTITY).split("\n"), spark.table(name)
    return latest_version(rows, bucketed(rows, identity), version).drop(BUCKET_KEY)


def _parts(spark: SparkSession, name: str) -> list[str]:
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect()]


def _spec(part: str) -> str:
    """``a=1/b=x`` as SQL."""
    pairs = [folder.split("=", 1) for folder in part.split("/")]
    return ", ".join(f"{_quoted_column(unquote(key))} = {_text(unquote(value))}" for key, value in pairs)


def _place(spark: SparkSession, name: str, part: str) -> str:
    """Folder of a partition."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)} PARTITION ({_spec(part)})").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _switch(spark: SparkSession, name: str, part: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(name)} PARTITION ({_spec(part)}) SET LOCATION {_text(folder)}")


def compact_versions(spark: SparkSession, name: str, closed: str, latest: Callable[[DataFrame], DataFrame]) -> None:
    """Leave the rows of ``latest`` in the partitions for which ``closed``, a condition on the partition columns, holds.

    ``latest`` maps stored rows to the ones that stay, columns unchanged. For partitions that nothing is appended to any more. A
    run that dies leaves each partition either old or new, and can be repeated. Old files stay for those who still read
    them, until ``drop_unused``. Partitions with a null value are left as they are.
    """
    source = spark.table(name)
    fields = {field.name: field for field in source.schema.fields}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    rows = latest(source.filter(closed).dropna(subset=parts)).select(*source.columns)
    number = uuid.uuid4().hex
    folder = f"{_location(spark, _quoted(name))}.compacted/{number}"
    aside = f"{name}_compacted_{number}"
    _create(spark, aside, folder, T.StructType(list(fields.values())), _property(spark, name, _IDENTITY).split("\n"), parts,
            int(_property(spark, name, _BUCKETS)))
    try:
        _insert(rows, aside)
        for part in _parts(spark, aside):  # as many as there are closed partitions
            _switch(spark, name, part, f"{folder}/{part}")
    finally:
        spark.sql(f"DROP TABLE {_quoted(aside)}")  # its files stay
        spark.catalog.refreshTable(name)


def drop_unused(spark: SparkSession, name: str, older_than_hours: float = 24.0) -> int:
    """Delete the partition folders that the table no longer refers to and that are older than any reader; how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(_location(spark, _quoted(name)))
    files = root.getFileSystem(conf)

    def full(path: str) -> str:
        return files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toString()

    known = [part for part in _parts(spark, name) if f"={_NULL}" not in part]
    used = {full(_place(spark, name, part)) for part in known}
    compacted = jvm.org.apache.hadoop.fs.Path(root.toString() + ".compacted")
    roots = [root, *[s.getPath() for s in files.listStatus(compacted)]] if files.exists(compacted) else [root]
    limit, dropped = (time.time() - 3600 * older_than_hours) * 1000, 0
    for part in known:
        for base in roots:
            folder = jvm.org.apache.hadoop.fs.Path(f"{base.toString()}/{part}")
            if full(folder.toString()) not in used and files.exists(folder) and files.getFileStatus(folder).getModificationTime() <= limit:
                dropped += files.delete(folder, True)
    return dropped
