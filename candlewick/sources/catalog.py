"""File trees as catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candlewick import schemas


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def _same_place(spark: SparkSession, one: str, two: str) -> bool:
    """Whether two paths name one folder, with the scheme and working folder filled in as the file system does."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (one, two)]
    return paths[0].getFileSystem(conf).makeQualified(paths[0]).equals(paths[1].getFileSystem(conf).makeQualified(paths[1]))


def register_table(spark: SparkSession, name: str, path: str, file_format: str = "parquet", replace: bool = False,
                   schema: T.StructType | None = None) -> DataFrame:
    """External table over the files at ``path``, with its partition folders; ``name`` may be ``database.table``.

    A table of that name over another folder raises ``ValueError``, or is replaced on request (its files stay). CSV files
    have a header and the bronze schema unless ``schema`` says otherwise.
    """
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name.rsplit('.', 1)[0])}")
    table = _quoted(name)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(name) and not _same_place(spark, _location(spark, table), path):
        if not replace:
            raise ValueError(f"table {name} lies at {_location(spark, table)}, not at {path}")
        spark.sql(f"DROP TABLE {table}")
    columns = parts = ""
    if file_format == "csv" and schema is None:
        schema = schemas.BRONZE_SYMBOL_BAR
        folders = [f.name for f in spark.read.option("basePath", path).text(path).schema.fields[1:]]
        schema = T.StructType([*schema.fields, *[f for f in schemas.PARTITION_FIELDS if f.name in folders]])
        parts = f" PARTITIONED BY ({', '.join(folders)})" if folders else ""
    if schema is not None:
        columns = f" ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)})"
    header = " OPTIONS (header 'true')" if file_format == "csv" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}{columns} USING {file_format}{header}{parts} LOCATION '{location}'")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)
