"""Bar tables as files: CSV (bronze) and Parquet (silver, gold), partitioned by year and month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions import instant
from candlewick.session import require_utc, scratch_path

PARTITION = ("year", "month")
SORT = ("symbol", "datetime")
_BAD_LINE, _REASON, _FILE = "__bad_line", "__reason", "__file"


def with_year_month(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """``year`` and ``month`` of the time as last columns, replacing any others of that name."""
    return df.drop(*PARTITION).withColumns({"year": F.year(time_col), "month": F.month(time_col)})


def _bronze_lines(spark: SparkSession, path: str, has_symbol: bool) -> DataFrame:
    """All lines below ``path`` with the bronze schema; what a line cannot give is null, and then the line itself is kept."""
    bar = schemas.BRONZE_SYMBOL_BAR if has_symbol else schemas.BRONZE_BAR
    lines = (
        spark.read.schema(T.StructType([*bar.fields, T.StructField(_BAD_LINE, T.StringType()), *schemas.PARTITION_FIELDS]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _BAD_LINE)
        .option("columnPruning", False)  # a line is judged by all its fields, whatever columns a query asks for
        .csv(path)
    )
    reason = (F.when(F.col(_BAD_LINE).isNotNull(), "malformed").when(F.col("datetime").isNull(), "no time")
              .when(F.col("close").isNull() | F.isnan("close"), "no price"))
    return lines.withColumns({_REASON: reason, _FILE: F.col("_metadata.file_path")})


def read_bronze(spark: SparkSession, path: str, symbol: str | None = None, source_tz: str | None = None) -> DataFrame:
    """CSV bars with a header below ``year=Y/month=M`` folders, with a fixed schema and so without an inference pass.

    Lines that are no bars are left out; ``rejected_bronze`` has them. ``symbol``: for files without a symbol column, the
    symbol to put in front. ``source_tz``: zone of the times in the files; they are turned into instants, and year and month
    follow them.
    """
    bars = _bronze_lines(spark, path, symbol is None).filter(F.col(_REASON).isNull()).drop(_BAD_LINE, _REASON, _FILE)
    if symbol is not None:
        bars = bars.select(F.lit(symbol).alias("symbol"), "*")
    if source_tz is not None:
        require_utc(spark)
        bars = with_year_month(bars.withColumn("datetime", F.to_utc_timestamp("datetime", source_tz)))
    return bars


def rejected_bronze(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """The lines that ``read_bronze`` leaves out: file, text, reason (``malformed``, ``no time``, ``no price``), year, month.

    Malformed: a field that is no number or no time, or too few or too many fields. A price that is missing or not a number
    makes no bar either. Of lines that could be read the text is what was read. ``symbol``: as in ``read_bronze``.
    """
    lines = _bronze_lines(spark, path, symbol is None)
    fields = [name for name in lines.columns if name in schemas.BAR_COLUMNS]
    return lines.filter(F.col(_REASON).isNotNull()).select(
        F.col(_FILE).alias("file"), F.coalesce(_BAD_LINE, F.to_csv(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd HH:mm:ss"})).alias("text"),
        F.col(_REASON).alias("reason"), *PARTITION)


def read_bars(spark: SparkSession, path: str, start: dt.datetime | None = None, end: dt.datetime | None = None,
              time_col: str = "datetime") -> DataFrame:
    """Parquet bars with start <= time < end; only the months in question are read.

    Bounds with a zone are instants; without one they are read in the session zone. The folders are pruned by the same
    instants, two days wider on either side, so a table written under another session zone loses no row.
    """
    bars = spark.read.parquet(path)
    month = F.col("year") * 12 + F.col("month")
    slack = F.expr("INTERVAL 2 DAYS")
    if start is not None:
        begin = instant(start) - slack
        bars = bars.filter((month >= F.year(begin) * 12 + F.month(begin)) & (F.col(time_col) >= instant(start)))
    if end is not None:
        last = instant(end) + slack
        bars = bars.filter((month <= F.year(last) * 12 + F.month(last)) & (F.col(time_col) < instant(end)))
    return bars


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path`` with something in it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(found) and any(
        not status.getPath().getName().startswith(("_", ".")) for status in files.listStatus(found))


def _stored(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """The rows of a layer. A CSV layer with rejected lines in it cannot be written again without losing them."""
    return read_bronze(spark, path) if file_format == "csv" else spark.read.format(file_format).load(path)


def merged_rows(stored: DataFrame, new: DataFrame, keys: Sequence[str] = SORT) -> DataFrame:
    """``stored`` with the rows of ``new`` in place of all that have their keys (null equals null), and with its other rows added.

    Columns that one side lacks are null. Rows of ``new`` with equal keys all stay: they are for the caller to tell apart.
    """
    named = new.select(*[F.col(f"`{key}`").alias(f"__new_{key}") for key in keys]).distinct()
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"`{key}`").eqNullSafe(F.col(f"__new_{key}"))
    return stored.join(named, same, "left_anti").unionByName(new, allowMissingColumns=True)


def write_layer(df: DataFrame, path: str, file_format: str = "parquet", replace: str = "all", keys: Sequence[str] = SORT,
                **options) -> None:
    """Write below ``year=Y/month=M``, replacing ``all`` of the table, the ``months`` in ``df``, or only the ``rows`` that ``df`` has anew.

    ``rows`` merges by key: in the months of ``df`` a stored row with the ``keys`` of one in ``df`` gives way to it, and all
    others stay, those of other symbols and days too. Months that ``df`` does not touch are neither read nor written. A
    month is switched only after it has been written in full.

    The rows are rebalanced by month first: a month ends up in few files of a good size, and a month that holds most of
    the rows is split over many tasks (by adaptive execution). Files are sorted by symbol and time, so that a reader of
    one symbol or a time range skips most row groups.
    """
    if replace not in ("all", "months", "rows"):
        raise ValueError(f"replace must be 'all', 'months' or 'rows', not {replace!r}")
    if replace == "rows" and _exists(df.sparkSession, path):
        _merge_layer(df, path, file_format, keys, options)
    else:
        _write_months(df, path, file_format, replace, options)


def _write_months(df: DataFrame, path: str, file_format: str, replace: str, options: dict) -> None:
    order = [*PARTITION, *[name for name in SORT if name in df.columns]]
    rows = df.hint("rebalance", *[F.col(name) for name in PARTITION]).sortWithinPartitions(*order)
    writer = rows.write.partitionBy(*PARTITION).mode("overwrite").format(file_format).options(**options)
    writer.option("partitionOverwriteMode", "static" if replace == "all" else "dynamic").save(path)


def _merge_layer(df: DataFrame, path: str, file_format: str, keys: Sequence[str], options: dict) -> None:
    spark = df.sparkSession
    # The new rows are used three times, so they are worked out once.
    aside = scratch_path(spark, "merge")
    df.write.parquet(aside)
    new = spark.read.schema(df.schema).parquet(aside)
    number = F.col("year") * 12 + F.col("month")
    months = [row[0] for row in new.select(number.alias("m")).distinct().collect()]  # as many as the calendar has
    in_months = number.isin([m for m in months if m is not None])
    if file_format == "csv":
        bad = rejected_bronze(spark, path).filter(in_months)
        if not bad.isEmpty():
            raise ValueError(f"{path} has rejected lines in months that are merged, which would be lost: see rejected_bronze")
    stored = _stored(spark, path, file_format).filter(in_months)
    columns = [*[c for c in stored.columns if c not in PARTITION], *[c for c in new.columns if c not in stored.columns], *PARTITION]
    _write_months(merged_rows(stored, new, (*keys, *PARTITION)).select(*columns), path, file_format, "months", options)
    remove(spark, aside)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made for its own use."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_bronze(bars: DataFrame, path: str, replace: str = "all") -> None:
    """Bars to CSV files with a header, one folder per calendar month of their time. The symbol is kept."""
    columns = [name for name in schemas.BAR_COLUMNS if name in bars.columns]
    write_layer(with_year_month(bars.select(*columns)), path, "csv", replace, header=True)


def replace_parts(spark: SparkSession, rows: DataFrame, path: str, partition_by: Sequence[str], name: str) -> None:
    """Put ``rows``, read from the table at ``path`` itself, in place of the partitions they belong to.

    They are written aside in full first, to the folder from which Spark exchanges partitions, one file for each but large ones. For
    partitions that no stream writes to any more: readers of them may see a gap while the files are exchanged. Repeating it changes nothing.
    """
    spread = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
