"""Helpers that several operators share: staged tables, remainders of ids, words, Arrow maps."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.session import scratch_path

#: Most rows of a lookup table that are broadcast.
BROADCAST_ROWS = 200_000

#: Folders written by ``staged`` and not yet released.
_STAGED: list[str] = []


def stage(df: DataFrame, name: str, *parted_by: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back: a cut of lineage that survives lost executors. Also gives the path.
    With ``parted_by`` there is a folder for each value of these columns, of which a filter reads only what it needs; ``options`` are
    those of the Parquet writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).partitionBy(*parted_by).parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str, *parted_by: str, **options: str) -> DataFrame:
    return stage(df, name, *parted_by, **options)[0]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete all staged tables; call it when the results that read them have been written."""
    while _STAGED:
        _delete(spark, _STAGED.pop())


def release_path(spark: SparkSession, path: str) -> None:
    """Delete one staged table that nothing will read again."""
    _STAGED.remove(path)
    _delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; -1 for a null id, which so belongs to no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n), F.lit(-1))


def joined_by_weight(rows: DataFrame, lookup: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, a staged table that holds each key once and in ``weight`` how many of ``rows`` have it.

    A lookup table of at most ``BROADCAST_ROWS`` rows is broadcast. Of a larger one only the keys with more than that part of all
    rows are, of which there are fewer than ``BROADCAST_ROWS``; the rest, in which no key is hot, is joined by shuffle.
    """
    size, total = lookup.agg(F.count("*"), F.sum(F.col(weight).cast("decimal(38,0)"))).first()
    if size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup.drop(weight)), on)
    hot = F.col(weight) > int(total) // BROADCAST_ROWS
    common, rest = F.broadcast(lookup.where(hot).drop(weight)), lookup.where(~hot).drop(weight)
    return rows.join(common, on).unionByName(rows.join(common.select(*on), on, "left_anti").join(rest, on))


def utf8(text: str = "text") -> Column:
    """The text as bytes, so that Python gets it without decoding."""
    return F.col(text).cast("binary")


def text_key(text: str = "text") -> Column:
    """128 bits that stand for the text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(utf8(text), F.lit(b""))))


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names]


def chunks(texts: list[bytes], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def batch_of(schema: pa.Schema, values: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
