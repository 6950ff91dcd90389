"""What a streaming query holds in its state, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The VWAP windows that a query in append mode has not sent yet, with the price of the ticks so far, in message form.

    With what the query has sent they are the whole result: a window leaves the state when it is sent. ``batch_id``: as of that
    micro-batch, where the state is kept for it; by default the last one that is complete. Reads the checkpoint alone, also
    while the query runs or after it has ended. For the queries of ``start_vwap`` and ``tick_topic_to_windows``.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    names = [field.name for field in state.schema["key"].dataType.fields]
    if names[-1] != "symbol" or len(names) != 2 or len(state.schema["value"].dataType.fields) != 2:
        raise ValueError(f"the state in {checkpoint} is not that of a VWAP query")
    # The sums have equal names in the state; a cast of structs goes by position.
    rows = state.select("key.*", F.col("value").cast("struct<amount: double, volume: double>").alias("sums")).select(
        "window", "symbol", "sums.*")
    return rows.select(
        F.col("window.start").cast("string").alias("window_start"), F.col("window.end").cast("string").alias("window_end"),
        "symbol", F.try_divide("amount", "volume").alias("vwap"))
