"""Starting and awaiting streaming queries."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, name: str | None = None, every: str | None = None,
          available_now: bool = False) -> StreamingQuery:
    """Start a query: back to back by default, at an interval, or once over all data that is there."""
    if every and available_now:
        raise ValueError("give either an interval or available_now")
    if name:
        writer = writer.queryName(name)
    if every:
        writer = writer.trigger(processingTime=every)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run(writer: DataStreamWriter, **options) -> StreamingQuery:
    """Start a query and wait for its end."""
    query = start(writer, **options)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped for lying behind the watermark, over the progress reports at hand."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for state in progress["stateOperators"])
