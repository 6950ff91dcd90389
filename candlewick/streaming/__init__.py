from candlewick.streaming.jobs import start_heartbeats, start_records, start_ticks, start_vwap
from candlewick.streaming.lifecycle import late_rows, run, start
from candlewick.streaming.sinks import append_writer, compact_versioned, parquet_writer, read_versioned, versioned_writer
from candlewick.streaming.state import open_windows

__all__ = ["append_writer", "compact_versioned", "late_rows", "open_windows", "parquet_writer", "read_versioned", "run", "start", "start_heartbeats", "start_records",
           "start_ticks", "start_vwap", "versioned_writer"]
