from candlewick.sources.catalog import register_table
from candlewick.sources.files import (
    merged_rows, read_bars, read_bronze, rejected_bronze, with_year_month, write_bronze, write_layer,
)
from candlewick.sources.kafka import KafkaConfig
from candlewick.sources.versions import (
    append_versions, compact_versions, create_versions, drop_unused, latest_rows, versions_writer,
)

__all__ = ["KafkaConfig", "append_versions", "compact_versions", "create_versions", "drop_unused", "latest_rows", "merged_rows", "read_bars", "read_bronze", "register_table", "rejected_bronze", "with_year_month",
           "versions_writer", "write_bronze", "write_layer"]
