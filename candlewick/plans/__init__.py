from candlewick.plans.medallion import add_gold_columns, bronze_to_silver, build_bronze, extend_gold, latest_stored_bars, silver_to_gold
from candlewick.plans.realtime import (
    candle_topic_to_ticks, clock_to_heartbeats, compact_record_table, compact_records, create_record_table, latest_records, rejected_messages,
    tick_topic_to_vwap_topic, tick_topic_to_windows, topics_to_records,
)

__all__ = [
    "add_gold_columns", "bronze_to_silver", "build_bronze", "candle_topic_to_ticks", "clock_to_heartbeats", "compact_record_table", "compact_records", "create_record_table",
    "extend_gold", "latest_records", "latest_stored_bars", "rejected_messages", "silver_to_gold",
    "tick_topic_to_vwap_topic", "tick_topic_to_windows", "topics_to_records",
]
