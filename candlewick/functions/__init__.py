from candlewick.functions.intervals import INTERVALS, bucket_start
from candlewick.functions.times import (
    EARLIEST, LATEST, epoch_ms_to_iso, epoch_ms_to_time, epoch_seconds_to_time, instant, iso_to_epoch_ms, now_epoch_ms, parse_time,
    usable_time,
)
from candlewick.functions.values import double_text, format_symbol, is_finite, to_double, volume_or_zero

__all__ = [
    "EARLIEST", "INTERVALS", "LATEST", "bucket_start", "double_text", "epoch_ms_to_iso", "epoch_ms_to_time",
    "epoch_seconds_to_time", "format_symbol", "instant", "is_finite", "iso_to_epoch_ms", "now_epoch_ms", "parse_time",
    "to_double", "usable_time", "volume_or_zero",
]
