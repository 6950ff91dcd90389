from candlewick.operators.bars import history, latest_bars, resample, ticks_to_bars
from candlewick.operators.decode import (
    candle_preview, candles_to_ticks, chart_bars, chart_messages, closed_candles, count_rejected, decode_candles,
    decode_json, decode_ticks, encode_json, is_heartbeat, rejected_candles, rejected_chart_bars, rejected_ticks, time_range, valid_candles,
    valid_ticks, with_symbol,
)
from candlewick.operators.indicators import (
    GOLD, Ema, GainLoss, Macd, PriceChange, Rsi, Sma, ema, gain_loss, macd, price_change, resume_indicators, rsi, sma, with_indicators,
)
from candlewick.operators.records import latest_version, narrow_records, tick_records, vwap_records
from candlewick.operators.vwap import empty_windows, encode_vwap, vwap, vwap_rows

__all__ = [
    "GOLD", "Ema", "GainLoss", "Macd", "PriceChange", "Rsi", "Sma", "candle_preview", "candles_to_ticks", "chart_bars",
    "chart_messages", "closed_candles", "count_rejected", "decode_candles", "decode_json", "decode_ticks", "ema", "empty_windows",
    "encode_json", "encode_vwap", "gain_loss", "history", "is_heartbeat", "latest_bars", "latest_version", "macd", "narrow_records",
    "price_change", "rejected_candles", "rejected_chart_bars", "rejected_ticks", "resample", "resume_indicators", "rsi", "sma", "tick_records", "ticks_to_bars", "time_range",
    "valid_candles", "valid_ticks", "vwap", "vwap_records", "vwap_rows", "with_indicators", "with_symbol",
]
