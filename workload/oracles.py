"""The queries in SQL over the same tables, for a check with another engine."""

from __future__ import annotations

from candlewick.functions.intervals import CALENDAR_INTERVALS, WINDOW_INTERVALS

TICKS = """
t AS (SELECT event_type AS symbol, ts, value AS close,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, event_id FROM events)"""

STAMP = "'%Y-%m-%d %H:%M:%S'"


def _single(value: str, name: str) -> str:
    return f"CAST(CAST({value} AS REAL) AS DOUBLE) AS {name}"


def _with(select: str, *ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join([TICKS.strip(), *ctes])} {select}"


WINDOWS = """
w AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS start, symbol, max(ts) AS last_ts,
             sum(close * volume) / nullif(sum(volume), 0) AS vwap FROM t GROUP BY ALL)"""


def _vwap(where: str = "", first: str = "") -> str:
    return _with(f"""
        SELECT {first} strftime(start, {STAMP}) AS window_start,
               strftime(start + INTERVAL '5 minutes', {STAMP}) AS window_end, symbol, {_single("vwap", "vwap")}
        FROM w {where}""", WINDOWS)


# Indicators: rows numbered along the series, then frames; the running averages as a recursion over the row number.

def _numbered(partition: str = "PARTITION BY symbol") -> str:
    return f"""
n AS (SELECT *, row_number() OVER (p) AS rn, close - lag(close) OVER (p) AS diff FROM t
      WINDOW p AS ({partition} ORDER BY ts, event_id))"""


def _frames(partition: str = "PARTITION BY symbol") -> str:
    return f"""
f AS (SELECT *, avg(close) OVER (o ROWS 199 PRECEDING) AS sma200,
             avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) OVER (o ROWS 13 PRECEDING) AS up,
             avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) OVER (o ROWS 13 PRECEDING) AS down
      FROM n WINDOW o AS ({partition} ORDER BY rn))"""


RSI = "CASE WHEN down = 0 THEN 100.0 ELSE 100 - 100 / (1 + up / down) END"

AVERAGES = """
e AS (SELECT symbol, event_id, rn, close AS e50, close AS fast, close AS slow, 0.0::DOUBLE AS signal
      FROM n WHERE rn = 1
      UNION ALL
      SELECT symbol, event_id, rn, e50, fast, slow, signal + 0.2 * (fast - slow - signal)
      FROM (SELECT n.symbol, n.event_id, n.rn, e.signal,
                   e.e50 + 2.0::DOUBLE / 51 * (n.close - e.e50) AS e50,
                   e.fast + 2.0::DOUBLE / 13 * (n.close - e.fast) AS fast,
                   e.slow + 2.0::DOUBLE / 27 * (n.close - e.slow) AS slow
            FROM e JOIN n ON n.symbol = e.symbol AND n.rn = e.rn + 1))"""

# Bars.

OHLCV = """first(close ORDER BY ts, event_id) AS open, max(close) AS high, min(close) AS low,
           last(close ORDER BY ts, event_id) AS close, sum(volume) AS volume"""


def _bucket(interval: str) -> str:
    if interval in CALENDAR_INTERVALS:
        return f"date_trunc('{CALENDAR_INTERVALS[interval]}', ts)"
    seconds = {"minute": 60, "hour": 3600, "day": 86400}
    number, unit = WINDOW_INTERVALS[interval].split()
    width = int(number) * seconds[unit.rstrip("s")]
    return f"make_timestamp((epoch_us(ts) // {width}000000) * {width}000000)"


def _bars(interval: str) -> str:
    return f"b AS (SELECT symbol, {_bucket(interval)} AS bar_time, {OHLCV} FROM t GROUP BY symbol, {_bucket(interval)})"


BAR_COLUMNS = f"symbol, strftime(bar_time, {STAMP}) AS datetime, open, high, low, close, volume"


def _latest(interval: str, n: int) -> str:
    return _with(f"""SELECT {BAR_COLUMNS} FROM b
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_time DESC) <= {n}""", _bars(interval))


SHIPMENTS = """
s AS (SELECT l_returnflag AS symbol, date_trunc('day', l_shipdate)::TIMESTAMP AS bar_time,
             first(l_extendedprice ORDER BY l_shipdate, l_extendedprice) AS open, max(l_extendedprice) AS high,
             min(l_extendedprice) AS low, last(l_extendedprice ORDER BY l_shipdate, l_extendedprice) AS close,
             sum(l_quantity) AS volume
      FROM lineitem GROUP BY ALL)"""

YEAR_MONTH = "CAST(year(bar_time) AS INTEGER) AS year, CAST(month(bar_time) AS INTEGER) AS month"

SHIPMENT_TICKS = """
t AS (SELECT symbol, bar_time AS ts, close, volume, 0 AS event_id, bar_time FROM s)"""


TICK_RECORD = "'symbol=' || symbol || ';source_topic=ticks'"
VWAP_RECORD = f"""'symbol=' || symbol || ';window_start=' || strftime(start, {STAMP}) || ';window_end=' ||
    strftime(start + INTERVAL '5 minutes', {STAMP}) || ';source_topic=vwap'"""

QUOTE_ROWS = f"""
    SELECT 'quotes' AS "table", {TICK_RECORD} AS "Dimensions", 'market_metrics' AS "MeasureName",
           {_single("close", "first_value")}, {_single("volume", "second_value")},
           CAST(epoch_ms(date_trunc('second', ts)) AS VARCHAR) AS "Time"
    FROM t"""
VWAP_ROWS = f"""
    SELECT 'vwap', {VWAP_RECORD}, 'aggregated_metrics', {_single("vwap", "first_value")}, NULL,
           CAST(epoch_ms(start + INTERVAL '5 minutes') AS VARCHAR)
    FROM w WHERE vwap IS NOT NULL"""
# Ticks of one symbol within one second have the same identity.
LAST_QUOTE = "QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('second', ts) ORDER BY event_id DESC) = 1"

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
MINUTE_CLOSE = "'%Y-%m-%dT%H:%M:59Z'"

ORACLES: dict[str, str] = {
    "vwap_5m": _vwap(),
    "vwap_5m_stream_update": _vwap(),
    "vwap_5m_stream_append": _vwap(
        "WHERE start + INTERVAL '5 minutes' <= (SELECT max(date_trunc('second', ts)) FROM t) - INTERVAL '5 minutes'"),
    "vwap_open_windows": _vwap(first="""CASE WHEN start + INTERVAL '5 minutes' <= (SELECT max(date_trunc('second', ts)) FROM t)
        - INTERVAL '5 minutes' THEN 'sent' ELSE 'open' END AS state,"""),
    "vwap_encode": _vwap("WHERE vwap IS NOT NULL", "symbol AS key,"),
    "empty_windows": _with(f"SELECT strftime(start, {STAMP}) AS window_start, symbol FROM w WHERE vwap IS NULL", WINDOWS),
    "tick_decode": _with(f"""
        SELECT event_id AS "offset", symbol, strftime(ts, {STAMP}) AS event_time,
               CASE WHEN symbol <> 'error' THEN close END AS close,
               CASE WHEN symbol <> 'view' THEN volume END AS volume FROM t"""),
    "tick_filter": _with("""
        SELECT event_id AS "offset", symbol, close, volume FROM t WHERE symbol NOT IN ('error', 'view')"""),
    "tick_rejects": _with("""
        SELECT event_id AS "offset", symbol, true AS has_text FROM t WHERE event_id % 10 <= 7"""),
    "candle_rejects": _with("""
        SELECT CAST(epoch(bar_time) AS BIGINT) AS "offset", symbol, true AS has_text FROM b
        WHERE CAST(floor(close * 100) AS BIGINT) % 4 IN (1, 2)""", _bars("1")),
    "candles_many_symbols": _with(f"""
        SELECT symbol AS key, symbol, strftime(bar_time + INTERVAL '59 seconds', {STAMP}) AS event_time, close, volume
        FROM b WHERE CAST(floor(close * 100) AS BIGINT) % 4 NOT IN (1, 2)""", _bars("1")),
    "chart_rejects": _with("SELECT event_id, CAST(1 AS INTEGER) AS bar FROM t"),
    "kafka_preview": _with("""
        SELECT symbol AS key, CAST(close AS VARCHAR) AS close, event_id AS "offset", epoch_us(ts) AS timestamp_us
        FROM t"""),
    "candle_to_tick": _with(f"""
        SELECT symbol, strftime(bar_time, {MINUTE_CLOSE}) AS close_time, CAST(close AS VARCHAR) AS close,
               CAST(volume AS VARCHAR) AS volume FROM b""", _bars("1")),
    "candle_topic_to_ticks": _with(f"""
        SELECT 'ALL' AS key, 'ALL' AS symbol, strftime(bar_time + INTERVAL '59 seconds', {STAMP}) AS event_time, close, volume
        FROM b""", _bars("1")),
    "candle_preview": _with("""
        SELECT '1m' AS interval, CAST(close AS VARCHAR) AS close, CAST(volume AS VARCHAR) AS volume FROM t
        UNION ALL SELECT '1m', CAST(close AS VARCHAR), CAST(volume AS VARCHAR) FROM b""", _bars("1")),
    "chart_parse": _with(f"SELECT {BAR_COLUMNS} FROM b", _bars("1D")),
    "chart_messages": _with("""
        SELECT event_id, symbol || '_update' AS method,
               '["cs_1","s' || event_id || '","={\\"symbol\\":\\"' || symbol || '\\"}"]' AS params
        FROM t WHERE symbol <> 'error'"""),
    "symbol_format": _with("""
        SELECT event_id, CASE WHEN symbol = 'purchase' THEN 'OTHER:purchase'
                              WHEN CAST(volume AS INTEGER) % 2 = 0
                              THEN 'EX:' || symbol || CAST(CAST(volume AS INTEGER) AS VARCHAR) || '!'
                              ELSE 'EX:' || symbol END AS name
        FROM t"""),
    "time_range": _with("""
        SELECT 'ALL' AS symbol, event_id, close, volume FROM t
        WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20 06:00:00'"""),
    "sma_min_periods": _with(f"""
        SELECT m.event_id, m.symbol, {_single("CASE WHEN m.rn >= 20 THEN sma20 END", "sma20")},
               {_single("CASE WHEN m.rn >= 30 THEN e50 END", "ema50")},
               {_single(f"CASE WHEN m.rn >= 15 THEN {RSI} END", "rsi14")}
        FROM (SELECT *, avg(close) OVER (PARTITION BY symbol ORDER BY rn ROWS 19 PRECEDING) AS sma20 FROM f) m
        JOIN e USING (symbol, rn)""", _numbered(), _frames(), AVERAGES, recursive=True),
    "gold_guard": _with(f"""
        SELECT f.event_id, f.symbol, -2.0::DOUBLE AS signal_line, -1.0::DOUBLE AS sma200, {_single("e50", "ema50")},
               {_single(RSI, "rsi14")}, CAST(1 AS INTEGER) AS taken
        FROM f JOIN e USING (symbol, rn)""", _numbered(), _frames(), AVERAGES, recursive=True),
    "sma_200": _with(f"SELECT event_id, symbol, {_single('sma200', 'sma200')} FROM f", _numbered(), _frames()),
    "price_change": _with("SELECT event_id, symbol, round(diff, 6) AS price_change FROM n", _numbered()),
    "gain_loss": _with("""
        SELECT event_id, symbol, round(CASE WHEN diff > 0 THEN diff ELSE 0 END, 6) AS gain,
               round(CASE WHEN diff < 0 THEN -diff ELSE 0 END, 6) AS loss FROM n""", _numbered()),
    "rsi_14": _with(f"SELECT event_id, symbol, {_single(RSI, 'rsi14')} FROM f", _numbered(), _frames()),
    "ema_50": _with(f"SELECT event_id, symbol, {_single('e50', 'ema50')} FROM e", _numbered(), AVERAGES, recursive=True),
    "macd": _with("""
        SELECT event_id, symbol, round(fast - slow, 6) AS macd_line, round(signal, 6) AS signal_line,
               round(fast - slow - signal, 6) AS macd_histogram FROM e""", _numbered(), AVERAGES, recursive=True),
    "gold": _with(f"""
        SELECT event_id, f.symbol, {_single("sma200", "sma200")}, {_single("e50", "ema50")}, {_single(RSI, "rsi14")},
               round(fast - slow, 6) AS macd_line, round(signal, 6) AS signal_line,
               round(fast - slow - signal, 6) AS macd_histogram
        FROM f JOIN e USING (event_id)""", _numbered(), _frames(), AVERAGES, recursive=True),
    "one_series": _with(f"SELECT event_id, {_single('sma200', 'sma200')}, {_single(RSI, 'rsi14')} FROM f",
                        _numbered(""), _frames("")),
    "resample_1h_to_1d": _with(f"SELECT {BAR_COLUMNS} FROM b", _bars("1D")),
    "latest_bars_10": _latest("1H", 10),
    "latest_bars_1516": _latest("5", 1516),
    "history": _with(f"""
        SELECT {BAR_COLUMNS} FROM b WHERE symbol = 'click' ORDER BY bar_time DESC LIMIT 20""", _bars("4H")),
    "medallion_silver": f"WITH {SHIPMENTS} SELECT {BAR_COLUMNS}, {YEAR_MONTH} FROM s",
    "latest_silver_bars": f"""WITH {SHIPMENTS}
        SELECT {BAR_COLUMNS}, {YEAR_MONTH} FROM s WHERE symbol <> 'N' OR year(bar_time) < 1996
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_time DESC) <= 40""",
    "bars_range": f"""WITH {SHIPMENTS} SELECT {BAR_COLUMNS}, {YEAR_MONTH} FROM s
        WHERE bar_time >= TIMESTAMP '1995-01-31 22:00:00' AND bar_time < TIMESTAMP '1996-04-01 03:30:00'""",
    "medallion_replace_months": f"""WITH {SHIPMENTS}
        SELECT * REPLACE (CASE WHEN year IN (1995, 1996) THEN volume * 2 ELSE volume END AS volume)
        FROM (SELECT {BAR_COLUMNS}, {YEAR_MONTH} FROM s)""",
    "medallion_upsert": f"""WITH {SHIPMENTS},
        m AS (SELECT * REPLACE (CASE WHEN symbol = 'R' AND year(bar_time) = 1995 AND day(bar_time) <= 15 THEN volume * 2
                                ELSE volume END AS volume) FROM s)
        SELECT layer, {BAR_COLUMNS}, {YEAR_MONTH} FROM m, (VALUES ('bronze'), ('silver')) AS l(layer)""",
    "bronze_rejects": f"""WITH {SHIPMENTS}
        SELECT CASE WHEN day(bar_time) IN (3, 5, 8) THEN 'malformed' WHEN day(bar_time) = 4 THEN 'no time'
                    WHEN day(bar_time) IN (6, 7) THEN 'no price' ELSE 'bar' END AS reason, {YEAR_MONTH}, count(*) AS lines
        FROM s GROUP BY ALL""",
    "medallion_gold": f"""WITH RECURSIVE {SHIPMENTS}, {SHIPMENT_TICKS}, {_numbered()}, {_frames()},
        e AS (SELECT symbol, bar_time, rn, close AS e50, close AS fast, close AS slow, 0.0::DOUBLE AS signal
              FROM n WHERE rn = 1
              UNION ALL
              SELECT symbol, bar_time, rn, e50, fast, slow, signal + 0.2 * (fast - slow - signal)
              FROM (SELECT n.symbol, n.bar_time, n.rn, e.signal,
                           e.e50 + 2.0::DOUBLE / 51 * (n.close - e.e50) AS e50,
                           e.fast + 2.0::DOUBLE / 13 * (n.close - e.fast) AS fast,
                           e.slow + 2.0::DOUBLE / 27 * (n.close - e.slow) AS slow
                    FROM e JOIN n ON n.symbol = e.symbol AND n.rn = e.rn + 1))
        SELECT f.symbol, strftime(f.bar_time, {STAMP}) AS datetime, f.close, {_single("sma200", "sma200")},
               {_single("e50", "ema50")}, {_single(RSI, "rsi14")}, round(fast - slow, 4) AS macd_line,
               round(signal, 4) AS signal_line, round(fast - slow - signal, 4) AS macd_histogram,
               CAST(year(f.bar_time) AS INTEGER) AS year, CAST(month(f.bar_time) AS INTEGER) AS month
        FROM f JOIN e ON f.symbol = e.symbol AND f.rn = e.rn""",
    "month_partitions": f"WITH {SHIPMENTS} SELECT {YEAR_MONTH}, count(*) AS bars FROM s GROUP BY ALL",
    "catalog_table": f"""WITH {SHIPMENTS}
        SELECT symbol, CAST(year(bar_time) AS INTEGER) AS year, count(*) AS bars, max(high) AS high FROM s GROUP BY ALL""",
    "bronze_from_charts": f"""WITH {SHIPMENTS}
        SELECT 'EX:' || symbol AS symbol, strftime(bar_time, {STAMP}) AS datetime, open, high, low, close, volume, {YEAR_MONTH}
        FROM s""",
    "wide_tick_records": _with(f"""
        SELECT {TICK_RECORD} AS "Dimensions", 'market_metrics' AS "MeasureName",
               'close_price=' || CAST(close AS VARCHAR) || ';trade_volume=' || CAST(volume AS VARCHAR) AS "MeasureValues",
               CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "Time", event_id AS "Version" FROM t"""),
    "wide_vwap_records": _with(f"""
        SELECT {VWAP_RECORD} AS "Dimensions", 'aggregated_metrics' AS "MeasureName", {_single("vwap", '"MeasureValues"')},
               CAST(epoch_ms(start + INTERVAL '5 minutes') AS VARCHAR) AS "Time", CAST(1 AS BIGINT) AS "Version"
        FROM w WHERE vwap IS NOT NULL""", WINDOWS),
    "narrow_records": _with(f"""
        SELECT {TICK_RECORD} AS "Dimensions", m AS "MeasureName",
               CAST(CASE m WHEN 'close' THEN close ELSE volume END AS VARCHAR) AS "MeasureValue",
               'DOUBLE' AS "MeasureValueType", CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "Time", 'MILLISECONDS' AS "TimeUnit",
               event_id AS "Version"
        FROM t CROSS JOIN (VALUES ('close'), ('volume')) AS measures (m)"""),
    "latest_version": _with(f"""
        SELECT symbol, strftime(date_trunc('hour', ts), {STAMP}) AS hour, arg_max(close, event_id) AS close,
               arg_max(volume, event_id) AS volume, max(event_id) AS "Version" FROM t GROUP BY ALL"""),
    "topics_to_records": _with(f"{QUOTE_ROWS} UNION ALL {VWAP_ROWS}", WINDOWS),
    "records_stream": _with(f"({QUOTE_ROWS} {LAST_QUOTE}) UNION ALL {VWAP_ROWS}", WINDOWS),
    "records_compacted": _with(f"({QUOTE_ROWS} {LAST_QUOTE}) UNION ALL {VWAP_ROWS}", WINDOWS),
    "vwap_late_restart": _vwap(),
    "vwap_heartbeat": _vwap(),
    "rejected_messages": _with(f"""
        SELECT 'vwap' AS topic, symbol, strftime(start, {STAMP}) AS window_start FROM w WHERE vwap IS NULL""", WINDOWS),
    "scalar_functions": _with(f"""
        SELECT event_id, {ISO} AS iso, epoch_ms(date_trunc('second', ts)) AS epoch_ms,
               epoch_us(ts) // 1000000 AS epoch_s, CASE WHEN symbol = 'view' THEN 0.0 ELSE volume END AS volume,
               CASE WHEN symbol <> 'error' THEN close END AS price, CAST(close AS VARCHAR) AS close_text,
               true AS now_is_set FROM t"""),
}
ORACLES["indicator_chain"] = ORACLES["gold"]
ORACLES.update({
    f"ohlcv_{interval.lower() if interval != '1M' else '1mo'}": _with(f"SELECT {BAR_COLUMNS} FROM b", _bars(interval))
    for interval in (*WINDOW_INTERVALS, *CALENDAR_INTERVALS)
})

ORACLES["records_bucketed"] = ORACLES["records_compacted"]

# Gold in several runs is gold.
ORACLES["gold_incremental"] = ORACLES["medallion_gold"]
