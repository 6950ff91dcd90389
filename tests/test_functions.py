import math

import pytest
from pyspark.sql import functions as F

from candlewick import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def many(spark, values, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_iso_text_to_epoch_ms(spark):
    texts = ["2026-03-25T15:10:00.000Z", "2026-03-25T15:10:00.123Z", "2024-01-01 00:05:00", "2024-01-01T02:00:00+02:00",
             "never", "12:34:56", "2024", "2024-05-01", "1899-12-31T23:59:59Z", "2200-01-01 00:00:00", "+294247-01-10T04:00:54Z", None]
    assert many(spark, texts, "string", fn.iso_to_epoch_ms) == [
        1774451400000, 1774451400123, 1704067500000, 1704067200000] + [None] * 8


def test_epoch_ms_to_iso_cuts_to_seconds(spark):
    assert many(spark, [1704067259999, 0, 2**63 - 1, -2**63, None], "bigint", fn.epoch_ms_to_iso) == [
        "2024-01-01T00:00:59Z", "1970-01-01T00:00:00Z", None, None, None]
    assert many(spark, [1e30, float("nan"), -1e12, None], "double", fn.epoch_seconds_to_time) == [None] * 4


def test_now(spark):
    assert one(spark, fn.now_epoch_ms()) > 1_700_000_000_000


def test_to_double_is_safe_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert many(spark, ["1.5", "1e3", "n/a", "", None], "string", fn.to_double) == [1.5, 1000.0, None, None, None]
    assert many(spark, ["2", "x", "NaN", "Infinity", None], "string", fn.volume_or_zero) == [2.0, 0.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("value", [
    0.0, 1.0, 0.1733, 74240.12, 21207873.17318935, 25996265.80135544, 1e7, 123456789012345.0, 9999999999999998.0, 1e16,
    1.5e16, 1e22, 1.2345e300, 0.001, 0.0001, 0.00012, 0.00001, 1.5e-7, -2.5, -12345678.25, -0.0005, -1.5e-9, 2.5e-300,
    math.inf, -math.inf,
])
def test_double_text(spark, value):
    assert one(spark, fn.double_text(F.lit(value))) == str(value)


def test_double_text_of_nothing(spark):
    assert one(spark, fn.double_text(F.lit(None).cast("double"))) is None
    assert one(spark, fn.double_text(F.lit(float("nan")))) == "nan"


def test_format_symbol(spark):
    df = spark.createDataFrame(
        [("A", "EX", None), ("A", "EX", 1), ("B:A", "EX", 2), ("B:A", "EX", None)], "s string, e string, c int")
    assert [r[0] for r in df.select(fn.format_symbol("s", "e", "c")).collect()] == ["EX:A", "EX:A1!", "B:A", "B:A"]
    assert {r[0] for r in df.select(fn.format_symbol("s", "e")).collect()} == {"EX:A", "B:A"}
    assert {r[0] for r in df.select(fn.format_symbol("s", "e", 3)).collect()} == {"EX:A3!", "B:A"}
    with pytest.raises(ValueError):
        fn.format_symbol("s", "e", 1.5)


def test_bucket_starts(spark):
    time = F.to_timestamp(F.lit("2024-02-29 13:47:11"))
    want = {"1": "2024-02-29 13:47:00", "3": "2024-02-29 13:45:00", "5": "2024-02-29 13:45:00",
            "15": "2024-02-29 13:45:00", "30": "2024-02-29 13:30:00", "45": "2024-02-29 13:30:00",
            "1H": "2024-02-29 13:00:00", "2H": "2024-02-29 12:00:00", "3H": "2024-02-29 12:00:00",
            "4H": "2024-02-29 12:00:00", "1D": "2024-02-29 00:00:00", "1W": "2024-02-26 00:00:00",
            "1M": "2024-02-01 00:00:00"}
    assert set(want) == set(fn.INTERVALS)
    for interval, start in want.items():
        assert one(spark, fn.bucket_start(time, interval).cast("string")) == start, interval
    with pytest.raises(ValueError):
        fn.bucket_start(time, "2D")
