"""Number parsing and instrument names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.functions.columns import as_column


def to_double(text: Column | str) -> Column:
    """Text to double; null for text that is no number, also under ANSI mode."""
    return as_column(text).try_cast("double")


def is_finite(number: Column | str) -> Column:
    """True for a number; false for null, NaN and infinity."""
    column = as_column(number)
    return F.coalesce(~F.isnan(column) & (F.abs(column) != float("inf")), F.lit(False))


def volume_or_zero(value: Column | str) -> Column:
    """A volume that is missing, or no finite number, counts as 0.0."""
    number = to_double(value)
    return F.when(is_finite(number), number).otherwise(F.lit(0.0))


def double_text(value: Column | str) -> Column:
    """Double as text that reads back as the same double: plain digits from 1e-4 up to 1e16, exponent form outside."""
    number = as_column(value).cast("double")
    text = number.cast("string")
    digits = F.regexp_replace(text.try_cast("decimal(38,22)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    exponent = F.regexp_replace(F.regexp_replace(F.lower(text), "\\.0e", "e"), "e(?!-)", "e+")
    exponent = F.regexp_replace(exponent, "e([+-])(\\d)$", "e$10$2")
    size = F.abs(number)
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (number == 0), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(F.isnan(number) | (size == float("inf")), F.replace(F.lower(text), F.lit("infinity"), F.lit("inf")))
        .otherwise(exponent)
    )


def format_symbol(symbol: Column | str, exchange: Column | str, contract: Column | str | int | None = None) -> Column:
    """Full instrument name: ``EX:SYM``, or ``EX:SYM{n}!`` for futures contract n; a name with an exchange stays.

    ``exchange`` and ``contract`` given as text name a column.
    """
    symbol, exchange = as_column(symbol), as_column(exchange)
    plain = F.concat(exchange, F.lit(":"), symbol)
    if contract is None:
        full = plain
    elif isinstance(contract, bool) or not isinstance(contract, (int, str, Column)):
        raise ValueError(f"contract must be an integer or an integer column, not {contract!r}")
    else:
        number = F.lit(contract) if isinstance(contract, int) else as_column(contract)
        number = number.cast("int")
        full = F.when(number.isNull(), plain).otherwise(F.concat(plain, number.cast("string"), F.lit("!")))
    return F.when(F.contains(symbol, F.lit(":")), symbol).otherwise(full)
