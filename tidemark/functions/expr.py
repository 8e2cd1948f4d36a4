"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ts(c: str | Column) -> Column:
    """TIMESTAMP view of a TIMESTAMP or TIMESTAMP_NTZ column (session tz UTC)."""
    return col(c).cast("timestamp")


def epoch_micros(c: str | Column) -> Column:
    return F.unix_micros(as_ts(c))


def epoch_seconds(c: str | Column) -> Column:
    """Whole epoch seconds, floored (sub-second truncated toward -inf)."""
    return F.floor(epoch_micros(c) / F.lit(MICROS)).cast("long")


def bucket(c: str | Column, freq_seconds: int) -> Column:
    """Start of the ``freq``-second bucket containing ``c``, as epoch seconds.

    Bucket [t, t+f) is labelled t, like a left-closed, left-labelled resample.
    """
    f = int(freq_seconds)
    return (F.floor(epoch_micros(c) / F.lit(f * MICROS)) * F.lit(f)).cast("long")


def seconds_to_ts(c: str | Column) -> Column:
    return F.timestamp_seconds(col(c))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising on /0 under ANSI mode."""
    return F.try_divide(num, den)


def nan_to_null(c: str | Column) -> Column:
    """pandas NaN compares False; Spark NaN is larger than any number.

    Convert NaN to NULL at every scan so comparisons behave like pandas.
    """
    x = col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def inf_to_null(c: str | Column) -> Column:
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def bit(cond: Column) -> Column:
    """1 when the comparison is true, else 0 (NULL compares false, as NaN does in pandas)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def hex_from_bits(bits: Sequence[Column], strip_leading_zeros: bool = True) -> Column:
    """Encode a bit sequence (most significant first) as a lowercase hex string.

    Each group of four bits becomes one character, so the result has no
    width limit (a LONG-based ``conv`` overflows past 64 bits). Leading zero
    nibbles are stripped so the string equals ``format(int(bits, 2), 'x')``.
    """
    bits = list(bits)
    pad = (-len(bits)) % 4
    bits = [F.lit(0)] * pad + bits
    digits = F.lit("0123456789abcdef")
    chars = []
    for i in range(0, len(bits), 4):
        b0, b1, b2, b3 = bits[i : i + 4]
        nib = b0 * 8 + b1 * 4 + b2 * 2 + b3
        chars.append(F.substring(digits, nib + 1, 1))
    out = F.concat(*chars) if len(chars) > 1 else chars[0]
    if strip_leading_zeros:
        out = F.regexp_replace(out, r"^0+(?=.)", "")
    return out


def week_of_year_sunday(d: str | Column) -> Column:
    """strftime ``%U``: week number of the year, weeks starting on Sunday (00-53)."""
    x = col(d)
    return F.lpad(
        F.floor((F.dayofyear(x) + F.lit(6) - (F.dayofweek(x) - F.lit(1))) / F.lit(7)).cast("string"), 2, "0"
    )


def yyyymmdd(c: str | Column) -> Column:
    return F.date_format(as_ts(c), "yyyyMMdd")


def split_instrument(c: str | Column) -> tuple[Column, Column]:
    """``EXCHANGE_SYMBOL`` split on the first underscore only."""
    parts = F.split(col(c), "_", 2)
    return parts.getItem(0), parts.getItem(1)


def instrument_id(exchange: str | Column = "exchange", symbol: str | Column = "symbol") -> Column:
    return F.concat_ws("_", col(exchange), col(symbol))


def anchored(pattern: str) -> str:
    """``re.match`` semantics for ``rlike`` (anchored at the start only)."""
    return pattern if pattern.startswith("^") else f"^(?:{pattern})"


def round_all(cols: Iterable[str], digits: int = 6) -> list[Column]:
    return [F.round(F.col(c), digits).alias(c) for c in cols]
