"""Small column helpers for string-typed records."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(key: str, record: str = "data") -> Column:
    """Value of a key; a missing key or a missing map gives NULL."""
    return F.col(record)[key]


def as_int(text: Column) -> Column:
    """Text to int; text that is no number gives NULL."""
    return text.try_cast("int")


def all_of(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def slice_start(value: Column, width: int) -> Column:
    """Start of the slice of ``width`` units that ``value`` lies in, in whole numbers."""
    return value - F.pmod(value, F.lit(width))


# A first record as one number: (ts, seq, flag), each shifted to be positive. Fixed-width values keep
# a minimum in a hash aggregate; structs and texts would make it a sort.
_TS_SHIFT, _SEQ_SHIFT, _FIELD = 10**15, 4 * 10**18, 10**20


def packed_first(ts: Column, seq: Column, flag: Column) -> Column:
    """A number whose minimum is the first record by (ts, seq, flag); the flag is a digit.

    ``ts`` may lie within 10^15 and ``seq`` within 4 * 10^18 of zero.
    """
    shift, field_size = F.lit(Decimal(_SEQ_SHIFT)), F.lit(Decimal(_FIELD))
    high = (ts.cast("decimal(16,0)") + F.lit(Decimal(_TS_SHIFT))) * field_size
    low = (seq.cast("decimal(19,0)") + shift) * F.lit(Decimal(10)) + flag.cast("decimal(1,0)")
    return (high + low).cast("decimal(38,0)")


def unpacked_first(name: str) -> list[Column]:
    """``ts``, ``seq`` and ``flag`` of a column made by ``packed_first``."""
    low = f"({name} % {_FIELD})"
    return [
        F.expr(f"{name} div {_FIELD} - {_TS_SHIFT}").alias("ts"),
        F.expr(f"{low} div 10 - {_SEQ_SHIFT}").alias("seq"),
        F.expr(f"CAST({low} % 10 AS INT)").alias("flag"),
    ]
