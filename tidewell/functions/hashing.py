"""The bucket hash of table formats: 32-bit Murmur3 (x86, seed 0) over a value's bytes, as expressions.

Spark's own ``hash`` starts from another seed and treats the last bytes of a text otherwise, so its buckets are not theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The constants of Murmur3.
C1, C2, ADD, MIX1, MIX2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
MASK = 0xFFFFFFFF


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _let(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """A value after some steps, each with the result of the one before as a variable, however often it is used."""
    cell = F.array(value)
    for step in steps:
        cell = F.transform(cell, step)
    return F.get(cell, F.lit(0))


def _low(value: Column) -> Column:
    return value.bitwiseAND(_long(MASK))


def _times(factor: int) -> Callable[[Column], Column]:
    """A product modulo 2**32, in halves that stay within 64 bits."""

    def step(x: Column) -> Column:
        high = (x * _long(factor >> 16)).bitwiseAND(_long(0xFFFF))
        return _low(x * _long(factor & 0xFFFF) + F.shiftleft(high, 16))

    return step


def _turned(by: int) -> Callable[[Column], Column]:
    return lambda x: _low(F.shiftleft(x, by).bitwiseOR(F.shiftright(x, 32 - by)))


def _folded(by: int) -> Callable[[Column], Column]:
    return lambda x: x.bitwiseXOR(F.shiftright(x, by))


def _word(word: Column) -> Column:
    return _let(word, _times(C1), _turned(15), _times(C2))


def _step(state: Column, word: Column) -> Column:
    return _let(state.bitwiseXOR(_word(word)), _turned(13), lambda x: _low(x * _long(5) + _long(ADD)))


def _finished(state: Column, length: Column) -> Column:
    signed = lambda x: F.when(x > 0x7FFFFFFF, x - _long(1 << 32)).otherwise(x).cast("int")
    return _let(state.bitwiseXOR(length), _folded(16), _times(MIX1), _folded(13), _times(MIX2), _folded(16), signed)


def murmur3_long(value: Column) -> Column:
    """The hash of a number as eight bytes, the lowest first."""
    number = value.cast("bigint")
    first = _step(_long(0), _low(number))
    return F.when(number.isNotNull(), _finished(_step(first, _low(F.shiftright(number, 32))), _long(8)))


def _number(digits: Column, place: Column, count: int) -> Column:
    """``count`` bytes of hexadecimal text from a byte on, the lowest first."""
    pairs = [F.substring(digits, place * 2 + 1 + 2 * k, F.lit(2)) for k in reversed(range(count))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def murmur3_bytes(value: Column) -> Column:
    """The hash of bytes."""

    def of(row: Column) -> Column:
        digits, n = row["digits"], row["n"]
        whole = F.floor(n / 4).cast("int")
        words = F.transform(F.slice(F.sequence(F.lit(0), whole), F.lit(1), whole), lambda i: _number(digits, i * 4, 4))
        state = F.aggregate(words, _long(0), _step)
        left = n % 4
        tail = F.when(left == 1, _number(digits, whole * 4, 1)).when(left == 2, _number(digits, whole * 4, 2)).when(left == 3, _number(digits, whole * 4, 3))
        mixed = _let(F.struct(state.alias("h"), tail.alias("t")), lambda s: F.when(s["t"].isNotNull(), s["h"].bitwiseXOR(_word(s["t"]))).otherwise(s["h"]))
        return _finished(mixed, n.cast("bigint"))

    row = F.struct(F.hex(value).alias("digits"), F.octet_length(value).alias("n"))
    return F.when(value.isNotNull(), _let(row, of))


def _decimal_bytes(value: Column, scale: int) -> Column:
    """The unscaled value as the fewest big-endian bytes that keep its sign."""
    number = (value * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("bigint")
    digits = F.lpad(F.hex(number), 16, "0")
    # A leading byte goes while the next one has the same sign in its highest bit.
    short = F.when(number < 0, F.regexp_replace(digits, "^(?:FF(?=[89A-F].))+", "")).otherwise(F.regexp_replace(digits, "^(?:00(?=[0-7].))+", ""))
    return F.unhex(short)


def murmur3(value: Column, dtype: T.DataType) -> Column:
    """The hash that table formats give a value of a type; NULL for NULL."""
    if isinstance(dtype, T.IntegralType):
        return murmur3_long(value)
    if isinstance(dtype, T.DateType):
        return murmur3_long(F.datediff(value, F.lit("1970-01-01").cast("date")))
    if isinstance(dtype, T.TimestampType):
        return murmur3_long(F.unix_micros(value))
    if isinstance(dtype, T.TimestampNTZType):
        return murmur3_long(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value))
    if isinstance(dtype, T.StringType):
        return murmur3_bytes(value.cast("binary"))
    if isinstance(dtype, T.BinaryType):
        return murmur3_bytes(value)
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return murmur3_bytes(_decimal_bytes(value, dtype.scale))
    raise ValueError(f"no bucket hash for {dtype.simpleString()}")


def bucket_number(value: Column, dtype: T.DataType, buckets: int) -> Column:
    """The bucket of a value; NULL for NULL."""
    return F.pmod(murmur3(value, dtype).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(buckets))
