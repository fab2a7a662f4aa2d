"""Values of the source database's binary format, as the text format would give them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relayframe.functions import codecs
from relayframe.functions.times import rfc3339_text

# The origin of binary times and dates, 2000-01-01, and the signs of binary numbers.
TIME_ORIGIN_MS = 946_684_800_000
_NEGATIVE, _NAN, _INFINITE, _MINUS_INFINITE = 0x4000, 0xC000, 0xD000, 0xF000


def unsigned(data: Column) -> Column:
    """Up to eight bytes as a whole number; eight bytes wrap to negative ones."""
    return F.conv(F.hex(data), 16, -10).cast("bigint")


def signed(data: Column) -> Column:
    unused = F.lit(64) - F.length(data) * 8
    # Shifting up and back down restores the sign of shorter integers.
    return F.call_function("shiftright", F.call_function("shiftleft", unsigned(data), unused), unused)


def _ieee(bits: Column, mantissa_bits: int, exponent_bits: int) -> Column:
    most, bias = 2**exponent_bits - 1, 2 ** (exponent_bits - 1) - 1
    exponent = F.shiftrightunsigned(bits, mantissa_bits).bitwiseAND(F.lit(most))
    mantissa = bits.bitwiseAND(F.lit(2**mantissa_bits - 1).cast("bigint")).cast("double")
    negative = F.shiftrightunsigned(bits, mantissa_bits + exponent_bits).bitwiseAND(F.lit(1)) == 1
    # Every step scales by a power of two or adds within the mantissa, so it is exact.
    size = (
        F.when((exponent == most) & (mantissa > 0), F.lit(float("nan")))
        .when(exponent == most, F.lit(float("inf")))
        .when(exponent == 0, mantissa * F.pow(F.lit(2.0), F.lit(1.0 - bias - mantissa_bits)))
        .otherwise((F.lit(1.0) + mantissa / 2.0**mantissa_bits) * F.pow(F.lit(2.0), exponent - bias))
    )
    return F.when(negative, -size).otherwise(size)


def float8(data: Column) -> Column:
    return _ieee(unsigned(data), 52, 11)


def float4(data: Column) -> Column:
    """As the double that the shortest text of the single-precision value stands for."""
    return _ieee(unsigned(data), 23, 8).cast("float").cast("string").cast("double")


def numeric_text(data: Column) -> Column:
    """Exact decimal text. The bytes hold counts of base-10000 digits, a weight, a sign, a scale, digits."""
    digits = F.hex(data)

    def field(i: Column | int) -> Column:
        at = (F.lit(i) if isinstance(i, int) else i) * 4 + 1
        return F.conv(F.substr(digits, at.cast("int"), F.lit(4)), 16, 10).cast("int")

    count, sign, scale = field(0), field(2), field(3)
    weight = field(1) - F.when(field(1) >= 0x8000, 0x10000).otherwise(0)

    def group(i: Column) -> Column:
        return F.lpad(F.when((i >= 0) & (i < count), field(i + 4)).otherwise(0).cast("string"), 4, "0")

    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(weight, F.lit(0))), lambda i: F.when(weight < 0, "0000").otherwise(group(i))), "")
    fraction = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(scale, F.lit(1))), lambda j: group(weight + j)), "")
    text = F.concat(
        F.when(sign == _NEGATIVE, "-").otherwise(""),
        F.regexp_replace(whole, "^0+(?=[0-9])", ""),
        F.when(scale > 0, F.concat(F.lit("."), F.substr(fraction, F.lit(1), scale))).otherwise(""),
    )
    return (
        F.when(sign == _NAN, "NaN").when(sign == _INFINITE, "Infinity").when(sign == _MINUS_INFINITE, "-Infinity").otherwise(text)
    )


def timestamp_millis(data: Column) -> Column:
    """Zone-less times as epoch milliseconds; infinities become the extreme integers."""
    micros = signed(data)
    millis = F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))
    return (
        F.when(micros == codecs.TIME_INFINITY, F.lit(codecs.TIME_INFINITY))
        .when(micros == codecs.TIME_NEG_INFINITY, F.lit(codecs.TIME_NEG_INFINITY))
        .otherwise(millis + TIME_ORIGIN_MS)
    )


def timestamptz_text(data: Column) -> Column:
    return rfc3339_text(F.timestamp_micros(signed(data) + TIME_ORIGIN_MS * 1000))


def date_text(data: Column) -> Column:
    return codecs.date_text(F.date_add(F.to_date(F.lit("2000-01-01")), signed(data).cast("int")))
