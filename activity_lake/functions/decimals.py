"""Decimals carried as base64 text of big-endian two's-complement bytes, with a scale per row."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_64 = Decimal(2**64)
_PARSER = "org.apache.commons.lang3.math.NumberUtils"


def decode_base64(text: Column) -> Column:
    """Bytes of a base64 text, NULL where the text is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def big_endian_integer(raw: Column, signed: bool = True) -> Column:
    """DECIMAL(38,0) value of big-endian bytes; NULL for empty bytes and beyond 38 digits."""
    digits = F.hex(raw)
    if signed:
        negative = F.substring(digits, 1, 1) >= "8"
        # A negative number is minus (its complement plus one).
        magnitude = F.when(
            negative, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
        ).otherwise(digits)
    else:
        negative = F.lit(False)
        magnitude = digits
    significant = F.ltrim(magnitude, F.lit("0"))
    padded = F.lpad(significant, 32, "0")

    def half(start: int) -> Column:
        return F.conv(F.substring(padded, start, 16), 16, 10).cast("decimal(20,0)")

    value = F.try_add(F.try_multiply(half(1), F.lit(_TWO_64)), half(17))
    # Not by unary minus, which rounds to 34 digits.
    value = F.when(negative, F.try_subtract(F.lit(Decimal(-1)), value)).otherwise(value)
    return F.when((F.length(raw) > 0) & (F.length(significant) <= 32), value)


def integer_text(raw: Column, signed: bool = True) -> Column:
    """Decimal digits of big-endian bytes of any length, NULL for empty bytes.

    The magnitude is written in hex digits and read by the JVM's number parser, which has no limit of length.
    """
    digits = F.hex(raw)
    magnitude = F.concat(F.lit("0x"), digits)
    if signed:
        # A negative number is minus (its complement plus one): the last digit that is no F goes up, the Fs behind it are zeros.
        head = F.rtrim(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("F"))
        raised = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.translate(F.substring(head, -1, 1), "0123456789ABCDE", "123456789ABCDEF"))
        negative = F.concat(F.lit("-0x"), F.rpad(raised, F.length(digits), F.lit("0")))
        magnitude = F.when(F.substring(digits, 1, 1) >= "8", negative).otherwise(magnitude)
    return F.when(F.length(raw) > 0, F.java_method(F.lit(_PARSER), F.lit("createBigInteger"), magnitude))


def small_integer(raw: Column, signed: bool = True) -> Column:
    """BIGINT value of at most seven big-endian bytes."""
    value = F.conv(F.hex(raw), 16, 10).cast("bigint")
    if not signed:
        return value
    bits = F.length(raw) * 8
    negative = F.substring(F.hex(raw), 1, 1) >= "8"
    return F.when(negative, value - F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)).otherwise(value)


def scaled_decimal(unscaled: Column, scale: Column, precision: int, out_scale: int) -> Column:
    """``unscaled / 10**scale`` rounded half up once; NULL when it does not fit.

    The exponent form keeps the division exact whatever the scale of the row.
    """
    return F.concat(unscaled.cast("string"), F.lit("E"), (-scale).cast("string")).try_cast(
        f"decimal({precision},{out_scale})"
    )


def decode_decimal(
    text: Column, scale: Column, precision: int = 10, out_scale: int = 0, signed: bool = True
) -> Column:
    """DECIMAL(precision, out_scale) of a base64 decimal; NULL for bad text, empty bytes, no scale, or a
    result that does not fit; the unscaled value may have any number of digits."""
    raw = decode_base64(text)
    unscaled = (
        F.when(F.length(raw).between(1, 7), small_integer(raw, signed).cast("string"))
        .when(F.length(raw) <= 15, big_endian_integer(raw, signed).cast("string"))
        .otherwise(integer_text(raw, signed))
    )
    return scaled_decimal(unscaled, scale, precision, out_scale)


def encode_integer(value: Column) -> Column:
    """Base64 text of the shortest two's-complement bytes of a BIGINT (inverse of the decoder)."""
    digits = F.hex(value)
    width = F.length(digits)
    even = F.when(width % 2 == 1, width + 1).when(digits >= "8", width + 2).otherwise(width)
    positive = F.lpad(digits, even.cast("int"), F.lit("0"))
    negative = F.regexp_replace(digits, "^(?:FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(value < 0, negative).otherwise(positive)))
