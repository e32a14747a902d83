"""Column expressions that read fields out of a binary record.

All positions are 0-based and may be columns. A field that does not fit before ``end`` reads as
0, '' or NULL (dates), never as an error, so decoding cannot fail on a damaged record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CODES = [code for code in range(256) if code]
# CP037 comes from the codec; NUL is shown as a blank, and blanks at the end are trimmed.
_LATIN1 = "\x00" + bytes(_CODES).decode("latin-1")
_CP037 = " " + bytes(_CODES).decode("cp037")

#: Days per header date are only believed between these years.
FIRST_YEAR, LAST_YEAR = 1960, 2100
MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HUNDREDTH = 10_000


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _fits(data: Column, pos, width: int, end) -> Column:
    limit = F.length(data) if end is None else end
    return _col(pos) + F.lit(width) <= limit


def _slice(data: Column, pos, width) -> Column:
    return F.substring(data, _col(pos) + F.lit(1), _col(width))


def _digits(data: Column, pos, width: int) -> Column:
    """Unsigned big-endian integer as decimal text."""
    return F.conv(F.hex(_slice(data, pos, width)), 16, 10)


def uint(data: Column, pos, width: int, end=None) -> Column:
    """Big-endian unsigned integer of 1 to 7 bytes."""
    return F.when(_fits(data, pos, width, end), _digits(data, pos, width).cast("long")).otherwise(
        F.lit(0).cast("long")
    )


def u8(data: Column, pos, end=None) -> Column:
    return uint(data, pos, 1, end).cast("short")


def u16(data: Column, pos, end=None) -> Column:
    return uint(data, pos, 2, end).cast("int")


def u32(data: Column, pos, end=None) -> Column:
    return uint(data, pos, 4, end)


def u64(data: Column, pos, end=None) -> Column:
    """Big-endian unsigned 64-bit integer as decimal(20,0)."""
    return F.when(
        _fits(data, pos, 8, end), _digits(data, pos, 8).cast("decimal(20,0)")
    ).otherwise(F.lit(0).cast("decimal(20,0)"))


def text(data: Column, pos, width: int, end=None) -> Column:
    """EBCDIC (CP037) text without trailing blanks or NULs."""
    limit = F.length(data) if end is None else end
    room = F.greatest(F.lit(0), F.least(F.lit(width), limit - _col(pos)))
    raw = F.decode(_slice(data, pos, room.cast("int")), "ISO-8859-1")
    return F.rtrim(F.translate(raw, _LATIN1, _CP037))


def packed_date(data: Column, pos, end=None) -> Column:
    """Packed ``YYYYDDD`` plus sign nibble; NULL unless it is a real day in the believed years."""
    # Hexadecimal letters make the cast NULL, and a NULL stays one all the way.
    number = F.substring(F.hex(_slice(data, pos, 4)), 1, 7).try_cast("int")
    first_of_year = F.make_date(
        F.when(number.between(FIRST_YEAR * 1000, LAST_YEAR * 1000 + 999), F.floor(number / 1000)).cast("int"),
        F.lit(1),
        F.lit(1),
    )
    day = F.pmod(number, F.lit(1000))
    last = F.dayofyear(F.last_day(F.add_months(first_of_year, 11)))
    return F.when(
        _fits(data, pos, 4, end) & day.between(1, last), F.date_add(first_of_year, day - F.lit(1))
    )


def day_time(date: Column, hundredths: Column) -> Column:
    """Date plus hundredths of a second since midnight."""
    return F.timestamp_micros(
        F.unix_date(date).cast("long") * F.lit(MICROS_PER_DAY)
        + hundredths * F.lit(MICROS_PER_HUNDREDTH)
    )


def seconds(hundredths: Column) -> Column:
    return hundredths / F.lit(100.0)


def millis(hundredths: Column) -> Column:
    return hundredths * F.lit(10).cast("long")


def hexfloat(data: Column, pos, end=None) -> Column:
    """IBM 64-bit hexadecimal float: sign bit, base-16 exponent in excess 64, 56-bit fraction."""
    lead = uint(data, pos, 1, end)
    fraction = uint(data, _col(pos) + F.lit(1), 7, end).cast("double")
    exponent = lead.bitwiseAND(F.lit(127)) - F.lit(64)
    magnitude = fraction * F.pow(F.lit(2.0), exponent * F.lit(4) - F.lit(56))
    return F.when(_fits(data, pos, 8, end) & (lead >= 128), -magnitude).when(
        _fits(data, pos, 8, end), magnitude
    ).otherwise(F.lit(0.0))


def hex_text(data: Column, pos, width: int, end=None) -> Column:
    """Upper-case hexadecimal text, two digits a byte."""
    return F.when(_fits(data, pos, width, end), F.hex(_slice(data, pos, width))).otherwise(
        F.lit("0" * (2 * width))
    )


def flag(data: Column, pos, end=None) -> Column:
    """A byte as yes or no."""
    return uint(data, pos, 1, end) != F.lit(0)


def bit_set(byte: Column, mask: int) -> Column:
    return byte.bitwiseAND(F.lit(mask)) != F.lit(0)
