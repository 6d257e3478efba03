"""Points and geohashes from longitude and latitude."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"  # fixed values: geohash alphabet
SRID = 4326  # fixed value: WGS 84


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the half-open cell a coordinate falls in, out of 2**bits.

    Cell edges are exact in binary, so one comparison with each edge removes
    any rounding of the division.
    """
    cells = 1 << bits
    guess = F.floor((value - low) / span * cells)
    edge = guess * (span / cells) + low
    after = (guess + 1) * (span / cells) + low
    exact = guess - (value < edge).cast("long") + (value >= after).cast("long")
    return F.least(F.greatest(exact, F.lit(0)), F.lit(cells - 1)).cast("long")


def _alphabet(first_bits: int, second_bits: int) -> str:
    """Base-32 digits re-ordered by (bits of one axis, bits of the other)."""
    digits = []
    for a in range(1 << first_bits):
        for b in range(1 << second_bits):
            value = 0
            for i in range(first_bits + second_bits):
                source, width = (a, first_bits) if i % 2 == 0 else (b, second_bits)
                value = value << 1 | (source >> (width - 1 - i // 2)) & 1
            digits.append(BASE32[value])
    return "".join(digits)


def geohash(lng: Column, lat: Column, length: int = 7) -> Column:
    """Geohash text, computed in the JVM: five interleaved bits per character."""
    lng_bits, lat_bits = (5 * length + 1) // 2, 5 * length // 2
    x = _cell(lng.cast("double"), -180.0, 360.0, lng_bits)
    y = _cell(lat.cast("double"), -90.0, 180.0, lat_bits)
    table, chars = F.lit(_alphabet(3, 2)), []
    for i in range(length):
        # Even characters start with a longitude bit, odd ones with a latitude bit.
        x_take, y_take = (3, 2) if i % 2 == 0 else (2, 3)
        lng_bits -= x_take
        lat_bits -= y_take
        xs = F.shiftright(x, lng_bits).bitwiseAND(F.lit((1 << x_take) - 1))
        ys = F.shiftright(y, lat_bits).bitwiseAND(F.lit((1 << y_take) - 1))
        row = xs * 4 + ys if i % 2 == 0 else ys * 4 + xs
        chars.append(F.substr(table, (row + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def double_bits(value: Column) -> Column:
    """The 64 bits of a finite double as hex, the sign first (IEEE 754 binary64).

    Dividing by a power of two is exact, so exponent and mantissa come out of
    arithmetic; the logarithm's rounding is undone by comparing with both
    neighbouring powers.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    power = lambda e: F.pow(F.lit(2.0), e)
    exponent = guess - (size < power(guess)).cast("long") + (size >= power(guess + 1)).cast("long")
    normal = ((size / power(exponent) - 1) * float(1 << 52)).cast("long")
    tiny = (size * float(1 << 537) * float(1 << 537)).cast("long")  # below the least normal number: a multiple of 2^-1074
    negative = (value < 0) | (value.cast("string") == "-0.0")
    sign = F.when(negative, 2048).otherwise(0)
    small = size < 2.0**-1022
    high = sign + F.when(small, 0).otherwise(exponent + 1023)
    low = F.when(small, tiny).otherwise(normal)
    return F.concat(F.lpad(F.hex(high.cast("long")), 3, "0"), F.lpad(F.hex(low), 13, "0"))


def _little_endian(bits: Column) -> Column:
    return F.concat(*[F.substring(bits, place, 2) for place in range(15, 0, -2)])


def wkb_point(lng: Column | str, lat: Column | str) -> Column:
    """Well-known-binary point, little-endian; NULL unless both are finite numbers."""
    lng, lat = (F.col(c) if isinstance(c, str) else c for c in (lng, lat))
    point = F.unhex(F.concat(F.lit("0101000000"), *[_little_endian(double_bits(c.cast("double"))) for c in (lng, lat)]))
    finite = (F.abs(lng) < float("inf")) & (F.abs(lat) < float("inf"))
    return F.when(finite, point)
