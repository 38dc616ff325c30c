"""Geohash cells as plain column arithmetic.

A precision-p cell has ceil(5p/2) longitude bits and floor(5p/2) latitude
bits, interleaved from the top starting with longitude. Each character holds
five bits: three of one axis and two of the other, in turn. So a character is
one look-up by those two small numbers, and decoding is the reverse.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the standard geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _split(place: int) -> tuple[int, int]:
    """The three leading-axis bits and two other bits of an alphabet position."""
    bits = [place >> 4 - i & 1 for i in range(5)]
    return bits[0] * 4 + bits[2] * 2 + bits[4], bits[1] * 2 + bits[3]


_PAIRS = [_split(place) for place in range(32)]
# Letters in order of (leading bits, other bits), and per letter those bits.
_LETTERS = "".join(ALPHABET[_PAIRS.index((m, n))] for m in range(8) for n in range(4))
_MAJORS = "".join(str(major) for major, _ in _PAIRS)
_MINORS = "".join(str(minor) for _, minor in _PAIRS)


def _bits(precision: int) -> tuple[int, int]:
    total = 5 * precision
    return (total + 1) // 2, total // 2


def cell_index(lat: Column, lon: Column, precision: int = 7) -> tuple[Column, Column]:
    """Integer cell column and row; null outside the valid range."""
    lon_bits, lat_bits = _bits(precision)

    def index(value: Column, low: float, span: float, bits: int) -> Column:
        cell = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(2**bits)))
        inside = value.between(low, low + span)
        return F.when(inside, F.least(cell, F.lit(2**bits - 1).cast("long")))

    return index(lon, -180.0, 360.0, lon_bits), index(lat, -90.0, 180.0, lat_bits)


def _shifts(i: int, precision: int) -> tuple[bool, int, int]:
    """For character i: whether longitude leads, and both axes' shift."""
    lon_bits, lat_bits = _bits(precision)
    leads = i % 2 == 0
    lon_end = (5 * i + 5 + 1) // 2
    lat_end = (5 * i + 5) // 2
    return leads, lon_bits - lon_end, lat_bits - lat_end


def geohash(lat: Column, lon: Column, precision: int = 7) -> Column:
    """Geohash text of a point; null outside the valid range."""
    x, y = cell_index(lat, lon, precision)

    def part(axis: Column, shift: int, mask: int) -> Column:
        return F.shiftright(axis, shift).cast("int").bitwiseAND(F.lit(mask))

    chars = []
    for i in range(precision):
        leads, lon_shift, lat_shift = _shifts(i, precision)
        if leads:
            major, minor = part(x, lon_shift, 7), part(y, lat_shift, 3)
        else:
            major, minor = part(y, lat_shift, 7), part(x, lon_shift, 3)
        chars.append(F.substring(F.lit(_LETTERS), major * 4 + minor + 1, F.lit(1)))
    return F.concat(*chars)


def decode_index(code: Column, precision: int = 7) -> tuple[Column, Column]:
    """Cell column and row of a geohash; null when it is not a valid code."""
    whole = F.when(F.length(code) == precision, code)

    def bits(digits: str, place: Column) -> Column:
        return F.substring(F.lit(digits), place, F.lit(1)).cast("long")

    x = y = F.lit(0).cast("long")
    for i in range(precision):
        leads, lon_shift, lat_shift = _shifts(i, precision)
        # Null for a character outside the alphabet.
        place = F.nullif(F.instr(F.lit(ALPHABET), F.substring(whole, i + 1, 1)), F.lit(0))
        x = x + F.shiftleft(bits(_MAJORS if leads else _MINORS, place), lon_shift)
        y = y + F.shiftleft(bits(_MINORS if leads else _MAJORS, place), lat_shift)
    return x, y


def cell_distance(code: Column, lat: Column, lon: Column, precision: int = 7) -> Column:
    """Steps between a stated cell and the point's own cell (0 same, 1 neighbour).

    Longitude wraps at the antimeridian, so cells either side of it touch.
    """
    cx, cy = decode_index(code, precision)
    px, py = cell_index(lat, lon, precision)
    columns = F.lit(2 ** _bits(precision)[0]).cast("long")
    dx = F.abs(cx - px)
    return F.greatest(F.least(dx, columns - dx), F.abs(cy - py))
