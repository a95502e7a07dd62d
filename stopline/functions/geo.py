"""Geohash as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lat: Column, lon: Column, precision: int = 7) -> Column:
    """Geohash of (lat, lon); NULL when either is NULL.

    Longitude owns the even bits from the left, latitude the odd ones. Each
    coordinate becomes one integer cell number, and every character is built
    from five of their bits, so the whole thing stays in generated code.
    """
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value: Column, low: float, span: float, width: int) -> Column:
        scaled = F.floor((value - low) / span * (1 << width)).cast("long")
        return F.least(F.greatest(scaled, F.lit(0)), F.lit((1 << width) - 1))

    lon_cell = cell(lon, -180.0, 360.0, lon_bits)
    lat_cell = cell(lat, -90.0, 180.0, lat_bits)

    chars = []
    for start in range(0, bits, 5):
        code = F.lit(0).cast("long")
        for place in range(start, start + 5):
            source, width = (lon_cell, lon_bits) if place % 2 == 0 else (lat_cell, lat_bits)
            bit = F.shiftright(source, width - 1 - place // 2).bitwiseAND(F.lit(1))
            code = code * 2 + bit
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (code + 1).cast("int"), F.lit(1)))
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, F.concat(*chars))
