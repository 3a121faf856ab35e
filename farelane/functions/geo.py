"""Distances and geohash cells as column expressions.

A cell is first an integer, the pair of its grid coordinates
``lon_index * 2**lat_bits + lat_index``. Grouping, joining and one-hot encoding
use that integer; the base-32 text is only spelled out where a person reads it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"  # fixed value: the geohash digits


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half_dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_dlon) * F.sin(half_dlon)
    )
    # rounding can push the chord of antipodes past 1, where asin is NaN
    capped = F.when(chord > 1, F.lit(1.0)).otherwise(chord)
    return F.asin(F.sqrt(capped)) * (2 * EARTH_RADIUS_KM)


def manhattan_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Sum of the two angular differences times the radius (no cos(latitude) factor)."""
    return (F.abs(F.radians(lon2) - F.radians(lon1)) + F.abs(F.radians(lat2) - F.radians(lat1))) * EARTH_RADIUS_KM


def _grid_bits(precision: int) -> tuple[int, int]:
    if not 1 <= precision <= 12:
        raise ValueError(f"geohash precision must be 1..12, got {precision}")
    bits = 5 * precision
    return (bits + 1) // 2, bits // 2


def _grid_index(x: Column, half_range: int, bits: int) -> Column:
    """Index of the half-open interval ``(lower, upper]`` that holds ``x``.

    The width is a dyadic number, so cell edges are exact doubles. A point on an
    edge belongs to the lower cell. ``x + half_range`` may round down onto an edge
    for tiny ``x``; the last comparison puts such a point back.
    """
    width = F.lit(2.0 * half_range / 2**bits)
    half = F.lit(float(half_range))
    edge = F.ceil((x + half) / width)
    q = F.when(x > edge.cast("double") * width - half, edge).otherwise(edge - 1)
    # least and greatest skip nulls, so a null coordinate needs the guard
    return F.when(x.isNotNull(), F.greatest(F.least(q, F.lit(2**bits - 1)), F.lit(0).cast("long")))


def cell_id(lat: Column, lon: Column, precision: int = 5) -> Column:
    """Integer id of the geohash cell of a point."""
    lon_bits, lat_bits = _grid_bits(precision)
    return _grid_index(lon, 180, lon_bits) * F.lit(2**lat_bits) + _grid_index(lat, 90, lat_bits)


def _letters(lon_count: int) -> str:
    """The alphabet reordered so that it is indexed by ``lon_part * 2**lat_count + lat_part``.

    A letter holds five bits, longitude and latitude alternating. With three
    longitude bits the letter starts with longitude, with two it starts with latitude.
    """
    lat_count = 5 - lon_count
    out = []
    for lon_part in range(2**lon_count):
        for lat_part in range(2**lat_count):
            lon_text = format(lon_part, f"0{lon_count}b")
            lat_text = format(lat_part, f"0{lat_count}b")
            first, second = (lon_text, lat_text) if lon_count == 3 else (lat_text, lon_text)
            mixed = "".join(a + b for a, b in zip(first, second + " ")).strip()
            out.append(ALPHABET[int(mixed, 2)])
    return "".join(out)


def cell_text(cell: Column, precision: int = 5) -> Column:
    """Base-32 text of a cell id made by :func:`cell_id` with the same precision."""
    lon_left, lat_left = _grid_bits(precision)
    lat_total = lat_left
    letters = []
    for position in range(precision):
        lon_count = 3 if position % 2 == 0 else 2
        lat_count = 5 - lon_count
        lon_left -= lon_count
        lat_left -= lat_count
        lon_part = F.shiftright(cell, lat_total + lon_left).bitwiseAND(F.lit(2**lon_count - 1))
        lat_part = F.shiftright(cell, lat_left).bitwiseAND(F.lit(2**lat_count - 1))
        spot = (lon_part * F.lit(2**lat_count) + lat_part).cast("int")
        letters.append(F.get(F.lit(list(_letters(lon_count))), spot))
    return F.concat(*letters)


def geohash(lat: Column, lon: Column, precision: int = 5) -> Column:
    """Geohash text of a point."""
    return cell_text(cell_id(lat, lon, precision), precision)


def cell_number(text: str) -> int:
    """The :func:`cell_id` of a geohash text, for use as a literal in a plan."""
    bits = "".join(format(ALPHABET.index(c), "05b") for c in text)
    lon_bits, lat_bits = bits[0::2], bits[1::2]
    return int(lon_bits, 2) * 2 ** len(lat_bits) + int(lat_bits or "0", 2)
