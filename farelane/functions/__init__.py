"""Column builders: everything here returns plain JVM-side expressions."""

from .encode import fixed_min_max, one_hot
from .geo import cell_id, cell_number, cell_text, geohash, haversine_km, manhattan_km
from .times import (
    clock_date,
    clock_hour,
    clock_seconds,
    local_clock,
    cyclic_hour,
    format_utc,
    local_status,
    local_to_utc,
    parse_utc,
    to_instant,
    to_local,
    weekday,
)

__all__ = [
    "cell_id", "clock_date", "clock_hour", "clock_seconds", "local_clock", "cell_number", "cell_text", "cyclic_hour", "fixed_min_max", "format_utc", "geohash",
    "haversine_km", "local_status", "local_to_utc", "manhattan_km", "one_hot", "parse_utc",
    "to_instant", "to_local", "weekday",
]
