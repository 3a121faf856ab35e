"""Scaling and one-hot encoding with fixed parameters; nothing is fitted."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_min_max(col: Column, lo: float, hi: float) -> Column:
    """Scale ``[lo, hi]`` to ``[0, 1]``; values outside are not clipped."""
    return (col.cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo))


def one_hot(col: Column, categories: Iterable, prefix: str | None = None) -> list[Column]:
    """One 0/1 float column per category; an unknown or null value gives all zeros."""
    flags = [(c, F.coalesce(col == F.lit(c), F.lit(False)).cast("float")) for c in categories]
    return [f if prefix is None else f.alias(f"{prefix}{c}") for c, f in flags]
