"""Histogram bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def centred_bin(x: Column, origin: Column, width: Column) -> Column:
    """Index of the bin of ``x``; bins are closed on the right and bin 0 is centred on ``origin``."""
    place = F.ceil(F.try_divide(x - origin, width) - F.lit(0.5))
    return F.coalesce(place, F.lit(0)).cast("bigint")


def bin_width(low: Column, high: Column, bins: int) -> Column:
    """Width that puts the first bin's centre on ``low`` and the last one's on ``high``."""
    return (high - low) / F.lit(float(bins - 1))
