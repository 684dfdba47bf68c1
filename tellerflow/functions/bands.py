"""Value bands: the two fixed ones, as SQL text, and generated bands of equal width.

A generated band ``id`` covers ``[width * id, width * (id + 1) - 1]``. Between one band's
upper end and the next band's lower end lies a gap: with width 1000, 999.5 is in no band.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits. NULL and values below the first limit take the last label.
BALANCE_BANDS = """
    CASE WHEN Balance BETWEEN 0 AND 1000 THEN '0 - 1000'
         WHEN Balance > 1000 AND Balance <= 5000 THEN '1000 - 5000'
         WHEN Balance > 5000 AND Balance <= 10000 THEN '5000 - 10000'
         ELSE 'Above 10000' END"""
AGE_BANDS = """
    CASE WHEN Age BETWEEN 18 AND 30 THEN '18-30'
         WHEN Age > 30 AND Age <= 40 THEN '31-40'
         WHEN Age > 40 AND Age <= 50 THEN '41-50'
         WHEN Age > 50 AND Age <= 60 THEN '51-60'
         ELSE '61+' END"""


# A band's ends must be 64-bit integers.
LARGEST = 9e18


def bandable(x: Column) -> Column:
    """``x``, or NULL where it is not finite or too large for a band."""
    return F.when(F.abs(x.cast("double")) < LARGEST, x)


def band_id(x: Column, width: int) -> Column:
    """The only band that can hold ``x``; NULL where ``x`` is not ``bandable``."""
    return F.floor(bandable(x).cast("double") / width)


def inside_band(x: Column, width: int) -> Column:
    """False where ``x`` lies in the gap above its band, NULL where there is no band."""
    return bandable(x).cast("double") <= (band_id(x, width) + 1) * width - 1


def first_band_id(x: Column, width: int, single: bool = False) -> Column:
    """Band id at which a generated table starts when ``x`` is the smallest value.

    Truncates towards zero, so the band that holds a negative smallest value is left out
    unless the value is a multiple of ``width``. ``single`` divides in 32-bit floats, as for a
    32-bit column.
    """
    ratio = bandable(x).cast("double") / width
    return (ratio.cast("float") if single else ratio).cast("long")


def band_label(band: Column, width: int) -> Column:
    low = band * width
    return F.concat(low.cast("string"), F.lit("-"), (low + (width - 1)).cast("string"))
