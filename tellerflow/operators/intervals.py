"""Joins of intervals of any width, overlapping or not, by equality of cells."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The level of intervals without an end; all of them lie in one cell.
_ENDLESS = 5000


class Ends(NamedTuple):
    """The columns that hold the two ends of an interval; the same one twice for single values."""

    low: str
    high: str


def _level(low: Column, high: Column, unit: float) -> Column:
    """The coarseness of the cells an interval lies in: the least k with unit * 2**k >= width."""
    width = (high - low) / unit
    exact = F.ceil(F.log2(F.greatest(width, F.lit(1.0)))).cast("int")
    # The logarithm may be a hair off next to a power of two.
    exact = F.when(F.pow(F.lit(2.0), exact) < width, exact + 1).otherwise(exact)
    infinite = F.lit(float("inf"))
    return F.when((low == -infinite) | (high == infinite), _ENDLESS).otherwise(exact)


def _cell(x: Column, level: Column, unit: float) -> Column:
    width = F.pow(F.lit(2.0), level.cast("double")) * unit
    return F.when(level >= _ENDLESS, F.lit(0).cast("long")).otherwise(F.floor(x / width).cast("long"))


def _prepared(df: DataFrame, ends: Ends, side: str, unit: float) -> DataFrame:
    low, high = (F.col(c).cast("double") for c in ends)
    known = low.isNotNull() & high.isNotNull() & ~F.isnan(low) & ~F.isnan(high) & (low <= high)
    able = df.filter(known)
    return able.select(
        F.struct(*able.columns).alias(f"{side}_row"),
        low.alias(f"{side}_low"), high.alias(f"{side}_high"),
        _level(low, high, unit).alias(f"{side}_level"),
    )


def _levels(df: DataFrame, side: str) -> list[int]:
    """The levels that occur, some dozens at most: one per power of two."""
    return sorted(r[0] for r in df.select(f"{side}_level").distinct().collect())


def _placed(df: DataFrame, side: str, others: list[int], unit: float) -> DataFrame:
    """Rows in the cells of their own level and of every coarser level of the other side: one or
    two cells each, as no cell is narrower than the interval."""
    own, low, high = (F.col(f"{side}_{n}") for n in ("level", "low", "high"))
    coarser = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda k: k > own)
    level = F.col("_level")
    return (
        df.withColumn("_level", F.explode(F.concat(F.array(own), coarser)))
        .withColumn("_cell", F.explode(F.sequence(_cell(low, level, unit), _cell(high, level, unit))))
    )


def interval_join(
    left: DataFrame, right: DataFrame, left_ends: Ends, right_ends: Ends, unit: float = 1.0
) -> DataFrame:
    """All columns of both sides for each pair of rows whose closed intervals share a value.

    Two intervals meet at the level of the longer one, where both lie in one or two cells; (level,
    cell) is an equality key, with the exact test behind it, so that Spark plans a hash or merge
    join and can split hot cells. A pair that shares two cells is taken in the one where the
    overlap begins. ``unit`` is the width of the finest cells: the usual width of short
    intervals is a good choice; results do not depend on it.

    Intervals with a NULL or NaN end, or with the low end above the high one, hold nothing. Ends
    may be infinite. Integers are compared as doubles. Repeated rows pair like others. Columns
    whose names occur on both sides must be renamed before.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a = _prepared(left, Ends(*left_ends), "a", unit)
    b = _prepared(right, Ends(*right_ends), "b", unit)
    levels_a, levels_b = _levels(a, "a"), _levels(b, "b")
    placed_a, placed_b = _placed(a, "a", levels_b, unit), _placed(b, "b", levels_a, unit)
    start = F.greatest("a_low", "b_low")
    meet = (
        (F.col("_level") == F.greatest("a_level", "b_level"))
        & (F.col("a_low") <= F.col("b_high")) & (F.col("b_low") <= F.col("a_high"))
        & (F.col("_cell") == _cell(start, F.col("_level"), unit))
    )
    return placed_a.join(placed_b, ["_level", "_cell"]).filter(meet).select("a_row.*", "b_row.*")
