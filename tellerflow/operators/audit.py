"""Checks run before and after cleaning."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_with_nulls(df: DataFrame) -> DataFrame:
    """Rows in which at least one column is NULL."""
    return df.filter(reduce(or_, [F.col(c).isNull() for c in df.columns]))


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """How often each value of one column occurs, NULL included."""
    return df.groupBy(column).agg(F.count("*").alias("count"))


def value_profiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Profiles of several text columns from one read: ``column_name, value, count``."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("count"))
    )


def staged_profiles(df: DataFrame, cells: list[tuple[str, str, Column]]) -> DataFrame:
    """Profiles of several states of several columns from one read: ``stage, column_name, value,
    count`` for each (stage, column name, expression), for example a column before and after its
    cleaning. Values are counted within tasks before they are shuffled."""
    rows = [
        F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("column_name"), value.alias("value"))
        for stage, name, value in cells
    ]
    return (
        df.select(F.inline(F.array(*rows)))
        .groupBy("stage", "column_name", "value")
        .agg(F.count("*").alias("count"))
    )


def null_metrics(df: DataFrame) -> list[Column]:
    """Aggregates for ``observe``: the rows, and the NULLs of each column."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return [F.count(F.lit(1)).alias("__rows"), *nulls]


def null_counts(df: DataFrame, entity: str) -> DataFrame:
    """``entity, column_name, rows, nulls``, a row per column, from one read."""
    totals = df.agg(*null_metrics(df))
    each = F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("rows"), F.col(c).alias("nulls"))
        for c in df.columns
    ))
    return totals.select(F.lit(entity).alias("entity"), F.inline(each))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every row that occurs more than once, with its ``count``; NULLs count as equal."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def preview(df: DataFrame, n: int = 20, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order`` and then by the other columns, so that it is stable.

    Each task keeps its own first ``n`` rows; no full sort takes place.
    """
    first = order or []
    rest = [c for c in df.columns if c not in first]
    return df.orderBy(*first, *rest).limit(n)
