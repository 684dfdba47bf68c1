"""Catalog tables, and the staged replacement of tables a job also reads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerflow.sinks.layout import Layout, save_in_buckets

class PublishError(RuntimeError):
    """Staged tables were not all published; the message names those that were and were not."""


def save_table(
    df: DataFrame, table: str, mode: str = "overwrite", layout: Layout | None = None
) -> None:
    """``mode`` "append" matches columns by name and fails on other names or types."""
    if layout is not None:
        save_in_buckets(df, table, layout, mode)
    else:
        df.write.mode(mode).saveAsTable(table)


def _stage(df: DataFrame, table: str, layout: Layout | None) -> None:
    """Write ``<table>__staged`` and compare its row count with the rows that were written."""
    staged = f"{table}__staged"
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    save_table(rows, staged, layout=layout)
    found = df.sparkSession.table(staged).count()
    if layout is not None and not found:
        return  # Spark may drop the observing step from a shuffle that it finds to be empty
    if found != written.get["rows"]:
        raise PublishError(f"{staged} holds {found} rows, {written.get['rows']} were written")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _swap(spark: SparkSession, table: str) -> None:
    """Put the staged table in place; the former one is dropped last, or put back on an error."""
    staged, former = f"{table}__staged", f"{table}__former"
    live = spark.catalog.tableExists(table)
    if live:
        spark.sql(f"DROP TABLE IF EXISTS {former}")
        _rename(spark, table, former)
    try:
        _rename(spark, staged, table)
    except Exception:
        if live:
            _rename(spark, former, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {former}")


def repair(spark: SparkSession, tables: Iterable[str]) -> None:
    """Give a table that is missing while its former contents exist those contents back.

    That is what a run leaves that was stopped between the two renames of a swap.
    """
    for table in tables:
        former = f"{table}__former"
        if not spark.catalog.tableExists(table) and spark.catalog.tableExists(former):
            _rename(spark, former, table)


def publish_staged(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    layouts: Mapping[str, Layout | None] | None = None,
) -> None:
    """Replace tables by frames that may read those very tables.

    Every frame is written and checked under a staging name before the first table is touched,
    so all of them see the old contents. Tables are then swapped one by one in the order of
    ``frames``, which are not one transaction: a run that is stopped leaves the first ones new
    and the others old. A job that can be repeated puts the table it computes from last, calls
    ``repair`` before it reads, and gives the same result when run again. ``layouts`` names the
    buckets of tables that have them. See ``sinks.releases`` for tables that change together.
    """
    repair(spark, frames)
    for table, df in frames.items():
        _stage(df, table, (layouts or {}).get(table))
    done: list[str] = []
    for table in frames:
        try:
            _swap(spark, table)
        except Exception as error:
            left = [t for t in frames if t not in done]
            raise PublishError(
                f"{table}__staged could not replace {table}; published: {done}, not: {left}"
            ) from error
        done.append(table)
