"""One frame to several sinks: replacing their contents, or adding to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tellerflow.sinks.catalog import publish_staged, save_table
from tellerflow.sinks.files import write_csv
from tellerflow.sinks.jdbc import write_table
from tellerflow.sinks.layout import Layout
from tellerflow.sinks.shared import materialize


@dataclass(frozen=True)
class Target:
    """Where one entity goes; a part left out is not written. ``layout`` is that of the table."""

    table: str | None = None
    csv: str | None = None
    connection: Mapping[str, str] | None = None
    jdbc_table: str | None = None
    connections: int | None = None
    layout: Layout | None = None

    def __post_init__(self) -> None:
        if (self.connection is None) != (self.jdbc_table is None):
            raise ValueError("connection and jdbc_table go together")
        if self.table is None and self.csv is None and self.jdbc_table is None:
            raise ValueError("a target needs a table, a CSV path or a JDBC table")


def _write_exports(df: DataFrame, target: Target, mode: str) -> None:
    """The sinks besides the catalog."""
    if target.jdbc_table is not None:
        write_table(df, target.connection, target.jdbc_table, mode, target.connections)
    if target.csv is not None:
        write_csv(df, target.csv, mode)


def export(df: DataFrame, target: Target) -> None:
    """Overwrite the sinks of ``target`` besides its table."""
    _write_exports(df, target, "overwrite")


def replace(frames: Sequence[tuple[DataFrame, Target]]) -> list[DataFrame]:
    """Overwrite every sink of every target; returns the frames as they can now be read.

    All catalog tables are staged before the first is swapped in, so the frames may read the
    tables they replace. A frame is computed once: the other sinks are fed from its table, or
    from the shared folder if it has none.
    """
    tables = {target.table: df for df, target in frames if target.table is not None}
    if tables:
        layouts = {target.table: target.layout for _, target in frames}
        publish_staged(frames[0][0].sparkSession, tables, layouts)
    written = []
    for df, target in frames:
        if target.table is not None:
            df = df.sparkSession.table(target.table)
        else:
            df = materialize(df, "replace")
        _write_exports(df, target, "overwrite")
        written.append(df)
    return written


def add(df: DataFrame, target: Target) -> DataFrame:
    """Append a batch to every sink of ``target``; returns the batch.

    For several sinks the batch is computed once, into the shared folder.
    """
    sinks = (target.table, target.csv, target.jdbc_table)
    if sum(s is not None for s in sinks) > 1:
        df = materialize(df, "add")
    if target.table is not None:
        save_table(df, target.table, "append", target.layout)
    _write_exports(df, target, "append")
    return df
