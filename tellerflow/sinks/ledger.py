"""Appending a batch once to every sink, also when a job is stopped between or in them."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.schemas import as_struct
from tellerflow.sinks.jdbc import write_table
from tellerflow.sinks.shared import scratch
from tellerflow.sinks.targets import Target
from tellerflow.sources.jdbc import read_table

_ENTRIES = "sink STRING, state STRING, mark STRING, at TIMESTAMP"


class LedgerError(RuntimeError):
    """A batch cannot be added without the risk of doubling or losing rows."""


class Ledger:
    """Which sinks have begun and which hold a batch: a folder of small files that are only ever
    added, a folder for each batch within it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> DataFrame:
        schema = as_struct(f"{_ENTRIES}, batch STRING")
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def of(self, batch: str) -> dict[str, tuple[str, str]]:
        """State, "begun" or "done", and fingerprint of each sink that has met the batch."""
        rows = self._entries().filter(F.col("batch") == batch).collect()
        return {r.sink: (r.state, r.mark) for r in sorted(rows, key=lambda r: r.at)}

    def holders(self, mark: str, sink: str) -> set[str]:
        """Batches with these very rows that a sink holds."""
        same = self._entries().filter(
            (F.col("mark") == mark) & (F.col("sink") == sink) & (F.col("state") == "done")
        )
        return {r.batch for r in same.select("batch").distinct().collect()}

    def note(self, batch: str, sink: str, state: str, mark: str) -> None:
        entry = [(sink, state, mark, datetime.now(timezone.utc))]
        frame = self.spark.createDataFrame(entry, _ENTRIES).withColumn("batch", F.lit(batch))
        frame.coalesce(1).write.mode("append").partitionBy("batch").parquet(self.path)


def fingerprint(df: DataFrame) -> str:
    """The same for the same rows in any order: their number and the sum of their hashes."""
    mark = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("mark")
    found = df.agg(F.count(F.lit(1)).alias("rows"), mark).first()
    return f"{found['rows']}:{found['mark']}"


def _add_to_table(df: DataFrame, table: str, batch: str) -> None:
    """The batch is a partition of the table: what a stopped run left of it goes first."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch = '{batch}')")
    df.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").saveAsTable(table)


def _add_to_csv(df: DataFrame, path: str, batch: str) -> None:
    """The batch is a folder of its own, which a second run writes anew."""
    df.write.mode("overwrite").option("header", "true").csv(f"{path}/batch={batch}")


def _add_to_jdbc(df: DataFrame, target: Target, begun: bool, key: str | None) -> None:
    """A stopped append leaves the rows of some tasks. They are found by the key and left out."""
    if begun:
        if key is None:
            raise LedgerError(f"{target.jdbc_table} may hold a part of the batch; give its key")
        there = read_table(df.sparkSession, target.connection, target.jdbc_table).select(key)
        df = df.join(there, key, "left_anti").select(*df.columns)
    write_table(df, target.connection, target.jdbc_table, "append", target.connections)


def add_once(
    df: DataFrame, target: Target, batch: str, ledger: Ledger, key: str | None = None
) -> bool:
    """Append a batch to every sink of ``target`` that does not hold it; False if all did.

    Run again after a stop, each sink ends up with each row once. Tables and CSV folders are
    divided by batch, in a column ``batch``; they are read like any partitioned table. In a
    database the rows that are there are recognised by ``key``, unique and never NULL. The batch is
    computed once, into the shared folder. A batch whose rows differ from those under the same
    name before, or equal those of another batch in a sink, is refused.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, dots and dashes, not {batch!r}")
    sinks = {"table": target.table, "csv": target.csv, "jdbc": target.jdbc_table}
    names = {kind: f"{kind}:{where}" for kind, where in sinks.items() if where is not None}
    known = {n: e for n, e in ledger.of(batch).items() if n in names.values()}
    if all(known.get(n, ("",))[0] == "done" for n in names.values()):
        return False
    with scratch(df.sparkSession) as keep:
        rows = keep(df, "batch")
        mark = fingerprint(rows)
        if any(before != mark for _, before in known.values()):
            raise LedgerError(f"batch {batch} was begun with other rows")
        for name in names.values():
            other = ledger.holders(mark, name) - {batch}
            if other and not mark.startswith("0:"):
                raise LedgerError(f"{name} holds the rows of {batch} as {min(other)}")
        for kind, name in names.items():
            state = known.get(name, ("new",))[0]
            if state == "done":
                continue
            ledger.note(batch, name, "begun", mark)
            if kind == "table":
                _add_to_table(rows, target.table, batch)
            elif kind == "csv":
                _add_to_csv(rows, target.csv, batch)
            else:
                _add_to_jdbc(rows, target, state == "begun", key)
            ledger.note(batch, name, "done", mark)
    return True
