"""The incremental load as a file stream.

The cleaning of accounts and transactions works row by row, so it runs unchanged on a stream, and
the file sink adds each input file exactly once: a batch that is delivered or run again does not
grow the table. The cleaning of customers needs the mean and the duplicates of a whole batch, so
each micro-batch is cleaned as a batch of its own and added once to every sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tellerflow import schemas
from tellerflow.operators import clean
from tellerflow.sinks import Ledger, Target, add_once


def _follow(
    spark: SparkSession,
    source: str,
    schema: str,
    cleaning: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    files_per_batch: int,
) -> StreamingQuery:
    """Clean the CSV files new in ``source`` since the last call, append them, and stop.

    A long backlog is worked off in batches of ``files_per_batch`` files, each of them committed.
    """
    raw = (
        spark.readStream.option("header", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(schema)
        .csv(source)
    )
    return (
        cleaning(raw)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_accounts(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    return _follow(
        spark,
        source,
        schemas.ACCOUNTS_RAW,
        clean.clean_accounts,
        target,
        checkpoint,
        files_per_batch,
    )


def follow_transactions(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    return _follow(
        spark,
        source,
        schemas.TRANSACTIONS_RAW,
        clean.clean_transactions,
        target,
        checkpoint,
        files_per_batch,
    )


def follow_customers(
    spark: SparkSession,
    source: str,
    target: Target,
    ledger: Ledger,
    checkpoint: str,
    name: str = "customers",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Clean the customers of the files new in ``source``, add them to every sink, and stop.

    Mean age and de-duplication are those of a micro-batch, as they are those of a batch in the
    incremental load. The checkpoint fixes which files make up a micro-batch, and the ledger knows
    it as ``<name>-<number>``: one that was stopped in the middle is run again and leaves each row
    once in every sink. ``name`` belongs to the checkpoint; a new one needs a new name.
    """

    def add_batch(raw: DataFrame, number: int) -> None:
        add_once(clean.clean_customers(raw), target, f"{name}-{number}", ledger)

    return (
        spark.readStream.option("header", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .schema(schemas.CUSTOMERS)
        .csv(source)
        .writeStream.foreachBatch(add_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
