"""JDBC output. Address, driver and credentials come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "errorifexists",
    connections: int | None = None,
) -> None:
    """Write one table; ``mode`` is "errorifexists", "overwrite" or "append".

    Each task opens a connection; ``connections`` limits how many there are at once. Never
    overwrite a table that ``df`` itself reads: stage it instead.
    """
    limit = {"numPartitions": str(connections)} if connections else {}
    options = {**connection, "dbtable": table, **limit}
    df.write.format("jdbc").options(**options).mode(mode).save()
