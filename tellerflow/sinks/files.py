"""CSV output with a header line. NULL is an empty field, an empty string is ``""``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a CSV directory, a file per partition; ``mode`` is "overwrite" or "append"."""
    df.write.mode(mode).option("header", "true").csv(path)
