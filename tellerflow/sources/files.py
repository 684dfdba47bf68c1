"""CSV input: a header line that is skipped, a declared schema, no inference pass.

Columns are bound by position. A cell that does not fit its type becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerflow import schemas


def read_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def read_csv_traced(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType
) -> DataFrame:
    """The same rows with ``_file``, and in ``_line`` the line of a row in which a cell does not
    fit its type or the cells are too few or too many. See ``operators.rejects``."""
    kept = T.StructType([*schemas.as_struct(schema), T.StructField("_line", T.StringType())])
    reader = spark.read.option("header", "true").option("columnNameOfCorruptRecord", "_line")
    return reader.schema(kept).csv(path).withColumn("_file", F.col("_metadata.file_path"))


def read_accounts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.ACCOUNTS_RAW)


def read_customers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def read_transactions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS_RAW)


def read_updates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.UPDATES)


def read_deletes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.DELETES)
