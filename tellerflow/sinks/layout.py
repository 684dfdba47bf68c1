"""Tables stored in buckets of a key, so that joins and counts by it need no shuffle of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``buckets`` of one key column. Tables that meet on a key take the same number of buckets:
    transactions and accounts those of the account, customers those of the customer."""

    key: str
    buckets: int

    def number(self) -> Column:
        """The bucket Spark puts a row into."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))


def save_in_buckets(df: DataFrame, table: str, layout: Layout, mode: str = "overwrite") -> None:
    """Write a catalog table in sorted buckets; ``mode`` "append" adds files to them.

    Rows are gathered by bucket first, so that a bucket becomes one file, or several if a hot key
    makes it large, and not a file per task.
    """
    gathered = df.withColumn("__bucket", layout.number()).hint("rebalance", "__bucket")
    (
        gathered.drop("__bucket").write.mode(mode)
        .bucketBy(layout.buckets, layout.key).sortBy(layout.key)
        .saveAsTable(table)
    )


def skewed_buckets(
    spark: SparkSession, table: str, layout: Layout, times: float = 5.0
) -> DataFrame:
    """Buckets with more than ``times`` the rows of the median bucket: bucket, rows, median, and
    the key that occurs most in it with its rows.

    A bucketed scan gives a bucket to one task, which cannot be split. If this names a bucket, read
    the table with ``read_split`` in the jobs that join it. Only the key column is read; keys are
    counted within tasks first.
    """
    keys = spark.table(table).groupBy(layout.key).agg(F.count("*").alias("n"))
    per = keys.groupBy(layout.number().alias("bucket")).agg(
        F.sum("n").alias("rows"),
        F.max(F.struct(F.col("n"), F.col(layout.key))).alias("top"),
    )
    # Buckets without rows count in the median; there are as many rows here as buckets at most.
    every = spark.range(layout.buckets).select(F.col("id").cast("int").alias("bucket"))
    whole = every.join(per, "bucket", "left").fillna(0, ["rows"])
    median = whole.agg(F.percentile("rows", F.lit(0.5))).scalar()
    many = F.col("rows") > times * F.greatest("median", F.lit(1))
    return (
        whole.withColumn("median", median)
        .filter(many)
        .select("bucket", "rows", "median", F.col(f"top.{layout.key}").alias("key"),
                F.col("top.n").alias("key_rows"))
    )


def read_split(spark: SparkSession, table: str) -> DataFrame:
    """The table without its buckets: joins shuffle it, and adaptive execution splits hot keys."""
    frame = spark.table(table)
    files = list(frame.inputFiles())
    if not files:
        return frame
    return spark.read.schema(frame.schema).format("parquet").load(files)
