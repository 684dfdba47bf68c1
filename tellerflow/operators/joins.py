"""The three-table join, counts over it, and the range join.

``J`` below is accounts with customers with transactions: one row per transaction of an
account whose customer is known. The reports only count rows of J, so they use ``activity``
and never build J itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions import band_id, bandable


def account_customer_txn(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    """J with all its columns.

    Both inputs of either join are shuffled by Spark itself, with nothing between the shuffle
    and the join, so adaptive execution can split the partition of a hot customer or account.
    """
    return accounts.join(customers, "Customer_ID").join(transactions, "Account_ID")


def activity(accounts: DataFrame, transactions: DataFrame, *by: str) -> DataFrame:
    """J counted per customer and ``by``: ``Customer_ID, *by, txn_count, churned_txn_count``.

    ``accounts`` carries ``churn`` as 0/1; ``by`` names account or transaction columns. Inner
    joins multiply row counts, so the transactions are first counted by account and each account
    carries its count. An account or a customer that holds most of the rows shrinks to a few rows
    before anything is shuffled for it. The accounts, whose key is nearly unique, are shuffled
    once, for the join.
    """
    account_by = [c for c in by if c in accounts.columns]
    txn_by = [c for c in by if c not in account_by]
    per_account = transactions.groupBy("Account_ID", *txn_by).agg(F.count("*").alias("txns"))
    return (
        accounts.select("Account_ID", "Customer_ID", "churn", *account_by)
        .join(per_account, "Account_ID")
        .groupBy("Customer_ID", *by)
        .agg(
            F.sum("txns").alias("txn_count"),
            F.sum(F.col("txns") * F.col("churn")).alias("churned_txn_count"),
        )
    )


def customer_activity(
    activity: DataFrame, customers: DataFrame, by: list[str], customer_columns: dict[str, Column]
) -> DataFrame:
    """``activity`` joined with customers and counted per ``by`` and ``customer_columns``.

    The customer expressions are computed, and the customers counted by them, before the join.
    """
    people = (
        customers.select("Customer_ID", *[c.alias(name) for name, c in customer_columns.items()])
        .groupBy("Customer_ID", *customer_columns)
        .agg(F.count("*").alias("people"))
    )
    return (
        activity.join(people, "Customer_ID")
        .groupBy(*by, *customer_columns)
        .agg(
            F.sum(F.col("txn_count") * F.col("people")).alias("txn_count"),
            F.sum(F.col("churned_txn_count") * F.col("people")).alias("churned_txn_count"),
        )
    )


def by_churn(counts: DataFrame, count_name: str) -> DataFrame:
    """Turn ``txn_count, churned_txn_count`` into one row per churn value that occurs."""
    keys = [c for c in counts.columns if c not in ("txn_count", "churned_txn_count")]
    kept = F.col("txn_count") - F.col("churned_txn_count")
    return counts.select(
        *keys,
        F.stack(F.lit(2), F.lit(0), kept, F.lit(1), F.col("churned_txn_count")).alias(
            "churn", count_name
        ),
    ).filter(F.col(count_name) > 0)


def active_customers(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Distinct ``Customer_ID`` of the accounts that have transactions.

    Existence needs no row counts: the transactions are reduced to one row per account first.
    """
    used = transactions.select("Account_ID").distinct()
    links = accounts.select("Account_ID", "Customer_ID")
    return links.join(used, "Account_ID", "left_semi").select("Customer_ID").distinct()


def bounds(customers: DataFrame, active: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with ``min_<name>, max_<name>`` of each column over J: ``{column: name}``.

    Repeated rows do not move a bound, so each customer is reduced to its own bounds first.
    Values that are not ``bandable`` are left out.
    """
    names = [(end, name) for name in columns.values() for end in ("min", "max")]
    pick = {"min": F.min, "max": F.max}
    own = [pick[e](bandable(F.col(c))).alias(f"{e}_{n}") for c, n in columns.items() for e in ("min", "max")]
    return (
        customers.groupBy("Customer_ID")
        .agg(*own)
        .join(active, "Customer_ID", "left_semi")
        .agg(*[pick[e](f"{e}_{n}").alias(f"{e}_{n}") for e, n in names])
    )


def range_join(
    df: DataFrame, column: str, bands: DataFrame, low: str, high: str, width: int
) -> DataFrame:
    """Left join on ``low <= column <= high`` with a table of bands of one width.

    A value can only fall into the band of its own id, so the id is an equality key next to
    the range test and Spark plans a hash or merge join, whatever the number of bands.
    ``plans.reports`` computes the same labels without a table.
    """
    x = F.col(column)
    ids = bands.withColumn("_band", band_id(F.col(low), width))
    in_band = (band_id(x, width) == F.col("_band")) & x.between(F.col(low), F.col(high))
    return df.join(ids, in_band, "left").drop("_band", low, high)
