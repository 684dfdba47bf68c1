"""Reports kept up by difference: the counts they read, in a store of releases of their own.

A change is counted by itself, joined with the stored counts of the accounts it names, and added to
the buckets it touches; neither stored accounts nor stored transactions are read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.operators import clean
from tellerflow.plans.jobs import Entities, counted_reports
from tellerflow.sinks import scratch
from tellerflow.sinks.releases import Change, Release, Store, Table

_ACCOUNT = ("Account_ID", "Customer_ID", "Account_Type", "Churn")
_TRANSACTION = ("Account_ID", "Transaction_Type")
_OWNED = ("Customer_ID", "Churn")
_ACTIVITY = ("Customer_ID", "Transaction_Type", "Account_Type")

TABLES = (
    Table("accounts", "Account_ID LONG, Customer_ID INT, Account_Type STRING, Churn STRING, n LONG",
          ("Account_ID",)),
    Table("transactions", "Account_ID LONG, Transaction_Type STRING, n LONG", ("Account_ID",)),
    Table("owned", "Customer_ID INT, Churn STRING, n LONG", ("Customer_ID",)),
    Table("activity", "Customer_ID INT, Transaction_Type STRING, Account_Type STRING, "
                      "txn_count LONG, churned_txn_count LONG", ("Customer_ID",)),
)


def open_counts(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    """The counts behind the reports; its releases say which batches are in."""
    return Store(spark, root, TABLES, buckets)


def _summed(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*sums)


def _difference(keys: tuple[str, ...], added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """Rows counted by ``keys``, removed ones below zero; counted before the shuffle."""
    signed = [df.select(*keys, F.lit(sign).cast("long").alias("n"))
              for df, sign in ((added, 1), (removed, -1)) if df is not None]
    return _summed(reduce(DataFrame.unionByName, signed), keys).filter("n != 0")


def _activity(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Counts of accounts times counts of transactions, per customer and the reports' columns."""
    rows = clean.encode_churn(accounts).join(
        transactions.withColumnRenamed("n", "txns"), "Account_ID"
    )
    pairs = F.col("n") * F.col("txns")
    return _summed(
        rows.select(*_ACTIVITY, pairs.alias("txn_count"),
                    (pairs * F.col("churn")).alias("churned_txn_count")),
        _ACTIVITY,
    )


def _merged(store: Store, base: Release, table: str, keys: tuple[str, ...], new: DataFrame) -> Change:
    """The buckets that ``new`` touches, with its counts added."""
    touched = store.buckets_of(table, new)
    rows = _summed(store.rows(table, base, touched).unionByName(new), keys)
    count = "txn_count" if table == "activity" else "n"
    below = F.raise_error(F.lit(f"{table}: more rows removed than were counted"))
    n = F.when(F.col(count) < 0, below.cast("long")).otherwise(F.col(count))
    return Change(rows.withColumn(count, n).filter(F.col(count) != 0), touched)


def change(
    store: Store,
    added: Entities = Entities(None, None, None),
    removed: Entities = Entities(None, None, None),
    batch: str | None = None,
) -> Release:
    """Add and take away cleaned accounts and transactions (customers are not counted), in one
    release; a ``batch`` that is in is not counted again.

    The first load is an addition to nothing. What an update takes from a row and puts in its place
    are both given. Removing what was never added is an error, and nothing is released.
    """
    base = store.current()
    pairs = [(added.accounts, removed.accounts), (added.transactions, removed.transactions)]
    if (batch is not None and batch in base.batches) or all(df is None for p in pairs for df in p):
        return base
    with scratch(store.spark) as keep:
        new = {}
        for table, keys, pair in zip(("accounts", "transactions"), (_ACCOUNT, _TRANSACTION), pairs):
            none = store.rows(table, Release())
            new[table] = none if pair == (None, None) else keep(_difference(keys, *pair), table)
        accounts, transactions = new["accounts"], new["transactions"]
        old_accounts = store.rows("accounts", base, store.buckets_of("accounts", transactions))
        old_transactions = store.rows("transactions", base, store.buckets_of("transactions", accounts))
        parts = [_activity(accounts, old_transactions), _activity(accounts, transactions),
                 _activity(old_accounts, transactions)]
        new["activity"] = keep(_summed(reduce(DataFrame.unionByName, parts), _ACTIVITY), "activity")
        new["owned"] = _summed(accounts.select(*_OWNED, "n"), _OWNED)
        by = {"accounts": _ACCOUNT, "transactions": _TRANSACTION, "owned": _OWNED, "activity": _ACTIVITY}
        changes = {t: _merged(store, base, t, keys, new[t]) for t, keys in by.items()}
        changes = {t: c for t, c in changes.items() if c.instead_of}
        return store.publish(changes, base, batch)


def reports_of(store: Store, customers: DataFrame, release: Release | None = None) -> dict[str, DataFrame]:
    """The reports over customers, accounts and transactions, from the counts of one release.

    Those over accounts alone are single counts of the accounts table and not kept here.
    """
    counts = store.read(release)
    return counted_reports(counts["owned"], counts["activity"], customers, customers.sparkSession)
