"""The batch jobs: full load, incremental load, update, delete and analysis."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerflow import schemas, sources
from tellerflow.functions import yes_no
from tellerflow.operators import audit, changes, clean, rejects
from tellerflow.operators.joins import activity, bounds
from tellerflow.plans import reports
from tellerflow.sinks import (
    Ledger,
    Target,
    add,
    add_once,
    materialize,
    repair,
    replace,
    scratch,
)


class Entities(NamedTuple):
    """One thing for each of the three tables: a frame, a path or a target."""

    accounts: Any
    customers: Any
    transactions: Any


def read_batch(spark: SparkSession, paths: Entities) -> Entities:
    return Entities(
        sources.read_accounts(spark, paths.accounts),
        sources.read_customers(spark, paths.customers),
        sources.read_transactions(spark, paths.transactions),
    )


RAW = Entities(schemas.ACCOUNTS_RAW, schemas.CUSTOMERS, schemas.TRANSACTIONS_RAW)


def read_batch_traced(spark: SparkSession, paths: Entities) -> Entities:
    """``read_batch`` with the file of each row, and the line of rows that do not fit."""
    return Entities(*(sources.read_csv_traced(spark, p, s) for p, s in zip(paths, RAW, strict=True)))


def clean_batch(raw: Entities) -> Entities:
    return Entities(
        clean.clean_accounts(raw.accounts),
        clean.clean_customers(raw.customers),
        clean.clean_transactions(raw.transactions),
    )


def audit_batch(raw: Entities, cleaned: Entities) -> dict[str, DataFrame]:
    """The checks of a load, as frames for the caller to look at or store; each reads its input.
    ``audited_load`` has them from the pass that writes."""
    settled = clean.fill_mean_age(clean.normalise_gender(raw.customers))
    return {
        "row_count_accounts": audit.row_count(raw.accounts),
        "null_audit_accounts": audit.rows_with_nulls(clean.parse_account_dates(raw.accounts)),
        "null_audit_customers": audit.rows_with_nulls(raw.customers),
        "null_audit_transactions": audit.rows_with_nulls(raw.transactions),
        "duplicate_customers": audit.duplicate_rows(settled),
        "profile_accounts_raw": audit.value_profiles(raw.accounts, ["Credit_Card"]),
        "profile_accounts_clean": audit.value_profiles(cleaned.accounts, ["Credit_Card"]),
        "profile_gender_raw": audit.value_profiles(raw.customers, ["Gender"]),
        "profile_gender_clean": audit.value_profiles(settled, ["Gender"]),
        "profile_employment_raw": audit.value_profiles(clean.dedup(settled), ["Employment_Status"]),
        "profile_customers_clean": audit.value_profiles(
            cleaned.customers, ["Gender", "Employment_Status"]
        ),
        "profile_transactions_raw": audit.value_profiles(raw.transactions, ["Transaction_Type"]),
        "profile_transactions_clean": audit.value_profiles(
            cleaned.transactions, ["Transaction_Type"]
        ),
    }


def load_profiles(raw: Entities) -> Entities:
    """Every value profile of a load, before and after cleaning, from one expansion of each table;
    of customers from two, as duplicates go between them."""
    card, kind = F.col("Credit_Card"), F.col("Transaction_Type")
    settled = clean.fill_mean_age(clean.normalise_gender(raw.customers.withColumn("_raw", F.col("Gender"))))
    alone = clean.distinct_customers(raw.customers)
    status = F.col("Employment_Status")
    before = audit.staged_profiles(
        settled, [("raw", "Gender", F.col("_raw")), ("settled", "Gender", F.col("Gender"))]
    )
    after = audit.staged_profiles(alone, [
        ("distinct", "Employment_Status", status),
        ("clean", "Gender", F.col("Gender")),
        ("clean", "Employment_Status", clean.employment_status()),
    ])
    return Entities(
        audit.staged_profiles(
            raw.accounts, [("raw", "Credit_Card", card), ("clean", "Credit_Card", yes_no(card))]
        ),
        before.unionByName(after),
        audit.staged_profiles(raw.transactions, [
            ("raw", "Transaction_Type", kind), ("clean", "Transaction_Type", clean.transaction_type())
        ]),
    )


class Audited(NamedTuple):
    """What a load wrote, and its checks, stored in the shared folder."""

    written: Entities
    audits: dict[str, DataFrame]


def audited_load(spark: SparkSession, paths: Entities, targets: Entities) -> Audited:
    """The full load with all its checks, reading every input once.

    Each input is written, as it is read, to the shared folder, and its rows and NULLs are counted
    in that very pass; cleaning and checks read the stored columns they need. The checks are
    ``null_counts``; rows with NULLs, value profiles and rejected cells of each table, the latter
    explaining every NULL that reading and cleaning made; duplicate customers.
    """
    with scratch(spark) as keep:
        staged, traced, counts = [], {}, []
        for entity, frame in read_batch_traced(spark, paths)._asdict().items():
            seen = Observation()
            names = [c for c in frame.columns if c not in (rejects.FILE, rejects.LINE)]
            metrics = audit.null_metrics(frame.select(names))
            traced[entity] = keep(frame.observe(seen, *metrics), entity)
            staged.append(traced[entity].select(names))
            rows = seen.get["__rows"]
            counts += [(entity, c, rows, seen.get[c]) for c in names]
        raw = Entities(*staged)
        written = _replace(clean_batch(raw), targets)
        settled = clean.fill_mean_age(clean.normalise_gender(raw.customers))
        checks = {
            "null_audit_accounts": audit.rows_with_nulls(clean.parse_account_dates(raw.accounts)),
            "null_audit_customers": audit.rows_with_nulls(raw.customers),
            "null_audit_transactions": audit.rows_with_nulls(raw.transactions),
            "duplicate_customers": audit.duplicate_rows(settled),
            **{f"profile_{n}": df for n, df in load_profiles(raw)._asdict().items()},
            **{
                f"rejected_{n}": rejects.rejected_cells(
                    traced[n], getattr(RAW, n), rejects.cleaning_rules(n)
                )
                for n in RAW._fields
            },
        }
        audits = {name: materialize(df, name) for name, df in checks.items()}
    schema = "entity STRING, column_name STRING, rows LONG, nulls LONG"
    return Audited(written, {"null_counts": spark.createDataFrame(counts, schema), **audits})


def _replace(frames: Entities, targets: Entities) -> Entities:
    return Entities(*replace(list(zip(frames, targets, strict=True))))


def full_load(spark: SparkSession, paths: Entities, targets: Entities) -> Entities:
    """Clean three CSV inputs and replace the contents of every sink; returns what was written."""
    return _replace(clean_batch(read_batch(spark, paths)), targets)


def incremental_load(spark: SparkSession, paths: Entities, targets: Entities) -> Entities:
    """Clean a new batch by itself and append it to every sink; returns the cleaned batch.

    Mean age and de-duplication are those of the batch. Loading a batch twice adds it twice; see
    ``incremental_load_once``.
    """
    cleaned = clean_batch(read_batch(spark, paths))
    return Entities(*(add(df, target) for df, target in zip(cleaned, targets, strict=True)))


#: The column that tells the rows of a table apart; customers have repeated ids.
KEYS = Entities("Account_ID", None, "Transaction_ID")


def incremental_load_once(
    spark: SparkSession, paths: Entities, targets: Entities, batch: str, ledger: Ledger
) -> bool:
    """Clean a new batch by itself and add it to every sink that does not hold it yet.

    Stopped anywhere and run again, or run twice, it leaves each row once in every sink; False if
    there was nothing to do. A database sink of customers that was stopped in the middle is an
    error, since their ids repeat.
    """
    cleaned = clean_batch(read_batch(spark, paths))
    added = [
        add_once(df, target, batch, ledger, key)
        for df, target, key in zip(cleaned, targets, KEYS, strict=True)
    ]
    return any(added)


def _current(spark: SparkSession, target: Target, frame: DataFrame | None) -> DataFrame:
    """The frame the caller gave, else the target's table as the last whole run left it."""
    if frame is not None:
        return frame
    if target.table is None:
        raise ValueError("give the input as a frame, or a target with a table")
    repair(spark, [target.table])
    return spark.table(target.table)


def update_customers(
    spark: SparkSession, updates_path: str, target: Target, customers: DataFrame | None = None
) -> DataFrame:
    """Apply a file of phone number updates to the customers and their exports.

    The input is ``customers``, from any source, or the target's table.
    """
    updates = sources.read_updates(spark, updates_path)
    updated = changes.update_phone_numbers(_current(spark, target, customers), updates)
    return replace([(updated, target)])[0]


class Deleted(NamedTuple):
    """What the delete job left, and the listed ids that no account had."""

    left: Entities
    unmatched: DataFrame


def delete_accounts(
    spark: SparkSession,
    deletes_path: str,
    targets: Entities,
    tables: Entities = Entities(None, None, None),
) -> Deleted:
    """Apply a file of account ids to the three tables and their exports.

    The inputs are ``tables``, from any source, or the targets' tables. Each new table is
    computed from the accounts as they were. The number of jobs does not depend on the number of
    ids. The keys to remove are written first: Spark then knows their size, and a short list is
    broadcast instead of shuffling the tables for it.

    What goes follows from the accounts, so they are replaced last: a job that was stopped
    anywhere before finds the same keys when it is run again with the same list.
    """
    with scratch(spark) as keep:
        deletes = keep(sources.read_deletes(spark, deletes_path), "deletes")
        accounts, customers, transactions = map(_current, [spark] * 3, targets, tables)
        keys = keep(changes.removal_keys(accounts, deletes), "removal_keys")
        unmatched = materialize(changes.delete_unmatched(accounts, deletes), "delete_unmatched")
        written = replace(
            [
                (changes.delete_transactions(transactions, deletes), targets.transactions),
                (changes.remove_customers(customers, keys), targets.customers),
                (changes.remove_accounts(accounts, keys), targets.accounts),
            ]
        )
    return Deleted(Entities(*reversed(written)), unmatched)


def counted_reports(
    owned: DataFrame, act: DataFrame, customers: DataFrame, spark: SparkSession
) -> dict[str, DataFrame]:
    """The reports that read accounts and transactions as counts: ``accounts_per_customer`` and
    ``activity`` by transaction and account type."""
    active = act.select("Customer_ID").distinct()
    salary = bounds(customers, active, reports.SALARY)
    score = bounds(customers, active, reports.CREDIT_SCORE)
    return {
        "churn_by_age_gender": reports.age_gender_report(spark, owned, customers),
        "churn_by_gender": reports.gender_report(spark, owned, customers),
        "churn_by_country": reports.country_report(spark, owned, customers),
        "churn_by_txn_type": reports.txn_type_report(act, customers),
        "churn_by_tenure": reports.tenure_report(act, customers),
        "salary_bounds": salary,
        "salary_ranges": reports.band_table(salary, "salary", reports.SALARY_WIDTH),
        "churn_by_salary_range": reports.salary_report(act, customers),
        "credit_score_bounds": score,
        "credit_score_ranges": reports.band_table(
            score, "credit_score", reports.CREDIT_SCORE_WIDTH
        ),
        "churn_by_credit_score_range": reports.credit_score_report(act, customers),
        "churn_by_account_type": reports.account_type_report(act, customers),
    }


def analyse(spark: SparkSession, tables: Entities) -> dict[str, DataFrame]:
    """All reports over the clean tables.

    Accounts per customer, and the join of accounts and transactions by every column a report
    groups by, are counted once and written to the shared folder. The reports read these counts,
    so the transactions are scanned once.
    """
    accounts, customers, transactions = tables
    owned = materialize(reports.accounts_per_customer(accounts), "accounts_per_customer")
    act = materialize(
        activity(clean.encode_churn(accounts), transactions, "Transaction_Type", "Account_Type"),
        "activity",
    )
    return {
        "churn_by_balance_range": reports.churn_by_balance_range(spark, accounts),
        "churn_counts": reports.churn_counts(spark, accounts),
        **counted_reports(owned, act, customers, spark),
    }
