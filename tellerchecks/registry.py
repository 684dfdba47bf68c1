"""One callable per query: (spark, directory of Parquet tables) -> DataFrame."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.operators import audit, changes, clean, intervals, joins, rejects
from tellerflow.plans import bank, jobs, reports
from tellerflow.plans.jobs import Entities
from tellerflow.sinks.releases import Store
from tellerflow.sinks.shared import shared_folder
from tellerflow.sources import roles

Query = Callable[[SparkSession, str], DataFrame]


def _accounts(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_accounts(roles.accounts_raw(s, d))


def _customers(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_customers(roles.customers_raw(s, d))


def _transactions(s: SparkSession, d: str) -> DataFrame:
    return clean.clean_transactions(roles.transactions_raw(s, d))


def _tables(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three clean tables with churn encoded."""
    return clean.encode_churn(_accounts(s, d)), _customers(s, d), _transactions(s, d)


def _banded(s: SparkSession, d: str, column: str, name: str, width: int) -> DataFrame:
    tables = _tables(s, d)
    accounts, customers, transactions = tables
    ends = joins.bounds(customers, joins.active_customers(accounts, transactions), {column: name})
    j = joins.account_customer_txn(*tables)
    return reports.with_band(j, ends, column, name, width).select(
        "Account_ID", "Customer_ID", "churn", column, "Transaction_ID", f"{name}_range"
    )


def _year_2001(column: str) -> tuple[str, str]:
    """Two complementary tests of a stored date; NULL is old."""
    first, next_ = "TIMESTAMP_NTZ'2001-01-01'", "TIMESTAMP_NTZ'2002-01-01'"
    return (
        f"{column} < {first} OR {column} >= {next_} OR {column} IS NULL",
        f"{column} >= {first} AND {column} < {next_}",
    )


def _incremental(raw: Callable[..., DataFrame], old: str, new: str, cleaning):
    """Load the old rows, then append the new ones, each cleaned on its own.

    Both sides test a stored column, so each scan skips row groups of the other side.
    """
    return lambda s, d: changes.append(cleaning(raw(s, d, old)), cleaning(raw(s, d, new)))


def _read_and_clean() -> dict[str, Query]:
    return {
        "preview_accounts": lambda s, d: audit.preview(_accounts(s, d), 5, ["Account_ID"]),
        "preview_customers": lambda s, d: audit.preview(_customers(s, d), 30, ["Customer_ID"]),
        "preview_transactions": lambda s, d: audit.preview(
            _transactions(s, d), 20, ["Transaction_ID"]
        ),
        "row_count_accounts": lambda s, d: audit.row_count(roles.accounts_raw(s, d)),
        "clean_accounts": _accounts,
        "clean_customers": _customers,
        "clean_transactions": _transactions,
        "encode_churn": lambda s, d: clean.encode_churn(_accounts(s, d)),
        "mean_age": lambda s, d: clean.mean_age(roles.customers_raw(s, d)),
        "dedup_customers": lambda s, d: clean.distinct_customers(roles.customers_raw(s, d)),
    }


def _audits() -> dict[str, Query]:
    def settled(s: SparkSession, d: str) -> DataFrame:
        return clean.fill_mean_age(clean.normalise_gender(roles.customers_raw(s, d)))

    return {
        "null_audit_accounts": lambda s, d: audit.rows_with_nulls(
            clean.parse_account_dates(roles.accounts_raw(s, d))
        ),
        "null_audit_customers": lambda s, d: audit.rows_with_nulls(roles.customers_raw(s, d)),
        "null_audit_transactions": lambda s, d: audit.rows_with_nulls(
            roles.transactions_raw(s, d)
        ),
        "duplicate_customers": lambda s, d: audit.duplicate_rows(settled(s, d)),
        "profile_credit_card_raw": lambda s, d: audit.value_profile(
            roles.accounts_raw(s, d), "Credit_Card"
        ),
        "profile_credit_card_clean": lambda s, d: audit.value_profile(
            _accounts(s, d), "Credit_Card"
        ),
        "profile_gender_raw": lambda s, d: audit.value_profile(roles.customers_raw(s, d), "Gender"),
        "profile_gender_clean": lambda s, d: audit.value_profile(
            clean.normalise_gender(roles.customers_raw(s, d)), "Gender"
        ),
        "profile_employment_raw": lambda s, d: audit.value_profile(
            clean.distinct_customers(roles.customers_raw(s, d)), "Employment_Status"
        ),
        "profile_employment_clean": lambda s, d: audit.value_profile(
            _customers(s, d), "Employment_Status"
        ),
        "profile_txn_type_raw": lambda s, d: audit.value_profile(
            roles.transactions_raw(s, d), "Transaction_Type"
        ),
        "profile_txn_type_clean": lambda s, d: audit.value_profile(
            _transactions(s, d), "Transaction_Type"
        ),
    }


def _raw(s: SparkSession, d: str) -> Entities:
    return Entities(roles.accounts_raw(s, d), roles.customers_raw(s, d), roles.transactions_raw(s, d))


def _null_counts(s: SparkSession, d: str) -> DataFrame:
    frames = [audit.null_counts(df, name) for name, df in _raw(s, d)._asdict().items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _load_audits() -> dict[str, Query]:
    """Checks of a load that share one read of each table."""
    return {
        "rejected_accounts": _rejected_accounts,
        "load_null_counts": _null_counts,
        "load_profiles_accounts": lambda s, d: jobs.load_profiles(_raw(s, d)).accounts,
        "load_profiles_customers": lambda s, d: jobs.load_profiles(_raw(s, d)).customers,
        "load_profiles_transactions": lambda s, d: jobs.load_profiles(_raw(s, d)).transactions,
    }


def _rejected_accounts(s: SparkSession, d: str) -> DataFrame:
    rules, row = rejects.cleaning_rules("accounts"), F.col("Account_ID").cast("string")
    return rejects.rejected_by_rules(roles.accounts_raw(s, d), rules, row)


def _changes() -> dict[str, Query]:
    return {
        "phone_update": lambda s, d: changes.update_phone_numbers(
            _customers(s, d), roles.updates(s, d)
        ),
        "doomed_customers": lambda s, d: changes.doomed_customers(
            _accounts(s, d), roles.deletes(s, d)
        ),
        "delete_accounts": lambda s, d: changes.delete_accounts(
            _accounts(s, d), roles.deletes(s, d)
        ),
        "delete_customers": lambda s, d: changes.delete_customers(
            _accounts(s, d), _customers(s, d), roles.deletes(s, d)
        ),
        "delete_transactions": lambda s, d: changes.delete_transactions(
            _transactions(s, d), roles.deletes(s, d)
        ),
        "delete_unmatched": lambda s, d: changes.delete_unmatched(
            _accounts(s, d), roles.deletes(s, d)
        ),
        "orphan_transactions": lambda s, d: changes.orphan_transactions(
            _accounts(s, d), _transactions(s, d), roles.deletes(s, d)
        ),
        "incremental_accounts": _incremental(
            roles.accounts_raw, *_year_2001("o_orderdate"), clean.clean_accounts
        ),
        "incremental_customers": _incremental(
            roles.customers_raw, "c_nationkey <> 7", "c_nationkey = 7", clean.clean_customers
        ),
        "incremental_transactions": _incremental(
            roles.transactions_raw, *_year_2001("l_shipdate"), clean.clean_transactions
        ),
    }


def _folder(s: SparkSession) -> str:
    """The shared folder. Where none is set, a temporary one serves on local[n], and elsewhere one in
    the warehouse, which executors share too. It is set on the context: Spark refuses to set
    ``spark.checkpoint.dir`` in a session."""
    context = s.sparkContext
    if not s.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        if re.fullmatch(r"local(\[.*\])?", context.master):
            folder = os.path.realpath(tempfile.mkdtemp(prefix="bank-"))
        else:
            folder = s.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(folder)
    return shared_folder(s)


def _store(s: SparkSession, d: str, tables: Entities | None = None) -> Store:
    """A store of releases with the three clean tables, in the shared folder."""
    store = bank.open_store(s, f"{_folder(s)}/bank-{uuid4().hex}", 16)
    bank.replace_tables(store, tables or Entities(_accounts(s, d), _customers(s, d), _transactions(s, d)))
    return store


def _left_in_store(table: str) -> Query:
    def query(s: SparkSession, d: str) -> DataFrame:
        store = _store(s, d)
        bank.remove_listed(store, roles.deletes(s, d))
        return store.read()[table]

    return query


def _updated_in_store(s: SparkSession, d: str) -> DataFrame:
    store = _store(s, d)
    bank.change_phone_numbers(store, roles.updates(s, d))
    return store.read()["customers"]


def _added_in_store(s: SparkSession, d: str) -> DataFrame:
    """The batch comes twice and is added once."""
    old, new = _year_2001("l_shipdate")
    known, empty = Entities(_accounts(s, d), _customers(s, d), None), "1 = 0"
    store = _store(s, d, known._replace(
        transactions=clean.clean_transactions(roles.transactions_raw(s, d, old))))
    batch = Entities(
        known.accounts.filter(empty), known.customers.filter(empty),
        clean.clean_transactions(roles.transactions_raw(s, d, new)),
    )
    for _ in range(2):
        bank.add_tables(store, batch, "2001")
    return store.read()["transactions"]


def _releases() -> dict[str, Query]:
    """The changes on a store of releases; the results are those of the whole rewrites."""
    return {
        "store_phone_update": _updated_in_store,
        "store_delete_accounts": _left_in_store("accounts"),
        "store_delete_customers": _left_in_store("customers"),
        "store_delete_transactions": _left_in_store("transactions"),
        "store_incremental_transactions": _added_in_store,
    }


def _score_tolerance_join(s: SparkSession, d: str) -> DataFrame:
    """Bands that a customer's credit score may lie in, give or take a point for each year."""
    people = _customers(s, d).selectExpr(
        "Customer_ID", "Credit_Score - Tenure AS least_score", "Credit_Score + Tenure AS most_score"
    )
    bands = reports.credit_score_ranges(*_tables(s, d))
    ends = intervals.Ends("least_score", "most_score"), intervals.Ends("min_credit_score", "max_credit_score")
    return intervals.interval_join(people, bands, *ends, unit=8).select(
        "Customer_ID", "least_score", "most_score", "credit_score_range"
    )


def _reports() -> dict[str, Query]:
    return {
        "churn_by_balance_range": lambda s, d: reports.churn_by_balance_range(s, _accounts(s, d)),
        "churn_by_age_gender": lambda s, d: reports.churn_by_age_gender(
            s, _accounts(s, d), _customers(s, d)
        ),
        "churn_counts": lambda s, d: reports.churn_counts(s, _accounts(s, d)),
        "churn_by_gender": lambda s, d: reports.churn_by_gender(
            s, _accounts(s, d), _customers(s, d)
        ),
        "churn_by_country": lambda s, d: reports.churn_by_country(
            s, _accounts(s, d), _customers(s, d)
        ),
        "account_customer_txn": lambda s, d: joins.account_customer_txn(*_tables(s, d)),
        "churn_by_txn_type": lambda s, d: reports.churn_by_txn_type(*_tables(s, d)),
        "churn_by_tenure": lambda s, d: reports.churn_by_tenure(*_tables(s, d)),
        "salary_bounds": lambda s, d: reports.salary_bounds(*_tables(s, d)),
        "salary_ranges": lambda s, d: reports.salary_ranges(*_tables(s, d)),
        "salary_range_join": lambda s, d: _banded(
            s, d, "Estimated_Salary", "salary", reports.SALARY_WIDTH
        ),
        "churn_by_salary_range": lambda s, d: reports.churn_by_salary_range(*_tables(s, d)),
        "credit_score_bounds": lambda s, d: reports.credit_score_bounds(*_tables(s, d)),
        "credit_score_ranges": lambda s, d: reports.credit_score_ranges(*_tables(s, d)),
        "credit_score_range_join": lambda s, d: _banded(
            s, d, "Credit_Score", "credit_score", reports.CREDIT_SCORE_WIDTH
        ),
        "score_tolerance_join": _score_tolerance_join,
        "churn_by_credit_score_range": lambda s, d: reports.churn_by_credit_score_range(
            *_tables(s, d)
        ),
        "churn_by_account_type": lambda s, d: reports.churn_by_account_type(*_tables(s, d)),
    }


def queries() -> dict[str, Query]:
    return {**_read_and_clean(), **_audits(), **_load_audits(), **_changes(), **_releases(), **_reports()}
