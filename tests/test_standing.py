"""Reports kept up by difference equal those from scratch."""

import pytest

import helpers
from tellerflow.operators import changes, clean
from tellerflow.operators.joins import activity
from tellerflow.plans import jobs, reports, standing
from tellerflow.plans.jobs import Entities

KINDS = ("debit", "credit", None)


def accounts(spark, ids):
    return helpers.accounts(spark, *(
        {"Account_ID": None if i == 13 else i // 2 * 2 if i % 5 == 0 else i,
         "Customer_ID": None if i % 11 == 0 else i % 7, "Account_Type": f"type{i % 3}",
         "Churn": ("Yes", "No", None)[i % 3]} for i in ids))


def transactions(spark, ids):
    return helpers.transactions(spark, *(
        {"Transaction_ID": i, "Account_ID": None if i % 17 == 0 else 4 if i % 3 == 0 else i % 40,
         "Transaction_Type": KINDS[i % 3]} for i in ids))


@pytest.fixture
def customers(spark):
    return helpers.customers(spark, *(
        {"Customer_ID": i, "Credit_Score": 400 + 60 * i, "Estimated_Salary": 9000.0 * i, "Age": 20 + 9 * i,
         "Gender": ("Male", "Female")[i % 2], "Tenure": i} for i in (0, 1, 2, 2, 3, 4, 5)))


def same(rows, store, tables):
    """The counts that the reports read equal those of all rows."""
    counts, by = store.read(), ("Transaction_Type", "Account_Type")
    act = activity(clean.encode_churn(tables.accounts), tables.transactions, *by)
    assert rows(counts["activity"]) == rows(act)
    assert rows(counts["owned"]) == rows(reports.accounts_per_customer(tables.accounts))


def test_load_increment_and_delete(spark, tmp_path, rows, customers):
    store = standing.open_counts(spark, str(tmp_path / "counts"), 8)
    old = Entities(accounts(spark, range(30)), None, transactions(spark, range(200)))
    standing.change(store, added=old, batch="first")
    same(rows, store, old)

    # Transactions of accounts that are there, accounts that transactions wait for, and both.
    more = Entities(accounts(spark, range(25, 45)), None, transactions(spark, range(200, 260)))
    for _ in range(2):
        release = standing.change(store, added=more, batch="second")
    assert release.number == 2 and set(release.batches) == {"first", "second"}
    now = Entities(old.accounts.unionByName(more.accounts), None,
                   old.transactions.unionByName(more.transactions))
    same(rows, store, now)
    want = jobs.analyse(spark, now._replace(customers=customers))
    found = standing.reports_of(store, customers)
    assert len(found) == 12
    for name in ("churn_by_gender", "churn_by_txn_type", "churn_by_salary_range", "salary_bounds"):
        assert rows(found[name]) == rows(want[name]), name

    deletes = spark.createDataFrame([(4,), (9,), (999,)], "Account_ID long")
    left = Entities(changes.delete_accounts(now.accounts, deletes), None,
                    changes.delete_transactions(now.transactions, deletes))
    gone = Entities(*(None if a is None else a.exceptAll(b) for a, b in zip(now, left)))
    standing.change(store, removed=gone)
    same(rows, store, left)
    standing.change(store, removed=left)
    assert all(df.count() == 0 for df in store.read().values())


def test_one_table_alone_and_only_touched_buckets(spark, tmp_path, rows):
    store = standing.open_counts(spark, str(tmp_path / "counts"), 16)
    old = Entities(accounts(spark, range(30)), None, transactions(spark, range(200)))
    first = standing.change(store, added=old)
    one = transactions(spark, [201])
    second = standing.change(store, added=Entities(None, None, one))
    same(rows, store, old._replace(transactions=old.transactions.unionByName(one)))
    for table in ("accounts", "owned"):
        assert second.of(table) == first.of(table)
    # Account 4, of the new transaction, is listed for two customers.
    for table, touched in (("transactions", 1), ("activity", 2)):
        assert len(set(first.of(table)) - set(second.of(table))) == touched
    assert standing.change(store) == second


def test_removing_what_is_not_there_changes_nothing(spark, tmp_path):
    store = standing.open_counts(spark, str(tmp_path / "counts"), 4)
    standing.change(store, added=Entities(accounts(spark, range(5)), None, None))
    with pytest.raises(Exception, match="more rows removed"):
        standing.change(store, removed=Entities(accounts(spark, range(50, 52)), None, None))
    assert store.current().number == 1
