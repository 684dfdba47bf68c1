"""Counts over the join against the join built row by row, on random small tables."""

import random
from collections import Counter

import pytest

import helpers
from tellerflow.operators import clean, joins
from tellerflow.plans import reports


def random_tables(spark, seed):
    """Repeated ids on every side, unknown ids and NULL keys."""
    r = random.Random(seed)
    ids = [None, 1, 2, 3, 4]
    accounts = [
        {
            "Account_ID": r.choice(ids),
            "Customer_ID": r.choice(ids),
            "Account_Type": r.choice("AB"),
            "Churn": r.choice(["Yes", "No", None]),
        }
        for _ in range(12)
    ]
    customers = [
        {
            "Customer_ID": r.choice(ids),
            "Tenure": r.choice([1, 2, None]),
            "Gender": r.choice(["Male", None]),
            "Country": r.choice(["X", "Y"]),
            "Estimated_Salary": r.choice([-700.0, 999.5, 1000.0, 2500.0, None]),
            "Credit_Score": r.choice([-150, -100, 99, 100, 850, None]),
        }
        for _ in range(8)
    ]
    transactions = [
        {"Account_ID": r.choice(ids), "Transaction_Type": r.choice(["In", "Out", None])}
        for _ in range(15)
    ]
    return accounts, customers, transactions


@pytest.mark.parametrize("seed", range(3))
def test_reports_against_nested_loops(spark, rows, seed):
    a, c, t = random_tables(spark, seed)
    owned = [(x, y) for x in a for y in c if x["Customer_ID"] == y["Customer_ID"] is not None]
    j = [(x, y, z) for x, y in owned for z in t if x["Account_ID"] == z["Account_ID"] is not None]
    accounts, customers = helpers.accounts(spark, *a), helpers.customers(spark, *c)
    args = clean.encode_churn(accounts), customers, helpers.transactions(spark, *t)

    def want(items, key):
        counts = Counter(map(key, items))
        return sorted(((*k, n) for k, n in counts.items()), key=repr)

    def churned(x):
        return int(x["Churn"] == "Yes")

    assert joins.account_customer_txn(*args).count() == len(j)
    assert rows(reports.churn_by_txn_type(*args)) == want(
        j, lambda r: (r[2]["Transaction_Type"], churned(r[0]))
    )
    assert rows(reports.churn_by_account_type(*args)) == want(
        j, lambda r: (r[0]["Account_Type"], churned(r[0]))
    )
    assert rows(reports.churn_by_tenure(*args)) == want(
        j, lambda r: (r[1]["Tenure"], churned(r[0]))
    )
    assert rows(reports.churn_by_gender(spark, accounts, customers)) == want(
        owned, lambda r: (r[1]["Gender"], r[0]["Churn"])
    )
    assert rows(
        reports.churn_by_country(spark, accounts, customers).select("country", "total_customers")
    ) == want(owned, lambda r: (r[1]["Country"],))
    for column, report, width in (
        ("Estimated_Salary", reports.churn_by_salary_range, 1000),
        ("Credit_Score", reports.churn_by_credit_score_range, 100),
    ):
        known = [y[column] for _, y, _ in j if y[column] is not None]
        first, last = int(min(known) / width), int(max(known) / width) + 1

        def label(value):
            for low in range(width * first, width * last + 1, width):
                if value is not None and low <= value <= low + width - 1:
                    return f"{low}-{low + width - 1}"
            return None

        got = report(*args)
        assert rows(got.select(got.columns[0], "total_customers")) == want(
            j, lambda r: (label(r[1][column]),)
        )
        assert sum(helpers.column(got, "churn_count")) == sum(churned(x) for x, _, _ in j)
