import random
import re
import struct
from datetime import date

import pytest
from pyspark.sql import functions as F

import helpers
from tellerflow.functions import gender, parse_date, parse_money, round_half_up, yes_no
from tellerflow import schemas
from tellerflow.operators import audit, clean
from tellerflow.schemas import require_schema


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", rule(F.col("v"))).orderBy("i").collect()]


def test_money(spark):
    values = ["£1,200.50", "-5", "1e3", "1.2.3", "abc", "", None]
    assert apply(spark, parse_money, values) == [1200.5, 5.0, 13.0, None, None, None, None]


def test_dates(spark):
    good = ["05/01/2020", "5/1/2020"]
    bad = ["31/02/2020", "2020-01-05", "05/01/20", "05/01/2020 10:00", "", None]
    assert apply(spark, parse_date, good) == [date(2020, 1, 5)] * 2
    assert apply(spark, parse_date, bad) == [None] * len(bad)


def test_money_against_python(spark):
    r = random.Random(1)
    values = ["".join(r.choices("0123456789..,£-e ", k=r.randint(0, 9))) for _ in range(400)]

    def want(text):
        try:
            return struct.unpack("f", struct.pack("f", float(re.sub("[^0-9.]", "", text))))[0]
        except ValueError:
            return None

    assert apply(spark, parse_money, values) == [want(v) for v in values]


def test_dates_against_python(spark):
    r = random.Random(2)
    values = [
        f"{r.randint(0, 33)}/{r.randint(0, 13):02}/{r.randint(1999, 2021)}" for _ in range(400)
    ]
    values += ["".join(r.choices("0123456789/", k=10)) for _ in range(100)]

    def want(text):
        found = re.fullmatch(r"(\d\d?)/(\d\d?)/(\d{4})", text)
        try:
            return date(*map(int, reversed(found.groups()))) if found else None
        except ValueError:
            return None

    assert apply(spark, parse_date, values) == [want(v) for v in values]


def test_categories(spark):
    genders = ["m", "MALE", "f", "Female", " M", "x", None]
    assert apply(spark, gender, genders) == [
        "Male", "Male", "Female", "Female", "Unknown", "Unknown", "Unknown"
    ]
    flags = ["y", "Yes", "n", "NO", "?", None]
    assert apply(spark, yes_no, flags) == ["Yes", "Yes", "No", "No", "Unknown", "Unknown"]


def test_category_rules_are_idempotent(spark):
    for rule, names in ((gender, ["Male", "Female"]), (yes_no, ["Yes", "No"])):
        assert apply(spark, rule, [*names, "Unknown"]) == [*names, "Unknown"]


def test_round_half_up(spark):
    values = [2.5, 2.4, -2.5, -2.6, 45.5]
    assert apply(spark, round_half_up, values, "double") == [3, 2, -2, -3, 46]


def test_mean_age(spark):
    df = helpers.customers(spark, {"Age": 40}, {"Age": 41}, {"Age": None})
    assert helpers.column(clean.mean_age(df), "mean_age") == [41]
    assert sorted(helpers.column(clean.fill_mean_age(df), "Age")) == [40, 41, 41]
    unknown = helpers.customers(spark, {"Age": None}, {"Age": None, "Customer_ID": 2})
    assert helpers.column(clean.clean_customers(unknown), "Age") == [None, None]


def test_customer_steps_run_in_order(spark):
    raw = helpers.customers(
        spark,
        {"Age": 30, "Gender": "m"},
        {"Age": 30, "Gender": "MALE"},  # a copy once gender is settled
        {"Age": 30, "Employment_Status": None},
        {"Age": 30, "Employment_Status": "Unknown"},  # stays beside the row above
        {"Age": 30, "Employment_Status": "Self-Employed", "Country": None},
        {"Age": 30, "Employment_Status": "Self-Employed", "Country": None},  # copy with NULL
        {"Age": None, "Customer_ID": 2},
        {"Age": 60, "Customer_ID": 3},
    )
    got = clean.clean_customers(raw)
    assert sorted(
        tuple(r) for r in got.select("Customer_ID", "Age", "Gender", "Employment_Status").collect()
    ) == [
        (1, 30, "Male", "Employed"),
        (1, 30, "Male", "SelfEmployed"),
        (1, 30, "Male", "Unknown"),
        (1, 30, "Male", "Unknown"),
        (2, 34, "Male", "Employed"),  # (6 * 30 + 60) / 7 counts the copies
        (3, 60, "Male", "Employed"),
    ]


def test_transactions(spark, rows):
    raw = helpers.transactions_raw(
        spark, {"Transaction_Type": "Cash - In"}, {"Transaction_Type": None}, {"Amount": "x"}
    )
    got = clean.clean_transactions(raw).select("Transaction_Type", "Amount")
    assert rows(got) == [("CashIn", 3.0), ("CashIn", None), (None, 3.0)]


def test_clean_schemas(spark):
    require_schema(clean.clean_accounts(helpers.accounts_raw(spark, {})), schemas.ACCOUNTS)
    require_schema(clean.clean_customers(helpers.customers(spark, {})), schemas.CUSTOMERS)
    require_schema(
        clean.clean_transactions(helpers.transactions_raw(spark, {})), schemas.TRANSACTIONS
    )


def test_encode_churn(spark):
    raw = helpers.accounts(spark, {"Churn": "Yes"}, {"Churn": "yes"}, {"Churn": None})
    got = clean.encode_churn(raw)
    assert helpers.column(got, "churn") == [1, 0, 0]
    assert got.columns[-1] == "churn" and len(got.columns) == len(raw.columns)


def test_audits(spark, rows):
    df = helpers.customers(
        spark, {}, {}, {"Name": None}, {"Name": None}, {"Customer_ID": 2, "Gender": None}
    )
    assert audit.rows_with_nulls(df).count() == 3
    assert helpers.column(audit.duplicate_rows(df), "count") == [2, 2]
    assert rows(audit.value_profile(df, "Gender")) == [("m", 4), (None, 1)]
    assert rows(audit.value_profiles(df, ["Gender", "Name"])) == [
        ("Gender", "m", 4), ("Gender", None, 1), ("Name", "n", 3), ("Name", None, 2)
    ]
    assert helpers.column(audit.row_count(df), "row_count") == [5]
    assert helpers.column(audit.preview(df, 2, ["Name", "Customer_ID"]), "Name") == [None, None]


@pytest.mark.parametrize("n", [1, 3])
def test_dedup_keeps_one_of_many(spark, n):
    df = helpers.customers(spark, *[{"Name": None}] * n)
    assert clean.dedup(df).count() == 1
