"""Cleaning of the three entities. Every function is DataFrame in, DataFrame out, and lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions import gender, parse_date, parse_money, round_half_up, strip_chars, yes_no


def parse_account_dates(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {c: parse_date(F.col(c)) for c in ("Open_Date", "Last_Activity_Date")}
    )


def clean_accounts(raw: DataFrame) -> DataFrame:
    return parse_account_dates(raw).withColumns(
        {"Credit_Card": yes_no(F.col("Credit_Card")), "Balance": parse_money(F.col("Balance"))}
    )


def normalise_gender(raw: DataFrame) -> DataFrame:
    return raw.withColumn("Gender", gender(F.col("Gender")))


def mean_age(customers: DataFrame) -> DataFrame:
    """One row: the mean age, halves rounded up; NULL when no age is known."""
    return customers.select(round_half_up(F.avg("Age")).alias("mean_age"))


def fill_mean_age(customers: DataFrame) -> DataFrame:
    """Replace unknown ages by the mean of this frame.

    The mean is a scalar subquery: Spark reads the one column, aggregates it and puts the
    single value into the main plan, so the rows themselves are neither joined nor shuffled.
    """
    return customers.withColumn("Age", F.coalesce("Age", mean_age(customers).scalar()))


def dedup(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows; NULLs count as equal.

    Copies meet in the map-side half of the aggregate, so a row with very many copies leaves
    each task once.
    """
    return df.dropDuplicates()


def distinct_customers(raw: DataFrame) -> DataFrame:
    """Customers with gender and age settled and whole-row copies removed."""
    return dedup(fill_mean_age(normalise_gender(raw)))


def employment_status() -> Column:
    """The employment status as it is stored; unknown ones are named so."""
    return strip_chars(F.coalesce("Employment_Status", F.lit("Unknown")), "-")


def clean_customers(raw: DataFrame) -> DataFrame:
    """Gender, mean age, de-duplication, employment status, in this order.

    The mean counts copies, and rows that differ in the spelling of the employment status
    alone both stay.
    """
    return distinct_customers(raw).withColumn("Employment_Status", employment_status())


def transaction_type() -> Column:
    return strip_chars(F.col("Transaction_Type"), "- ")


def clean_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "Transaction_Type": transaction_type(),
            "Amount": parse_money(F.col("Amount")),
            "Transaction_Date": parse_date(F.col("Transaction_Date")),
        }
    )


def encode_churn(accounts: DataFrame) -> DataFrame:
    """``churn`` as 1 for "Yes" and 0 for everything else, NULL included."""
    return accounts.withColumn("churn", F.when(F.col("Churn") == "Yes", 1).otherwise(0))
