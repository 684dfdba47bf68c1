"""The churn reports.

The first five read ``Churn`` as text; the others take accounts after ``encode_churn``, with
``churn`` as 0/1, and count transactions: a customer weighs as much as it has transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.functions import (
    AGE_BANDS,
    BALANCE_BANDS,
    band_id,
    band_label,
    first_band_id,
    inside_band,
)
from tellerflow.operators.joins import (
    active_customers,
    activity,
    bounds,
    by_churn,
    customer_activity,
)

# Band widths. Below, the banded columns and the names their bands go by.
SALARY_WIDTH = 1000
CREDIT_SCORE_WIDTH = 100
SALARY = {"Estimated_Salary": "salary"}
CREDIT_SCORE = {"Credit_Score": "credit_score"}


def register_views(accounts: DataFrame, customers: DataFrame, transactions: DataFrame) -> None:
    """Name the three tables for SQL text of the user's own."""
    accounts.createOrReplaceTempView("accounts")
    customers.createOrReplaceTempView("customers")
    transactions.createOrReplaceTempView("transactions")


# ---- SQL reports -----------------------------------------------------------------------------


def churn_by_balance_range(spark: SparkSession, accounts: DataFrame) -> DataFrame:
    return spark.sql(
        f"""
        SELECT {BALANCE_BANDS} AS Balance_Range, Churn, COUNT(*) AS Count
        FROM {{accounts}} GROUP BY 1, 2 ORDER BY 1, 2
        """,
        accounts=accounts,
    )


def churn_counts(spark: SparkSession, accounts: DataFrame) -> DataFrame:
    return spark.sql(
        "SELECT Churn AS churn, COUNT(*) AS count FROM {accounts} GROUP BY Churn",
        accounts=accounts,
    )


def accounts_per_customer(accounts: DataFrame) -> DataFrame:
    """``Customer_ID, Churn, n``: what the reports below need to know of the accounts.

    Accounts meet customers on a key that one customer may dominate. Counted first, at most a
    few rows per customer take part in the join.
    """
    return accounts.groupBy("Customer_ID", "Churn").agg(F.count("*").alias("n"))


def age_gender_report(spark: SparkSession, owned: DataFrame, customers: DataFrame) -> DataFrame:
    return spark.sql(
        f"""
        SELECT c.Age_Range, c.Gender, a.Churn, SUM(c.n * a.n) AS Count
        FROM (SELECT Customer_ID, {AGE_BANDS} AS Age_Range, Gender, COUNT(*) AS n
              FROM {{customers}} GROUP BY 1, 2, 3) c
        JOIN {{owned}} a ON c.Customer_ID = a.Customer_ID
        GROUP BY c.Age_Range, c.Gender, a.Churn
        ORDER BY c.Age_Range, c.Gender, a.Churn
        """,
        owned=owned,
        customers=customers,
    )


def gender_report(spark: SparkSession, owned: DataFrame, customers: DataFrame) -> DataFrame:
    return spark.sql(
        """
        SELECT c.Gender AS gender, a.Churn AS churn, SUM(c.n * a.n) AS count
        FROM (SELECT Customer_ID, Gender, COUNT(*) AS n FROM {customers} GROUP BY 1, 2) c
        JOIN {owned} a ON c.Customer_ID = a.Customer_ID
        GROUP BY c.Gender, a.Churn ORDER BY c.Gender, a.Churn
        """,
        owned=owned,
        customers=customers,
    )


def country_report(spark: SparkSession, owned: DataFrame, customers: DataFrame) -> DataFrame:
    """``total_customers`` counts accounts, not customers."""
    return spark.sql(
        """
        SELECT c.Country AS country, SUM(c.n * a.n) AS total_customers,
               SUM(CASE WHEN a.Churn = 'Yes' THEN c.n * a.n ELSE 0 END) AS churn_count
        FROM (SELECT Customer_ID, Country, COUNT(*) AS n FROM {customers} GROUP BY 1, 2) c
        JOIN {owned} a ON c.Customer_ID = a.Customer_ID
        GROUP BY c.Country ORDER BY c.Country
        """,
        owned=owned,
        customers=customers,
    )


def churn_by_age_gender(
    spark: SparkSession, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    return age_gender_report(spark, accounts_per_customer(accounts), customers)


def churn_by_gender(spark: SparkSession, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return gender_report(spark, accounts_per_customer(accounts), customers)


def churn_by_country(spark: SparkSession, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return country_report(spark, accounts_per_customer(accounts), customers)


# ---- reports over J --------------------------------------------------------------------------
# Each takes ``act``, the result of ``activity`` by the columns the report groups by, or by more.


def txn_type_report(act: DataFrame, customers: DataFrame) -> DataFrame:
    counts = customer_activity(act, customers, ["Transaction_Type"], {})
    return by_churn(counts, "transaction_count").select(
        "Transaction_Type", F.col("churn").alias("Churn"), "transaction_count"
    )


def account_type_report(act: DataFrame, customers: DataFrame) -> DataFrame:
    counts = customer_activity(act, customers, ["Account_Type"], {})
    return by_churn(counts, "count").select("Account_Type", F.col("churn").alias("Churn"), "count")


def tenure_report(act: DataFrame, customers: DataFrame) -> DataFrame:
    counts = customer_activity(act, customers, [], {"tenure": F.col("Tenure")})
    return by_churn(counts, "count").orderBy("tenure")


def _label(band: Column, inside: Column, first: Column, width: int) -> Column:
    return F.when(inside & (band >= first), band_label(band, width))


def with_band(
    df: DataFrame, ends: DataFrame, column: str, name: str, width: int
) -> DataFrame:
    """``df`` with the label of the generated band of ``column`` as ``<name>_range``.

    Only the first band depends on other rows; it is a scalar from ``ends``, the bounds of the
    column, so ``df`` is neither joined nor shuffled for its labels.
    """
    low = F.col(f"min_{name}")
    single = dict(ends.dtypes)[f"min_{name}"] == "float"
    first = ends.select(first_band_id(low, width, single)).scalar()
    x = F.col(column)
    return df.withColumn(
        f"{name}_range", _label(band_id(x, width), inside_band(x, width), first, width)
    )


def band_report(
    act: DataFrame, customers: DataFrame, column: str, width: int, label: str
) -> DataFrame:
    """``label, churn_count, total_customers`` per generated band of a customer column.

    Both numbers count transactions. Values in a gap, unknown, non-finite and huge values and the
    band cut off at a negative smallest value form the group with a NULL label. Sorted by the label's text.

    The band of a row follows from its value, so no band table is joined. Only the id of the
    first band depends on all rows: it is the smallest over the counted groups. The test on
    ``txn_count`` holds for every group; it keeps that subquery on the same columns as the
    report, so Spark shuffles and counts once for both.
    """
    x = F.col(column)
    single = dict(customers.dtypes)[column] == "float"
    counts = customer_activity(
        act,
        customers,
        [],
        {
            "_band": band_id(x, width),
            "_inside": inside_band(x, width),
            "_start": first_band_id(x, width, single),
        },
    )
    occurring = (F.col("txn_count") > 0) & (F.col("churned_txn_count") >= 0)
    first = counts.filter(occurring).agg(F.min("_start")).scalar()
    labelled = _label(F.col("_band"), F.col("_inside"), first, width)
    return (
        counts.groupBy(labelled.alias(label))
        .agg(
            F.sum("churned_txn_count").alias("churn_count"),
            F.sum("txn_count").alias("total_customers"),
        )
        .orderBy(label)
    )


def salary_report(act: DataFrame, customers: DataFrame) -> DataFrame:
    return band_report(act, customers, "Estimated_Salary", SALARY_WIDTH, "salary_range")


def credit_score_report(act: DataFrame, customers: DataFrame) -> DataFrame:
    report = band_report(
        act, customers, "Credit_Score", CREDIT_SCORE_WIDTH, "credit_score_range"
    )
    return report.select("credit_score_range", "total_customers", "churn_count")


def churn_by_txn_type(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return txn_type_report(activity(accounts, transactions, "Transaction_Type"), customers)


def churn_by_account_type(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return account_type_report(activity(accounts, transactions, "Account_Type"), customers)


def churn_by_tenure(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return tenure_report(activity(accounts, transactions), customers)


def churn_by_salary_range(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return salary_report(activity(accounts, transactions), customers)


def churn_by_credit_score_range(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return credit_score_report(activity(accounts, transactions), customers)


# ---- bounds and band tables ------------------------------------------------------------------


def salary_bounds(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return bounds(customers, active_customers(accounts, transactions), SALARY)


def credit_score_bounds(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return bounds(customers, active_customers(accounts, transactions), CREDIT_SCORE)


#: Bands made by one row of the first step of ``band_table``.
BANDS_PER_BLOCK = 4096


def band_table(ends: DataFrame, name: str, width: int) -> DataFrame:
    """``min_<name>, max_<name>, <name>_range`` for the bands between the bounds, plus one.

    Made in two steps, blocks of ids and then the ids of each block, with the blocks dealt out
    between them: no task or row holds all ids.
    """
    single = dict(ends.dtypes)[f"min_{name}"] == "float"
    first, last = (first_band_id(F.col(f"{end}_{name}"), width, single) for end in ("min", "max"))
    span = ends.select(first.alias("first"), (last + 1).alias("last"))
    blocks = F.sequence(
        F.floor(F.col("first") / BANDS_PER_BLOCK), F.floor(F.col("last") / BANDS_PER_BLOCK)
    )
    start = F.col("block") * BANDS_PER_BLOCK
    ids = F.sequence(
        F.greatest("first", start), F.least("last", start + (BANDS_PER_BLOCK - 1))
    )
    return (
        span.select("first", "last", F.explode(blocks).alias("block"))
        .repartition("block")
        .select(F.explode(ids).alias("id"))
        .select(
            (F.col("id") * width).alias(f"min_{name}"),
            (F.col("id") * width + (width - 1)).alias(f"max_{name}"),
            band_label(F.col("id"), width).alias(f"{name}_range"),
        )
    )


def salary_ranges(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return band_table(salary_bounds(accounts, customers, transactions), "salary", SALARY_WIDTH)


def credit_score_ranges(
    accounts: DataFrame, customers: DataFrame, transactions: DataFrame
) -> DataFrame:
    return band_table(
        credit_score_bounds(accounts, customers, transactions), "credit_score", CREDIT_SCORE_WIDTH
    )
