"""The raw bank tables derived from the order tables of a Parquet directory.

Customers become bank customers, orders become accounts, order lines become transactions. The
values are made dirty on purpose: mixed spellings, currency text, impossible dates, NULLs and
whole-row copies. ``where`` tests stored columns, so that it reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns used of each test table. Declared, so that no job reads footers.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_linenumber INT, l_extendedprice DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
}


def _table(spark: SparkSession, sf_dir: str, name: str, where: str = "true") -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet").filter(where)


def customers_raw(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Customers with their nation; every 50th id occurs twice."""
    joined = _table(spark, sf_dir, "customer", where).join(
        _table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    return joined.selectExpr(
        "CAST(c_custkey AS INT) AS Customer_ID",
        "c_name AS Name",
        "CASE WHEN c_custkey % 17 <> 0 THEN CAST(16 + c_custkey % 60 AS INT) END AS Age",
        "concat(c_custkey, ' High St') AS Address",
        "concat('PC', c_custkey % 99) AS Postcode",
        "concat('0', 7000000000 + c_custkey) AS Phone_Number",
        "concat('c', c_custkey, '@example.com') AS Email",
        "CAST(300 + (c_custkey * 37) % 600 AS INT) AS Credit_Score",
        "CAST(c_custkey % 13 AS INT) AS Tenure",
        "n_name AS Country",
        "CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'male' WHEN 2 THEN 'F' "
        "WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'f' WHEN 6 THEN 'x' END AS Gender",
        "CAST(1 + c_custkey % 4 AS INT) AS Products_number",
        "CASE c_custkey % 5 WHEN 0 THEN 'Self-Employed' WHEN 1 THEN 'Employed' "
        "WHEN 2 THEN 'Un-employed' WHEN 4 THEN 'Retired' END AS Employment_Status",
        "CAST(20000 + c_acctbal * 1.5 AS FLOAT) AS Estimated_Salary",
        "explode(array_repeat(0, IF(c_custkey % 50 = 0, 2, 1))) AS copy",
    ).drop("copy")


def accounts_raw(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    return _table(spark, sf_dir, "orders", where).selectExpr(
        "o_orderkey AS Account_ID",
        "CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_custkey AS INT) END AS Customer_ID",
        "o_orderpriority AS Account_Type",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'n/a' "
        "ELSE concat('£', format_number(o_totalprice / 40, 2)) END AS Balance",
        "date_format(o_orderdate, 'dd/MM/yyyy') AS Open_Date",
        "IF(o_orderkey % 29 = 0, '31/02/2020', date_format(o_orderdate, 'dd/MM/yyyy')) "
        "AS Last_Activity_Date",
        "CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'yes' WHEN 2 THEN 'N' WHEN 3 THEN 'No' "
        "WHEN 5 THEN '?' END AS Credit_Card",
        "IF(o_orderstatus = 'F', 'Yes', 'No') AS Churn",
    )


def transactions_raw(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    return _table(spark, sf_dir, "lineitem", where).selectExpr(
        "l_orderkey * 10 + l_linenumber AS Transaction_ID",
        "l_orderkey AS Account_ID",
        "CASE l_returnflag WHEN 'A' THEN 'Cash-In' WHEN 'N' THEN 'Cash In' "
        "ELSE 'Cash - Out' END AS Transaction_Type",
        "IF(l_tax = 0, NULL, concat('£', format_number(l_extendedprice, 2))) AS Amount",
        "date_format(l_shipdate, 'dd/MM/yyyy') AS Transaction_Date",
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per customer; most carry a wrong old number, some a NULL new one."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS UCustomer_ID",
        "concat('0', 7000000000 + c_custkey + IF(c_custkey % 20 = 0, 0, 1)) AS Old_Phone_Number",
        "IF(c_custkey % 60 = 0, NULL, concat('0', 8000000000 + c_custkey)) AS New_Phone_Number",
    )


def deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts of the dearest orders, each listed twice, an unknown id and a NULL."""
    orders = _table(spark, sf_dir, "orders")
    listed = orders.filter("o_totalprice >= 490000").selectExpr(
        "explode(array(o_orderkey, o_orderkey)) AS Account_ID"
    )
    others = spark.sql("SELECT * FROM VALUES (-1L), (CAST(NULL AS LONG)) AS t(Account_ID)")
    return listed.union(others)
