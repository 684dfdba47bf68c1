"""The same queries as plain SQL for an independent engine (DuckDB dialect).

Written from the meaning of each query, not from the Spark plans: reports count rows of the
full join, bands are joined by range, deletes use IN and NOT EXISTS.
"""

from __future__ import annotations

import re

_RELATIONS = {
    "customers_raw": """
        SELECT b.* FROM (
          SELECT CAST(c_custkey AS INT) AS Customer_ID, c_name AS Name,
            CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(16 + c_custkey % 60 AS INT) END AS Age,
            concat(CAST(c_custkey AS VARCHAR), ' High St') AS Address,
            concat('PC', CAST(c_custkey % 99 AS VARCHAR)) AS Postcode,
            concat('0', CAST(7000000000 + c_custkey AS VARCHAR)) AS Phone_Number,
            concat('c', CAST(c_custkey AS VARCHAR), '@example.com') AS Email,
            CAST(300 + (c_custkey * 37) % 600 AS INT) AS Credit_Score,
            CAST(c_custkey % 13 AS INT) AS Tenure, n_name AS Country,
            CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'male' WHEN 2 THEN 'F'
              WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'f' WHEN 5 THEN NULL ELSE 'x' END AS Gender,
            CAST(1 + c_custkey % 4 AS INT) AS Products_number,
            CASE c_custkey % 5 WHEN 0 THEN 'Self-Employed' WHEN 1 THEN 'Employed'
              WHEN 2 THEN 'Un-employed' WHEN 3 THEN NULL ELSE 'Retired' END AS Employment_Status,
            CAST(20000 + c_acctbal * 1.5 AS FLOAT) AS Estimated_Salary
          FROM customer JOIN nation ON c_nationkey = n_nationkey) b
        JOIN (VALUES (1), (50)) AS copies(step) ON b.Customer_ID % copies.step = 0""",
    "accounts_raw": """
        SELECT o_orderkey AS Account_ID,
          CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS Customer_ID,
          o_orderpriority AS Account_Type,
          CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'n/a'
            ELSE concat('£', format('{:,.2f}', o_totalprice / 40)) END AS Balance,
          strftime(o_orderdate, '%d/%m/%Y') AS Open_Date,
          CASE WHEN o_orderkey % 29 = 0 THEN '31/02/2020'
            ELSE strftime(o_orderdate, '%d/%m/%Y') END AS Last_Activity_Date,
          CASE o_orderkey % 6 WHEN 0 THEN 'Y' WHEN 1 THEN 'yes' WHEN 2 THEN 'N' WHEN 3 THEN 'No'
            WHEN 4 THEN NULL ELSE '?' END AS Credit_Card,
          CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS Churn
        FROM orders""",
    "transactions_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS Transaction_ID, l_orderkey AS Account_ID,
          CASE l_returnflag WHEN 'A' THEN 'Cash-In' WHEN 'N' THEN 'Cash In'
            ELSE 'Cash - Out' END AS Transaction_Type,
          CASE WHEN l_tax = 0 THEN NULL
            ELSE concat('£', format('{:,.2f}', l_extendedprice)) END AS Amount,
          strftime(l_shipdate, '%d/%m/%Y') AS Transaction_Date
        FROM lineitem""",
    "updates": """
        SELECT CAST(c_custkey AS INT) AS UCustomer_ID,
          concat('0', CAST(CASE WHEN c_custkey % 20 = 0 THEN 7000000000 + c_custkey
            ELSE 7000000001 + c_custkey END AS VARCHAR)) AS Old_Phone_Number,
          CASE WHEN c_custkey % 60 = 0 THEN NULL
            ELSE concat('0', CAST(8000000000 + c_custkey AS VARCHAR)) END AS New_Phone_Number
        FROM customer""",
    "listed": """
        SELECT o_orderkey AS Account_ID FROM orders WHERE o_totalprice >= 490000
        UNION ALL SELECT -1""",
    "accounts_dated": """
        SELECT * REPLACE (CAST(try_strptime(Open_Date, '%d/%m/%Y') AS DATE) AS Open_Date,
          CAST(try_strptime(Last_Activity_Date, '%d/%m/%Y') AS DATE) AS Last_Activity_Date)
        FROM accounts_raw""",
    "accounts": """
        SELECT * REPLACE (
          TRY_CAST(regexp_replace(Balance, '[^0-9.]', '', 'g') AS FLOAT) AS Balance,
          CASE WHEN upper(Credit_Card) IN ('Y', 'YES') THEN 'Yes'
               WHEN upper(Credit_Card) IN ('N', 'NO') THEN 'No' ELSE 'Unknown' END AS Credit_Card)
        FROM accounts_dated""",
    "customers_gender": """
        SELECT * REPLACE (CASE WHEN upper(Gender) IN ('M', 'MALE') THEN 'Male'
          WHEN upper(Gender) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS Gender)
        FROM customers_raw""",
    "mean_of_ages": "SELECT CAST(floor(avg(Age) + 0.5) AS INT) AS mean_age FROM customers_raw",
    "customers_aged": """
        SELECT * REPLACE (coalesce(Age, (SELECT mean_age FROM mean_of_ages)) AS Age)
        FROM customers_gender""",
    "customers_distinct": "SELECT DISTINCT * FROM customers_aged",
    "customers": """
        SELECT * REPLACE (replace(coalesce(Employment_Status, 'Unknown'), '-', '')
          AS Employment_Status)
        FROM customers_distinct""",
    "transactions": """
        SELECT * REPLACE (
          replace(replace(Transaction_Type, '-', ''), ' ', '') AS Transaction_Type,
          TRY_CAST(regexp_replace(Amount, '[^0-9.]', '', 'g') AS FLOAT) AS Amount,
          CAST(try_strptime(Transaction_Date, '%d/%m/%Y') AS DATE) AS Transaction_Date)
        FROM transactions_raw""",
    "encoded": """
        SELECT * EXCLUDE (Churn), CAST(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS INT) AS churn
        FROM accounts""",
    "joined": """
        SELECT * FROM encoded JOIN customers USING (Customer_ID)
        JOIN transactions USING (Account_ID)""",
    "salary_ends": """
        SELECT min(Estimated_Salary) AS min_salary, max(Estimated_Salary) AS max_salary
        FROM joined""",
    "score_ends": """
        SELECT min(Credit_Score) AS min_credit_score, max(Credit_Score) AS max_credit_score
        FROM joined""",
    "salary_bands": """
        SELECT 1000 * id AS min_salary, 1000 * (id + 1) - 1 AS max_salary,
          concat(CAST(1000 * id AS VARCHAR), '-', CAST(1000 * (id + 1) - 1 AS VARCHAR))
            AS salary_range
        FROM (SELECT unnest(range(
          CAST(trunc(CAST(CAST(min_salary AS DOUBLE) / 1000 AS FLOAT)) AS BIGINT),
          CAST(trunc(CAST(CAST(max_salary AS DOUBLE) / 1000 AS FLOAT)) AS BIGINT) + 2)) AS id
          FROM salary_ends)""",
    "score_bands": """
        SELECT 100 * id AS min_credit_score, 100 * (id + 1) - 1 AS max_credit_score,
          concat(CAST(100 * id AS VARCHAR), '-', CAST(100 * (id + 1) - 1 AS VARCHAR))
            AS credit_score_range
        FROM (SELECT unnest(range(CAST(trunc(min_credit_score / 100) AS BIGINT),
          CAST(trunc(max_credit_score / 100) AS BIGINT) + 2)) AS id FROM score_ends)""",
    "salary_joined": """
        SELECT joined.*, salary_range FROM joined LEFT JOIN salary_bands
        ON CAST(Estimated_Salary AS DOUBLE) BETWEEN min_salary AND max_salary""",
    "score_joined": """
        SELECT joined.*, credit_score_range FROM joined LEFT JOIN score_bands
        ON Credit_Score BETWEEN min_credit_score AND max_credit_score""",
    "doomed": """
        SELECT DISTINCT Customer_ID FROM accounts
        WHERE Customer_ID IS NOT NULL AND Account_ID IN (SELECT Account_ID FROM listed)""",
    "accounts_left": """
        SELECT * FROM accounts a
        WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.Customer_ID = a.Customer_ID)
          AND NOT EXISTS (SELECT 1 FROM listed l WHERE l.Account_ID = a.Account_ID)""",
    "transactions_left": """
        SELECT * FROM transactions t
        WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.Account_ID = t.Account_ID)""",
    "customers_batches": """
        SELECT *, Country = 'NATION_7' AS is_new FROM customers_gender""",
    "batch_means": """
        SELECT is_new, CAST(floor(avg(Age) + 0.5) AS INT) AS mean_age
        FROM customers_batches GROUP BY is_new""",
}

_BALANCE_BAND = """CASE WHEN Balance IS NULL OR Balance < 0 OR Balance > 10000 THEN 'Above 10000'
    WHEN Balance > 5000 THEN '5000 - 10000' WHEN Balance > 1000 THEN '1000 - 5000'
    ELSE '0 - 1000' END"""
_AGE_BAND = """CASE WHEN Age IS NULL OR Age < 18 OR Age > 60 THEN '61+' WHEN Age > 50 THEN '51-60'
    WHEN Age > 40 THEN '41-50' WHEN Age > 30 THEN '31-40' ELSE '18-30' END"""


def _profile(relation: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM {relation} GROUP BY {column}"


def _any_null(relation: str, columns: str) -> str:
    tests = " OR ".join(f"{c} IS NULL" for c in columns.split())
    return f"SELECT * FROM {relation} WHERE {tests}"


_CUSTOMER_COLUMNS = (
    "Customer_ID Name Age Address Postcode Phone_Number Email Credit_Score Tenure Country "
    "Gender Products_number Employment_Status Estimated_Salary"
)

_QUERIES = {
    "preview_accounts": "SELECT * FROM accounts ORDER BY Account_ID NULLS FIRST LIMIT 5",
    "preview_customers": "SELECT * FROM customers ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in _CUSTOMER_COLUMNS.split())
    + " LIMIT 30",
    "preview_transactions": "SELECT * FROM transactions ORDER BY "
    + ", ".join(
        f"{c} NULLS FIRST"
        for c in "Transaction_ID Account_ID Transaction_Type Amount Transaction_Date".split()
    )
    + " LIMIT 20",
    "row_count_accounts": "SELECT count(*) AS row_count FROM accounts_raw",
    "clean_accounts": "SELECT * FROM accounts",
    "clean_customers": "SELECT * FROM customers",
    "clean_transactions": "SELECT * FROM transactions",
    "encode_churn": "SELECT * FROM encoded",
    "mean_age": "SELECT mean_age FROM mean_of_ages",
    "dedup_customers": "SELECT * FROM customers_distinct",
    "null_audit_accounts": _any_null(
        "accounts_dated",
        "Account_ID Customer_ID Account_Type Balance Open_Date Last_Activity_Date Credit_Card "
        "Churn",
    ),
    "null_audit_customers": _any_null("customers_raw", _CUSTOMER_COLUMNS),
    "null_audit_transactions": _any_null(
        "transactions_raw", "Transaction_ID Account_ID Transaction_Type Amount Transaction_Date"
    ),
    "duplicate_customers": "SELECT *, count(*) AS count FROM customers_aged GROUP BY ALL "
    "HAVING count(*) > 1",
    "profile_credit_card_raw": _profile("accounts_raw", "Credit_Card"),
    "profile_credit_card_clean": _profile("accounts", "Credit_Card"),
    "profile_gender_raw": _profile("customers_raw", "Gender"),
    "profile_gender_clean": _profile("customers_gender", "Gender"),
    "profile_employment_raw": _profile("customers_distinct", "Employment_Status"),
    "profile_employment_clean": _profile("customers", "Employment_Status"),
    "profile_txn_type_raw": _profile("transactions_raw", "Transaction_Type"),
    "profile_txn_type_clean": _profile("transactions", "Transaction_Type"),
    "phone_update": """
        SELECT c.* REPLACE (CASE WHEN New_Phone_Number IS NOT NULL THEN New_Phone_Number
          ELSE Phone_Number END AS Phone_Number)
        FROM customers c LEFT JOIN updates u
          ON Customer_ID = UCustomer_ID AND Phone_Number = Old_Phone_Number""",
    "doomed_customers": "SELECT Customer_ID FROM doomed",
    "delete_accounts": "SELECT * FROM accounts_left",
    "delete_customers": """
        SELECT * FROM customers c
        WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.Customer_ID = c.Customer_ID)""",
    "delete_transactions": "SELECT * FROM transactions_left",
    "delete_unmatched": """
        SELECT DISTINCT Account_ID FROM listed
        WHERE Account_ID NOT IN (SELECT Account_ID FROM accounts)""",
    "orphan_transactions": """
        SELECT * FROM transactions_left
        WHERE Account_ID IN (SELECT Account_ID FROM accounts)
          AND Account_ID NOT IN (SELECT Account_ID FROM accounts_left)""",
    "incremental_accounts": "SELECT * FROM accounts",
    "incremental_customers": """
        SELECT DISTINCT * EXCLUDE (is_new, mean_age) REPLACE (
          replace(coalesce(Employment_Status, 'Unknown'), '-', '') AS Employment_Status)
        FROM (SELECT c.* REPLACE (coalesce(Age, mean_age) AS Age), mean_age
              FROM customers_batches c JOIN batch_means USING (is_new))""",
    "incremental_transactions": "SELECT * FROM transactions",
    "churn_by_balance_range": f"""
        SELECT {_BALANCE_BAND} AS Balance_Range, Churn, count(*) AS Count
        FROM accounts GROUP BY 1, 2 ORDER BY 1, 2""",
    "churn_by_age_gender": f"""
        SELECT {_AGE_BAND} AS Age_Range, Gender, Churn, count(*) AS Count
        FROM customers JOIN accounts USING (Customer_ID) GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "churn_counts": "SELECT Churn AS churn, count(*) AS count FROM accounts GROUP BY 1",
    "churn_by_gender": """
        SELECT Gender AS gender, Churn AS churn, count(*) AS count
        FROM customers JOIN accounts USING (Customer_ID) GROUP BY 1, 2 ORDER BY 1, 2""",
    "churn_by_country": """
        SELECT Country AS country, count(*) AS total_customers,
          CAST(sum(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS churn_count
        FROM customers JOIN accounts USING (Customer_ID) GROUP BY 1 ORDER BY 1""",
    "account_customer_txn": "SELECT * FROM joined",
    "churn_by_txn_type": """
        SELECT Transaction_Type, churn AS Churn, count(*) AS transaction_count
        FROM joined GROUP BY 1, 2""",
    "churn_by_tenure": """
        SELECT Tenure AS tenure, churn, count(*) AS count
        FROM joined GROUP BY 1, 2 ORDER BY 1""",
    "salary_bounds": "SELECT min_salary, max_salary FROM salary_ends",
    "salary_ranges": "SELECT min_salary, max_salary, salary_range FROM salary_bands",
    "salary_range_join": """
        SELECT Account_ID, Customer_ID, churn, Estimated_Salary, Transaction_ID, salary_range
        FROM salary_joined""",
    "churn_by_salary_range": """
        SELECT salary_range, CAST(sum(churn) AS BIGINT) AS churn_count,
          count(churn) AS total_customers
        FROM salary_joined GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    "credit_score_bounds": "SELECT min_credit_score, max_credit_score FROM score_ends",
    "credit_score_ranges": """
        SELECT min_credit_score, max_credit_score, credit_score_range FROM score_bands""",
    "credit_score_range_join": """
        SELECT Account_ID, Customer_ID, churn, Credit_Score, Transaction_ID, credit_score_range
        FROM score_joined""",
    "score_tolerance_join": """
        SELECT Customer_ID, Credit_Score - Tenure AS least_score,
          Credit_Score + Tenure AS most_score, credit_score_range
        FROM customers JOIN score_bands
          ON Credit_Score - Tenure <= max_credit_score
          AND min_credit_score <= Credit_Score + Tenure""",
    "churn_by_credit_score_range": """
        SELECT credit_score_range, count(churn) AS total_customers,
          CAST(sum(churn) AS BIGINT) AS churn_count
        FROM score_joined GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    "churn_by_account_type": """
        SELECT Account_Type, churn AS Churn, count(*) AS count FROM joined GROUP BY 1, 2""",
}


def _staged(*parts: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{column}' AS column_name, {column} AS value, count(*) AS count "
        f"FROM {relation} GROUP BY ALL"
        for stage, column, relation in parts
    )


def _null_counts() -> str:
    columns = {
        "accounts": "Account_ID Customer_ID Account_Type Balance Open_Date Last_Activity_Date "
        "Credit_Card Churn",
        "customers": _CUSTOMER_COLUMNS,
        "transactions": "Transaction_ID Account_ID Transaction_Type Amount Transaction_Date",
    }
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{c}' AS column_name, count(*) AS rows, "
        f"count(*) - count({c}) AS nulls FROM {entity}_raw"
        for entity, names in columns.items()
        for c in names.split()
    )


_QUERIES |= {
    "load_null_counts": _null_counts(),
    "load_profiles_accounts": _staged(
        ("raw", "Credit_Card", "accounts_raw"), ("clean", "Credit_Card", "accounts")
    ),
    "load_profiles_customers": _staged(
        ("raw", "Gender", "customers_raw"), ("settled", "Gender", "customers_gender"),
        ("distinct", "Employment_Status", "customers_distinct"),
        ("clean", "Gender", "customers"), ("clean", "Employment_Status", "customers"),
    ),
    "load_profiles_transactions": _staged(
        ("raw", "Transaction_Type", "transactions_raw"), ("clean", "Transaction_Type", "transactions")
    ),
}

_QUERIES["rejected_accounts"] = " UNION ALL ".join(
    f"SELECT CAST(Account_ID AS VARCHAR) AS row, '{column}' AS column_name, "
    f"r.{column} AS raw_text, '{rule}' AS rule "
    f"FROM accounts_raw r JOIN accounts c USING (Account_ID) "
    f"WHERE r.{column} IS NOT NULL AND c.{column} IS NULL"
    for column, rule in (("Balance", "amount of money"), ("Open_Date", "day/month/year"),
                         ("Last_Activity_Date", "day/month/year"))
)

#: Changes on a store of releases give what the whole rewrites give.
_QUERIES |= {
    f"store_{name}": _QUERIES[name]
    for name in ("phone_update", "delete_accounts", "delete_customers", "delete_transactions",
                 "incremental_transactions")
}


def _with_relations(sql: str) -> str:
    """Put the relations a query mentions, directly or through others, in front of it."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in sorted((words & _RELATIONS.keys()) - needed):
            needed.add(name)
            todo.append(_RELATIONS[name])
    ctes = ",\n".join(f"{n} AS ({_RELATIONS[n].strip()})" for n in _RELATIONS if n in needed)
    return f"WITH {ctes}\n{sql.strip()}" if ctes else sql.strip()


def oracle_sql() -> dict[str, str]:
    return {name: _with_relations(sql) for name, sql in _QUERIES.items()}
