"""Physical plans: what is read, what is pushed down, what must not occur."""

import re

import pytest

import helpers
from tellerchecks.registry import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(plan):
    """Columns read, per scan."""
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return [set(re.findall(r"(\w+)#", columns)) for columns in scans]


@pytest.mark.parametrize("name", QUERIES)
def test_no_nested_loops_or_python(spark, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("NestedLoop", "Cartesian", "Python", "Pandas", "ExistingRDD", "WindowExec"):
        assert operator not in plan, plan


def test_reports_read_only_their_columns(spark):
    plan = plan_of(QUERIES["churn_by_balance_range"](spark, SF_DIR))
    assert scanned(plan) == [{"o_orderkey", "o_orderstatus", "o_totalprice"}]
    plan = plan_of(QUERIES["churn_by_account_type"](spark, SF_DIR))
    assert {"l_orderkey"} in scanned(plan)
    assert {"o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"} in scanned(plan)


def test_key_filters_reach_the_files(spark):
    plan = QUERIES["churn_by_txn_type"](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


@pytest.mark.parametrize("name", ["churn_by_salary_range", "churn_by_credit_score_range"])
@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_band_reports_read_the_big_tables_once(spark, conf, name, threshold):
    """The first band id comes from counts that were already shuffled for the report."""
    conf(
        spark__sql__autoBroadcastJoinThreshold=threshold,
        spark__sql__adaptive__autoBroadcastJoinThreshold=threshold,
    )
    plan = helpers.final_plan(QUERIES[name](spark, SF_DIR))
    for key in ("l_orderkey", "o_orderkey"):
        assert sum(key in columns for columns in scanned(plan)) == 1, plan


def test_mean_age_is_one_value_not_a_join(spark):
    plan = plan_of(QUERIES["clean_customers"](spark, SF_DIR))
    assert "Subquery" in plan
    assert {"c_custkey", "c_nationkey"} in scanned(plan)


def test_preview_is_a_top_n_per_task(spark):
    assert "TakeOrderedAndProject(limit=5" in plan_of(QUERIES["preview_accounts"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["churn_by_account_type", "churn_by_tenure", "salary_bounds"])
def test_accounts_are_shuffled_once_before_their_join(spark, conf, name):
    """One exchange between the accounts scan and the join on the account."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "o_orderkey" in x and "FileScan" in x)
    depth, above = len(lines[scan].split("FileScan")[0]), []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            above.append(line.strip())
            if "Join" in line:
                break
    assert sum("Exchange" in x for x in above) == 1, plan


@pytest.mark.parametrize(
    "name", ["incremental_accounts", "incremental_customers", "incremental_transactions"]
)
def test_both_sides_of_an_increment_are_pruned(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    key = {"incremental_accounts": "o_orderdate", "incremental_customers": "c_nationkey",
           "incremental_transactions": "l_shipdate"}[name]
    scans = [x for x in plan.splitlines() if "FileScan" in x and key in x.split("PushedFilters")[0]]
    assert len(scans) >= 2 and all(key in x.split("PushedFilters")[1] for x in scans), plan
