import pytest

import helpers
from tellerflow import schemas, sources
from tellerflow.sources import jdbc, roles
from tellerflow.sinks import jdbc as jdbc_sink

ACCOUNT_HEADER = list(helpers.ACCOUNT)


def test_csv_scan_ddl(spark, tmp_path, rows):
    path = helpers.write_csv_file(
        tmp_path / "in.csv",
        ["any", "names", "at", "all", "bind", "by", "position", "only"],
        [
            [10, 1, "Current", "£5", "05/01/2020", "", "Y", "No"],
            ["x", "y", "Saver", '""', "", "", "", "Yes"],
        ],
    )
    df = sources.read_accounts(spark, path)
    assert df.schema == schemas.as_struct(schemas.ACCOUNTS_RAW)
    assert rows(df.select("Account_ID", "Customer_ID", "Account_Type", "Last_Activity_Date")) == [
        (10, 1, "Current", None),
        (None, None, "Saver", None),
    ]


def test_csv_scan_struct(spark, tmp_path):
    lines = [list(helpers.CUSTOMER.values()), [*list(helpers.CUSTOMER.values())[:-1], "much"]]
    path = helpers.write_csv_file(tmp_path / "c.csv", list(helpers.CUSTOMER), lines)
    df = sources.read_customers(spark, path)
    assert df.schema == schemas.CUSTOMERS
    assert sorted(helpers.column(df, "Estimated_Salary"), key=repr) == [20000.0, None]


def test_csv_scan_of_several_paths(spark, tmp_path):
    paths = [
        helpers.write_csv_file(tmp_path / name, ["Account_ID"], [[1], [2]]) for name in ("a", "b")
    ]
    assert sorted(helpers.column(sources.read_deletes(spark, paths), "Account_ID")) == [1, 1, 2, 2]


def test_csv_scan_prunes_columns(spark, tmp_path):
    path = helpers.write_csv_file(tmp_path / "in.csv", ACCOUNT_HEADER, [[1] * 8])
    plan = sources.read_accounts(spark, path).select("Churn")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<Churn:string>" in plan


def test_schema_contract(spark):
    df = helpers.customers(spark, {})
    assert schemas.require_schema(df, schemas.CUSTOMERS) is df
    renamed = df.toDF(*[c.lower() for c in df.columns])
    assert schemas.require_schema(renamed, schemas.CUSTOMERS) is renamed
    with pytest.raises(schemas.SchemaMismatch):
        schemas.require_schema(df.drop("Name"), schemas.CUSTOMERS)
    with pytest.raises(schemas.SchemaMismatch):
        schemas.require_schema(df.withColumn("Age", df.Age.cast("long")), schemas.CUSTOMERS)


def test_schemas(spark):
    assert [f.dataType.simpleString() for f in schemas.as_struct(schemas.ACCOUNTS)] == [
        "bigint", "int", "string", "float", "date", "date", "string", "string"
    ]
    assert [f.dataType.simpleString() for f in schemas.as_struct(schemas.TRANSACTIONS)] == [
        "bigint", "bigint", "string", "float", "date"
    ]
    assert len(schemas.CUSTOMERS) == 14


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
@pytest.mark.parametrize("name", roles.TABLES)
def test_declared_columns_are_those_of_the_files(spark, name, sf):
    found = spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
    declared = schemas.as_struct(roles.TABLES[name])
    schemas.require_schema(found.select(*declared.fieldNames()), declared)


class Calls:
    """Stands in for a reader, a writer and their owners, and notes what they are told.

    No database is started in the tests, so what reaches the JDBC source is checked instead.
    """

    def __init__(self, result=None):
        self.told, self.result = {}, result
        self.read = self.write = self

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told["options"] = options
        return self

    def jdbc(self, url, table, predicates, properties):
        self.told.update(url=url, table=table, predicates=predicates, properties=properties)
        return self.result

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def load(self):
        return self.result

    def save(self):
        self.told["saved"] = True


LINK = {"url": "jdbc:x", "driver": "d", "user": "u"}


def test_jdbc_scan(spark):
    df = helpers.customers(spark, {})
    calls = Calls(df)
    assert jdbc.read_table(calls, LINK, "t") is df
    assert calls.told == {"format": "jdbc", "options": {**LINK, "dbtable": "t"}}


def test_jdbc_scan_in_parts_with_contract(spark):
    df = helpers.customers(spark, {})
    calls = Calls(df)
    split = jdbc.Split("Customer_ID", 0, 1000, 16)
    assert jdbc.read_table(calls, LINK, "t", split, schemas.CUSTOMERS) is df
    assert calls.told["options"] == {
        **LINK, "dbtable": "t", "partitionColumn": "Customer_ID",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }
    with pytest.raises(schemas.SchemaMismatch):
        jdbc.read_table(calls, LINK, "t", split, schemas.ACCOUNTS)


def sizes(df, predicates):
    """Rows that meet each predicate; every row must meet exactly one."""
    met = df.selectExpr(*(f"CAST(coalesce({p}, false) AS INT) AS p{i}" for i, p in enumerate(predicates)))
    total = "+".join(met.columns)
    assert met.filter(f"{total} <> 1").count() == 0, predicates
    return list(met.groupBy().sum().first())


def test_even_predicates_on_skewed_keys(spark):
    """A quadratic key, a third of the rows with one key, and NULLs."""
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 500 WHEN id % 97 = 0 THEN NULL "
        "ELSE CAST(id * id / 30000 AS INT) END AS k", "id AS t")
    assert max(sizes(df, jdbc.even_predicates(df, "k", 12))) > 9000  # one key cannot be divided
    even = sizes(df, jdbc.even_predicates(df, "k", 12, "t"))
    assert max(even) < 1.5 * 30_000 / 12 and len(even) < 18
    # A sample that lacks rows still gives a whole division.
    few = df.filter("t % 50 = 1 AND k < 20000")
    assert sum(sizes(df, jdbc.even_predicates(few, "k", 5, "t"))) == 30_000


@pytest.mark.parametrize("kind", [
    "date_add(DATE'2020-01-01', CAST(id AS INT) % 50)",
    "CAST(id / 7 AS DECIMAL(9, 2))", "timestamp_seconds(id DIV 3)",
])
def test_even_predicates_of_other_types(spark, kind):
    df = spark.range(3000).selectExpr(f"{kind} AS k")
    found = sizes(df, jdbc.even_predicates(df, "k", 6))
    assert max(found) < 900 and sum(found) == 3000


def test_even_predicates_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(None,), (1,), (1,)], "k int")
    assert sizes(df.filter("k IS NULL"), jdbc.even_predicates(df.limit(0), "k", 4)) == [1]
    assert jdbc.even_predicates(df, "k", 1) == ["1 = 1"]
    assert sum(sizes(df, jdbc.even_predicates(df, "k", 4))) == 3


def test_jdbc_scan_by_predicates(spark):
    df = helpers.customers(spark, {})
    calls = Calls(df)
    assert jdbc.read_table(calls, LINK, "t", schema=schemas.CUSTOMERS, predicates=["a", "b"]) is df
    assert calls.told == {"url": "jdbc:x", "table": "t", "predicates": ["a", "b"],
                          "properties": {"driver": "d", "user": "u"}}
    with pytest.raises(ValueError):
        jdbc.read_table(calls, LINK, "t", jdbc.Split("k", 0, 1, 2), predicates=["a"])


@pytest.mark.parametrize("mode", ["errorifexists", "overwrite", "append"])
def test_jdbc_write(mode):
    calls = Calls()
    jdbc_sink.write_table(calls, LINK, "t", mode, connections=8)
    assert calls.told == {
        "format": "jdbc", "options": {**LINK, "dbtable": "t", "numPartitions": "8"},
        "mode": mode, "saved": True,
    }


def test_jdbc_write_refuses_existing_tables_by_default():
    calls = Calls()
    jdbc_sink.write_table(calls, LINK, "t")
    assert calls.told["mode"] == "errorifexists"
    assert calls.told["options"] == {**LINK, "dbtable": "t"}
