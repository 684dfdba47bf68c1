import helpers
from tellerflow import schemas, sources
from tellerflow.operators import clean
from tellerflow.streaming import follow_accounts, follow_transactions


def test_each_file_is_added_once(spark, tmp_path, rows):
    inbox = tmp_path / "in"
    where = str(inbox), str(tmp_path / "table"), str(tmp_path / "checkpoint")
    lines = [[i, 10, "Cash - In", "£1.50", "07/01/2020"] for i in range(3)]

    def run():
        follow_transactions(spark, *where).awaitTermination()
        return rows(spark.read.schema(schemas.TRANSACTIONS).parquet(where[1]))

    helpers.write_csv_file(inbox / "a.csv", list(helpers.TRANSACTION), lines)
    first = run()
    assert first == rows(clean.clean_transactions(sources.read_transactions(spark, str(inbox))))
    assert run() == first
    helpers.write_csv_file(inbox / "b.csv", list(helpers.TRANSACTION), lines[:1])
    assert len(run()) == 4


def test_accounts(spark, tmp_path, rows):
    inbox = str(tmp_path / "in")
    helpers.write_csv_file(
        tmp_path / "in" / "a.csv", list(helpers.ACCOUNT), [list(helpers.ACCOUNT.values())]
    )
    follow_accounts(spark, inbox, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(schemas.ACCOUNTS).parquet(str(tmp_path / "t"))
    assert rows(got) == rows(clean.clean_accounts(sources.read_accounts(spark, inbox)))
