"""Batches that come in once, in every sink, also by stream and after a stop."""

import pytest

import helpers
from tellerflow import schemas, sinks, sources
from tellerflow.operators import clean
from tellerflow.plans import jobs
from tellerflow.plans.jobs import Entities
from tellerflow.sinks import ledger as ledgers
from tellerflow.sinks.ledger import Ledger, LedgerError, add_once
from tellerflow.streaming import follow_customers
from test_jobs import write_batch


class Database:
    """A stand-in for a database: rows by table, and an append that may stop in the middle."""

    def __init__(self):
        self.tables, self.stop_after = {}, None

    def write(self, df, connection, table, mode, connections=None):
        found = [tuple(r) for r in df.collect()]
        self.names = df.columns
        if self.stop_after is not None:
            self.tables.setdefault(table, []).extend(sorted(found)[: self.stop_after])
            raise RuntimeError("connection lost")
        self.tables.setdefault(table, []).extend(found)

    def read(self, spark, connection, table):
        return spark.createDataFrame(self.tables[table], "k int, v string")


@pytest.fixture
def database(monkeypatch):
    base = Database()
    monkeypatch.setattr(ledgers, "write_table", base.write)
    monkeypatch.setattr(ledgers, "read_table", base.read)
    return base


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"))


@pytest.fixture
def target(spark, tmp_path):
    yield sinks.Target(table="once", csv=str(tmp_path / "csv"), connection={"url": "u"}, jdbc_table="j")
    spark.sql("DROP TABLE IF EXISTS once")


def numbers(spark, *keys):
    return spark.createDataFrame([(k, f"n{k}") for k in keys], "k int, v string")


def held(spark, target, database, rows):
    files = spark.read.option("header", "true").schema("k int, v string, batch string").csv(target.csv)
    return [rows(spark.table("once").select("k")), rows(files.select("k")),
            sorted((k,) for k, _ in database.tables["j"])]


def test_a_batch_is_added_once(spark, target, ledger, database, rows):
    assert add_once(numbers(spark, 1, 2), target, "b1", ledger)
    assert not add_once(numbers(spark, 1, 2), target, "b1", ledger)
    assert add_once(numbers(spark, 3), target, "b2", ledger)
    assert held(spark, target, database, rows) == [[(1,), (2,), (3,)]] * 3


@pytest.mark.parametrize("step", ["_add_to_table", "_add_to_csv", "_add_to_jdbc"])
@pytest.mark.parametrize("after", [False, True])
def test_stopped_before_or_after_any_sink(
    spark, target, ledger, database, rows, monkeypatch, step, after
):
    """After: the sink has its rows, but the ledger does not say so."""
    whole = getattr(ledgers, step)

    def stop(*args):
        if after:
            whole(*args)
        raise RuntimeError("stopped")

    add_once(numbers(spark, 9), target, "b0", ledger)
    with monkeypatch.context() as patched:
        patched.setattr(ledgers, step, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            add_once(numbers(spark, 1, 2), target, "b1", ledger, "k")
    assert add_once(numbers(spark, 1, 2), target, "b1", ledger, "k")
    assert held(spark, target, database, rows) == [[(1,), (2,), (9,)]] * 3


def test_stopped_within_a_database_append(spark, target, ledger, database, rows):
    database.stop_after = 2
    with pytest.raises(RuntimeError, match="lost"):
        add_once(numbers(spark, 1, 2, 3), target, "b1", ledger, "k")
    database.stop_after = None
    with pytest.raises(LedgerError, match="give its key"):
        add_once(numbers(spark, 1, 2, 3), target, "b1", ledger)
    add_once(numbers(spark, 1, 2, 3), target, "b1", ledger, "k")
    assert held(spark, target, database, rows) == [[(1,), (2,), (3,)]] * 3


def test_changed_and_renamed_batches_are_refused(spark, target, ledger, database, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(ledgers, "_add_to_csv", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            add_once(numbers(spark, 1), target, "b1", ledger)
    with pytest.raises(LedgerError, match="other rows"):
        add_once(numbers(spark, 1, 1), target, "b1", ledger)
    add_once(numbers(spark, 1), target, "b1", ledger)
    with pytest.raises(LedgerError, match="as b1"):
        add_once(numbers(spark, 1), target, "b2", ledger)
    with pytest.raises(ValueError, match="named by"):
        add_once(numbers(spark, 1), target, "b/2", ledger)


def test_empty_batches(spark, target, ledger, database):
    for batch in ("e1", "e2"):
        assert add_once(numbers(spark, 1).filter("k > 1"), target, batch, ledger)
    assert spark.table("once").count() == 0 and not database.tables["j"]


def test_incremental_load_once(spark, tmp_path, ledger, monkeypatch):
    paths = write_batch(tmp_path / "in", [{"Account_ID": 1}], [{}, {"Customer_ID": 2}], [{}, {}])
    targets = Entities(*(sinks.Target(csv=str(tmp_path / n)) for n in "act"))

    def counts():
        return [spark.read.option("header", "true").csv(t.csv).count() for t in targets]

    whole, calls = ledgers._add_to_csv, []

    def stop_third(df, path, batch):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("stopped")
        whole(df, path, batch)

    with monkeypatch.context() as patched:
        patched.setattr(ledgers, "_add_to_csv", stop_third)
        with pytest.raises(RuntimeError):
            jobs.incremental_load_once(spark, paths, targets, "monday", ledger)
    assert jobs.incremental_load_once(spark, paths, targets, "monday", ledger)
    assert not jobs.incremental_load_once(spark, paths, targets, "monday", ledger)
    assert counts() == [1, 2, 2]


def test_customers_by_stream(spark, tmp_path, ledger, rows, monkeypatch):
    """Each micro-batch equals the batch job on its files, also one stopped between two sinks."""
    target = sinks.Target(table="streamed", csv=str(tmp_path / "csv"))
    header = list(helpers.CUSTOMER)

    def put(name, *changes):
        lines = [list({**helpers.CUSTOMER, **c}.values()) for c in changes]
        return helpers.write_csv_file(tmp_path / "in" / name, header, lines)

    def run():
        query = follow_customers(spark, str(tmp_path / "in"), target, ledger, str(tmp_path / "cp"))
        query.awaitTermination()

    def alone(path):
        return clean.clean_customers(sources.read_customers(spark, path))

    try:
        want = alone(put("a.csv", {"Age": 20}, {"Age": 20}, {"Customer_ID": 2, "Age": ""}))
        run()
        second = alone(put("b.csv", {"Customer_ID": 3, "Age": 60}, {"Customer_ID": 4, "Age": ""}))
        with monkeypatch.context() as patched:
            patched.setattr(ledgers, "_add_to_csv", lambda *a: 1 / 0)
            with pytest.raises(Exception, match="ZeroDivisionError"):
                run()
        run()
        run()
        want = rows(want.unionByName(second))
        assert rows(spark.table("streamed").drop("batch")) == want
        schema = schemas.as_struct(schemas.CUSTOMERS)
        files = spark.read.option("header", "true").schema(schema).csv(f"{target.csv}/batch=*")
        assert rows(files) == want
        assert {r.Customer_ID: r.Age for r in spark.table("streamed").collect()} == {1: 20, 2: 20, 3: 60, 4: 60}
    finally:
        spark.sql("DROP TABLE IF EXISTS streamed")
