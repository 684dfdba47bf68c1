import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tellerflow import sinks
from tellerflow.sinks import catalog, shared


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"n{v}") for v in values], "k int, v string")


@pytest.fixture
def table(spark, request):
    name = f"t_{request.node.name.split('[')[0]}"
    yield name
    for suffix in ("", "__staged", "__former"):
        spark.sql(f"DROP TABLE IF EXISTS {name}{suffix}")


def parts(path):
    return sorted(Path(path).glob("part-*.csv"))


def test_csv_sink_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "k int, v string")
    sinks.write_csv(df.repartition(3), path)
    assert len(parts(path)) > 1
    sinks.write_csv(df.coalesce(1).sortWithinPartitions("k"), path)
    assert [p.read_text() for p in parts(path)] == ['k,v\n1,\n2,""\n3,x\n']


def test_csv_sink_append(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    for batch in ((1, 2), (2, 3)):
        sinks.write_csv(numbers(spark, *batch).repartition(2), path, "append")
    assert len(parts(path)) == 4
    back = spark.read.option("header", "true").schema("k int, v string").csv(path)
    assert rows(back) == [(1, "n1"), (2, "n2"), (2, "n2"), (3, "n3")]


@pytest.mark.parametrize(
    "given", [{}, {"connection": {"url": "u"}}, {"jdbc_table": "j"}, {"csv": "c", "jdbc_table": "j"}]
)
def test_incomplete_target(given):
    with pytest.raises(ValueError):
        sinks.Target(**given)


def test_shared_folder_of_one_machine_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match="do not share"):
        shared.shared_folder(spark)


def test_scratch_tables_go_with_the_job(spark, rows):
    with sinks.scratch(spark) as keep:
        df = keep(numbers(spark, 1, 2), "x")
        assert rows(df) == [(1, "n1"), (2, "n2")]
        path = df.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_table_overwrite(spark, table, rows):
    sinks.save_table(numbers(spark, 1), table)
    sinks.save_table(numbers(spark, 2, 3), table)
    assert rows(spark.table(table)) == [(2, "n2"), (3, "n3")]


def test_table_append(spark, table, rows):
    sinks.save_table(numbers(spark, 1), table)
    sinks.save_table(numbers(spark, 2).select("v", "k"), table, "append")
    assert rows(spark.table(table)) == [(1, "n1"), (2, "n2")]
    renamed = numbers(spark, 3).toDF("k", "w")
    retyped = numbers(spark, 3).select("v", F.lit("x").alias("k"))
    for wrong in (renamed, retyped):
        with pytest.raises(AnalysisException):
            sinks.save_table(wrong, table, "append")
    assert spark.table(table).count() == 2


def test_overwriting_what_is_read_needs_staging(spark, table, rows):
    sinks.save_table(numbers(spark, 1, 2, 3), table)
    with pytest.raises(AnalysisException):
        sinks.save_table(spark.table(table).filter("k > 1"), table)
    sinks.publish_staged(spark, {table: spark.table(table).filter("k > 1")})
    assert rows(spark.table(table)) == [(2, "n2"), (3, "n3")]
    assert not spark.catalog.tableExists(f"{table}__staged")
    assert not spark.catalog.tableExists(f"{table}__former")


def test_staged_publish_of_a_new_and_of_an_empty_table(spark, table):
    sinks.publish_staged(spark, {table: numbers(spark, 1)})
    sinks.publish_staged(spark, {table: spark.table(table).filter("k > 5")})
    assert spark.table(table).count() == 0 and spark.table(table).columns == ["k", "v"]


def test_staged_publish_sees_old_contents_of_all_tables(spark, table, rows):
    other = f"{table}_b"
    sinks.save_table(numbers(spark, 1, 2), table)
    sinks.save_table(numbers(spark, 3, 4), other)
    sinks.publish_staged(spark, {table: spark.table(other), other: spark.table(table)})
    assert rows(spark.table(table)) == [(3, "n3"), (4, "n4")]
    assert rows(spark.table(other)) == [(1, "n1"), (2, "n2")]
    spark.sql(f"DROP TABLE {other}")


def test_staged_publish_in_a_database(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS bank")
    for values in ((1,), (2, 3)):
        sinks.publish_staged(spark, {"bank.numbers": numbers(spark, *values)})
    assert rows(spark.table("bank.numbers")) == [(2, "n2"), (3, "n3")]
    assert [t.name for t in spark.catalog.listTables("bank") if not t.isTemporary] == ["numbers"]
    spark.sql("DROP DATABASE bank CASCADE")


def test_failing_frame_leaves_every_table(spark, table, rows):
    sinks.save_table(numbers(spark, 1), table)
    broken = spark.table(table).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.publish_staged(spark, {table: numbers(spark, 9), f"{table}_b": broken})
    assert rows(spark.table(table)) == [(1, "n1")]


def test_failing_rename_puts_the_table_back(spark, table, rows, monkeypatch):
    sinks.save_table(numbers(spark, 1), table)
    rename = catalog._rename

    def refuse(spark, old, new):
        if old.endswith("__staged"):
            raise RuntimeError("no")
        rename(spark, old, new)

    monkeypatch.setattr(catalog, "_rename", refuse)
    with pytest.raises(sinks.PublishError, match="could not replace .*published: \\[\\], not"):
        sinks.publish_staged(spark, {table: numbers(spark, 2)})
    assert rows(spark.table(table)) == [(1, "n1")]


def test_short_staging_table_is_not_published(spark, table, rows, monkeypatch):
    sinks.save_table(numbers(spark, 1), table)
    monkeypatch.setattr(
        catalog.Observation, "get", property(lambda self: {"rows": 3}), raising=False
    )
    with pytest.raises(sinks.PublishError, match="holds 1 rows, 3 were written"):
        sinks.publish_staged(spark, {table: numbers(spark, 2)})
    assert rows(spark.table(table)) == [(1, "n1")]


def test_stopped_swap_is_repaired(spark, table, rows):
    """The former table exists, the live one does not: what a stop between two renames leaves."""
    sinks.save_table(numbers(spark, 1, 2), f"{table}__former")
    with pytest.raises(Exception):
        broken = numbers(spark, 1).withColumn("v", F.raise_error(F.lit("x")).cast("string"))
        sinks.publish_staged(spark, {table: broken})
    assert rows(spark.table(table)) == [(1, "n1"), (2, "n2")]


def test_materialize_uses_the_shared_folder(spark, rows):
    df = sinks.materialize(numbers(spark, 1, 2), "x")
    assert rows(df) == [(1, "n1"), (2, "n2")]
    assert all(shared.shared_folder(spark) in f for f in df.inputFiles())
    assert sinks.materialize(numbers(spark, 1).filter("k > 1"), "x").columns == ["k", "v"]


def test_shared_folder_must_be_known(spark, conf):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_folder(spark) == folder


def test_multi_sink(spark, table, tmp_path, rows, monkeypatch):
    """Overwrite, then append: all sinks hold the same rows; JDBC calls are noted, not made."""
    calls = []
    monkeypatch.setattr(
        "tellerflow.sinks.targets.write_table",
        lambda df, link, name, mode, connections: calls.append((rows(df), name, mode)),
    )
    target = sinks.Target(
        table=table, csv=str(tmp_path / "csv"), connection={"url": "jdbc:x"}, jdbc_table="j"
    )
    assert rows(sinks.replace([(numbers(spark, 1), target)])[0]) == [(1, "n1")]
    assert rows(sinks.add(numbers(spark, 2), target)) == [(2, "n2")]
    assert calls == [([(1, "n1")], "j", "overwrite"), ([(2, "n2")], "j", "append")]
    both = [(1, "n1"), (2, "n2")]
    assert rows(spark.table(table)) == both
    files = spark.read.option("header", "true").schema("k int, v string").csv(target.csv)
    assert rows(files) == both


def test_frame_is_computed_once_for_all_sinks(spark, table, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = numbers(spark, 1, 2, 3).mapInPandas(note, "k int, v string")
    target = sinks.Target(table=table, csv=str(tmp_path / "csv"))
    sinks.replace([(df, target)])
    assert seen.value == 3
    sinks.add(df, target)
    assert seen.value == 6


def test_sinks_without_a_table(spark, tmp_path, rows, monkeypatch):
    calls = []
    monkeypatch.setattr(
        "tellerflow.sinks.targets.write_table", lambda df, *rest: calls.append((rows(df), *rest))
    )
    target = sinks.Target(csv=str(tmp_path / "csv"), connection={"url": "u"}, jdbc_table="j")
    sinks.replace([(numbers(spark, 1), target)])
    sinks.replace([(numbers(spark, 2), target)])
    sinks.add(numbers(spark, 3), target)
    assert [c[0] for c in calls] == [[(1, "n1")], [(2, "n2")], [(3, "n3")]]
    files = spark.read.option("header", "true").schema("k int, v string").csv(target.csv)
    assert rows(files) == [(2, "n2"), (3, "n3")]
