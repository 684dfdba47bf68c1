"""The store queries where no folder for intermediate results is set."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path
from types import SimpleNamespace

import pytest

from tellerchecks import registry
from tellerflow.sources import roles

#: A store query and the query that rewrites the whole table.
TWINS = {
    "store_delete_accounts": "delete_accounts",
    "store_delete_customers": "delete_customers",
    "store_delete_transactions": "delete_transactions",
    "store_incremental_transactions": "incremental_transactions",
    "store_phone_update": "phone_update",
}

OUTSIDE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from tellerchecks.registry import queries
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2"}).getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
for name in sys.argv[3:]:
    queries()[name](spark, sys.argv[2]).write.parquet(f"{sys.argv[2]}/{name}")
"""

ROWS = {
    "nation": ("range(3)", "CAST(id AS INT), concat('N', id)"),
    "customer": ("range(1, 130)", "id, 'n', CAST(id % 3 AS INT), 10D * id"),
    "orders": (
        "range(1, 300)",
        "id, id % 130, 'F', IF(id % 40 = 0, 490000D, 9D), TIMESTAMP_NTZ'2001-02-03', '1-URGENT'",
    ),
    "lineitem": (
        "range(1, 500)",
        "id % 300, CAST(id AS INT), 5D, 0.1D, 'A', "
        "IF(id % 3 = 0, TIMESTAMP_NTZ'2001-05-06', TIMESTAMP_NTZ'1999-05-06')",
    ),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables, and beside them the results of a session that names no folder."""
    folder = tmp_path_factory.mktemp("unset")
    for table, (source, columns) in ROWS.items():
        rows = spark.sql(f"SELECT {columns} FROM {source}")
        names = [c.split()[0] for c in roles.TABLES[table].split(", ")]
        rows.toDF(*names).write.parquet(f"{folder}/{table}.parquet")
    (folder / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK")}
    repo = str(Path(registry.__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", OUTSIDE, repo, str(folder), *TWINS], cwd=folder,
                          env=env | {"SPARK_CONF_DIR": str(folder / "conf"), "TMPDIR": str(folder)},
                          capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    return str(folder)


@pytest.mark.parametrize("name", TWINS)
def test_store_query_without_a_shared_folder(spark, rows, folder, name):
    want = rows(registry.queries()[TWINS[name]](spark, folder))
    assert want and rows(spark.read.parquet(f"{folder}/{name}")) == want


@pytest.mark.parametrize(
    ("master", "warehouse", "there"),
    [
        ("local[4]", "file:/wh", False),
        ("local", "file:/wh", False),
        ("local-cluster[2,1,1024]", "file:/wh", True),
        ("yarn", "hdfs://host/wh", True),
    ],
)
def test_folder_that_serves_where_none_is_set(
    spark, monkeypatch, tmp_path, master, warehouse, there
):
    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    chosen = []
    context = SimpleNamespace(
        master=master,
        _jsc=spark.sparkContext._jsc,
        getCheckpointDir=lambda: f"{chosen[-1]}/id" if chosen else None,
        setCheckpointDir=chosen.append,
    )
    conf = {"spark.sql.warehouse.dir": warehouse}
    session = SimpleNamespace(sparkContext=context, conf=conf)
    folder = registry._folder(session)
    assert registry._folder(session) == folder == f"{chosen[0]}/id" and len(chosen) == 1
    assert (chosen[0] == warehouse) == there
    assert there or os.path.isdir(chosen[0])


def test_a_folder_that_is_set_is_used(spark):
    assert registry._folder(spark) == spark.conf.get("spark.checkpoint.dir")
