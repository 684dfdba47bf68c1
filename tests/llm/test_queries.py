"""The numbered queries: against SQL where there is some, and the pipeline stage by stage."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tellerchecks import compare
from tellerflow.llm import queries, sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sql.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert compare.difference(spark, SF_DIR, queries.queries()[name], sql.oracle_sql()[name]) == ""


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == ["pipeline", *(f"op{i}" for i in range(1, 14))]


def test_pipeline_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    rows, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        if name != "pack":
            assert docs.columns == columns, name
            docs = corpus_pipeline.stored(docs, name)
            assert 0 < docs.count() <= rows
            rows = docs.count()
    assert docs.select("doc_id").distinct().count() == rows


def test_pipeline_on_odd_rows(spark, docs):
    odd = docs((1, None), (2, ""), (None, "words without id"), (3, "12"), (3, "12")).selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "CAST(0 AS LONG) AS n_chars"
    )
    for frame in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF_DIR)
            assert out.count() >= 0


OUTSIDE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", __spark_entry__.queries()["op8_token_count"](spark, sys.argv[2]).count())
"""


def test_workers_need_no_path_to_the_repository(spark, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK")}
    repo = str(Path(corpus_pipeline.__file__).parent)
    done = subprocess.run([sys.executable, "-c", OUTSIDE, repo, SF_DIR], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=180, check=False)
    rows = queries.table(spark, SF_DIR, "documents").count()
    assert f"rows {rows}" in done.stdout, done.stderr[-2000:]
