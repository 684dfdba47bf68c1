"""Helpers the operators share: scratch tables, words, hashes and connected components."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

_own_folder: dict[str, str] = {}
_sent_to: set[str] = set()


#: Arrow data Spark hands to a Python function at once, unless the session says otherwise.
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> None:
    """Bound the batches that Python functions get, and give the executors this package, once per
    application, by Spark's own file distribution; so the functions also run where the package is
    not on the workers' path."""
    if (key := "spark.sql.execution.arrow.maxBytesPerBatch") not in spark.conf.getAll:
        spark.conf.set(key, BATCH_BYTES)
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _sent_to or not package.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="code-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _sent_to.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one on local[n]."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folder:
        _own_folder[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _own_folder[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared folder and read back from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place 0, 1, 2, ... among all rows in ``name``.

    Rows are dealt out by ranges of ``order`` and sorted there; a stored table fixes their places.
    Only the row counts of the ranges, one row a partition, meet in one task.
    """
    at = F.monotonically_increasing_id()
    placed = stored(df.orderBy(*order).withColumn("__at", at), name)
    part = F.shiftrightunsigned("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__n").over(before), F.lit(0))
    place = F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__first")
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(sizes.select("__part", first.alias("__first"))), "__part")
        .withColumn(name, place)
        .select(*df.columns, name)
    )


def slices(batch: pa.RecordBatch, column: int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts whose texts take about ``size`` bytes together, or
    one longer text. What a task holds beside the batch then follows the part."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def sliced(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, column)


#: Ids that are broadcast; each takes some 60 bytes there, so 120 MB at most.
BROADCAST_IDS = 2_000_000


def rows_of(df: DataFrame, id_col: str, ids: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose id is (or is not) in ``ids``, one column of stored distinct ids.
    Few ids, by their count, are broadcast, and the rows stay where they are."""
    (name,) = free_names(df, "__of")
    ids = ids.toDF(name)
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return df.join(ids, F.col(id_col) == F.col(name), "left_semi" if inside else "left_anti")


# Words are maximal runs of anything but U+0020 and U+0009 to U+000D, which is how bytes.split()
# divides; bytes.lower() folds A-Z only.


def words_of(text: str | None, fold: bool = False) -> list[bytes]:
    if not text:
        return []
    raw = text.encode()
    return (raw.lower() if fold else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), np.uint64)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` consecutive words; empty when there are fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for i in range(1, n):
        total *= MULTIPLIER
        total += hashes[i : i + count]
    return mix(total + np.uint64(n))


def _settled(df: DataFrame) -> tuple[DataFrame, tuple]:
    """Store a table of edges and return it with a fingerprint of its rows."""
    seen = Observation()
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark"))
    table = stored(df, "edges")
    return table, (seen.get["n"], seen.get["mark"])


def _stars(lower: DataFrame) -> DataFrame:
    """Large star, then small star, on edges (u, v) with u > v."""
    both = lower.unionByName(lower.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = (
        lower.select(F.col("v").alias("u"), F.col("u").alias("w"))
        .join(least, "u")
        .select(F.col("w").alias("u"), F.col("m").alias("v"))
        .filter("u > v")
        .distinct()
    )
    low = hung.groupBy("u").agg(F.min("v").alias("m"))
    return (
        hung.join(low, "u")
        .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .filter("u > v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component_id), the smallest id reachable.

    Alternating large and small stars; every round is a table in the shared folder, so a lost
    executor costs one round at most. A node of any degree only ever meets its own minimum, which
    is aggregated before the shuffle. Ids without an edge to another id are not returned.
    """
    table, mark = _settled(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v")
        .distinct()
    )
    while mark[0]:
        table, now = _settled(_stars(table))
        if now == mark:
            break
        mark = now
    return table.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        table.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
