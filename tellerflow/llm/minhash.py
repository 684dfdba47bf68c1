"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.common import (
    components,
    mix,
    ngram_hashes,
    sliced,
    stored,
    word_hashes,
    words_of,
)

SHINGLE_WORDS = 5
_LEVEL_BITS = np.uint64(56)
_EMPTY = np.uint64(2**64 - 1)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of ``size``-word shingles; of the whole text if it is shorter."""
    hashes = word_hashes(words_of(text, fold=True))
    return np.unique(ngram_hashes(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """A signature per set: for each slot the least of level + fraction over all its elements.

    Each element walks its own random permutation of the slots; at step j it offers j plus a
    fresh fraction to the slot it reaches. Once every slot of a set holds a value below j + 1, no
    later step can lower any, and its walk stops. Level and fraction are packed into one integer.
    An empty set leaves its slots at the largest value.
    """
    best = np.full((len(sets), slots), _EMPTY)
    if not len(sets):
        return best
    flat = best.reshape(-1)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    walk = None
    for level in range(slots):
        draw = mix(elements + np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64))
        step = (mix(draw ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) * np.uint64(
            slots - level
        )
        slot = level + (step >> np.uint64(32)).astype(np.int64)
        if walk is None:
            first = slot
        else:
            rows, reached = np.arange(len(elements)), slot
            slot = walk[rows, reached]
            walk[rows, reached] = walk[:, level]
        np.minimum.at(
            flat, owner * slots + slot, (np.uint64(level) << _LEVEL_BITS) | (draw >> np.uint64(8))
        )
        open_sets = best.max(axis=1) >> _LEVEL_BITS > np.uint64(level)
        going = open_sets[owner]
        left = np.count_nonzero(going)
        if not left:
            break
        if left < 0.7 * len(going):  # a set that is done may go on: nothing lowers its slots
            elements, owner = elements[going], owner[going]
            first, walk = first[going], None if walk is None else walk[going]
        if walk is None:
            walk = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
            walk[np.arange(len(elements)), first] = 0
            first = np.empty(len(elements), np.int64)
    return best


def _in_chunks(sets: list[np.ndarray], elements: int = 100_000) -> Iterator[list[np.ndarray]]:
    """The sets in order, in lists of about so many elements; a larger set is alone."""
    now, size = [], 0
    for found in sets:
        if now and size + len(found) > elements:
            yield now
            now, size = [], 0
        now.append(found)
        size += len(found)
    if now:
        yield now


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures[:, : bands * rows].reshape(-1, bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(parts), 1))
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def _signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
            first = [s.sum(dtype=np.uint64).view(np.int64) for s in sets]
            second = [mix(s ^ _EMPTY).sum(dtype=np.uint64).view(np.int64) for s in sets]
            keys = []
            for some in _in_chunks(sets):
                found = _bands(superminhash(some, bands * rows), bands, rows).view(np.int64)
                keys += [k if len(s) else k[:0] for k, s in zip(found, some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "k1", "k2", "bands"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        sign, "doc_id long, n long, k1 long, k2 long, bands array<long>"
    )


def _sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame) -> DataFrame:
    """Full shingle sets of the documents in ``ids``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            found = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "shingles"]
            )

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return wanted.join(ids, "doc_id", "left_semi").mapInArrow(
        build, "doc_id long, shingles array<long>"
    )


def _alike(na, nb, inter, percent: int):
    return inter * 100 >= (na + nb - inter) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    inter = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(_alike(F.size("sa"), F.size("sb"), inter, percent))
        .select("a", "b")
    )


def _across(group: pa.Table, percent: int) -> pa.Table:
    """One link for every two components that two blocks of a bucket connect."""
    lists = group.column("shingles").combine_chunks()
    starts, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    component = group.column("component_id").to_numpy()
    names, found, rows, n = [], [], [], []
    for side in ("left", "right"):
        members = np.flatnonzero(group.column(side).to_numpy())
        sets = [values[starts[i] : starts[i + 1]] for i in members]
        names.append(component[members])
        n.append(np.array([len(s) for s in sets], np.int64))
        found.append(np.concatenate([*sets, np.empty(0, np.int64)]))
        rows.append(np.repeat(np.arange(len(sets)), n[-1]))
    shared = np.intersect1d(np.unique(found[0]), np.unique(found[1]), assume_unique=True)
    common = np.zeros((len(n[0]), len(n[1])), np.float32)
    for at in range(0, len(shared), 4096):
        part, marks = shared[at : at + 4096], []
        for values, row, size in zip(found, rows, n, strict=True):
            column = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[column] == values
            mark = np.zeros((len(size), len(part)), np.float32)
            mark[row[hit], column[hit]] = 1
            marks.append(mark)
        common += marks[0] @ marks[1].T
    alike = _alike(n[0][:, None], n[1][None, :], common.astype(np.int64), percent)
    a, b = np.nonzero(alike & (names[0][:, None] != names[1][None, :]))
    links = np.unique(np.stack([names[0][a], names[1][b]]), axis=1)
    return pa.table({"a": links[0], "b": links[1]})


def _other_links(rest: DataFrame, sets: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """Links between members of a bucket that are still in different components.

    A bucket is compared in pairs of blocks, a task each. A task reads the sets of two blocks and
    returns links between components only, so no pairs of documents are produced.
    """
    blocks = F.ceil(F.col("members") / block).cast("int")
    sizes = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    placed = (
        rest.join(sizes, "bucket")
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "bucket", "doc_id", "component_id",
            F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
            (F.col("mine") <= F.col("other")).alias("left"),
            (F.col("mine") >= F.col("other")).alias("right"),
        )
    )
    return (
        placed.join(sets, "doc_id")
        .groupBy("bucket", "low", "high")
        .applyInArrow(lambda group: _across(group, percent), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    bands: int = 25,
    rows: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of distinct
    five-word shingles (A-Z folded; a shorter text is one shingle). Candidates share a band of
    their SuperMinHash signatures; every link is confirmed on full sets. 25 bands of 5 miss a pair
    at 0.80 with probability 5e-5, 21 bands of 6 one at 0.85 with 5e-5.

    Equal sets are represented by their smallest id. In a bucket each member is compared with the
    smallest; only buckets whose members are then still in different components are compared
    block by block, so a group of copies costs its size, not its square, and no link is lost.

    Texts that are null, empty or blank have no shingles and link with nothing. Rows without an id
    link with nothing; their component is null and they are kept. Rows that repeat an id are one
    document that has the links of all of them. Other columns are ignored.
    """
    signs = stored(_signatures(docs, id_col, text_col, bands, rows), "signatures")
    able = signs.filter("n > 0 AND doc_id IS NOT NULL")
    same = able.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"))
    named = able.join(same, ["k1", "k2", "n"])
    copies = named.filter("doc_id > rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")
    )
    reps = named.filter("doc_id = rep").select("doc_id", "n", "bands")
    spread = reps.select("doc_id", "n", F.explode("bands").alias("bucket"))
    pivots = (
        spread.groupBy("bucket")
        .agg(F.min(F.struct("doc_id", "n")).alias("p"), F.max("doc_id").alias("last"))
        .filter("p.doc_id < last")
        .select("bucket", F.col("p.doc_id").alias("pivot"), F.col("p.n").alias("pivot_n"))
    )
    members = stored(spread.join(pivots, "bucket").distinct(), "members")
    able_size = F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent
    ids = members.filter("doc_id <> pivot").select("doc_id")
    ids = ids.union(members.select("pivot")).distinct()
    sets = stored(_sets(docs, id_col, text_col, ids), "sets")
    first = (
        members.filter(able_size & F.expr("doc_id <> pivot"))
        .select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"))
        .distinct()
    )
    links = stored(_verified(first, sets, percent).unionByName(copies), "links")
    groups = components(links)

    label = groups.withColumnRenamed("id", "doc_id")
    placed = members.join(label, "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )
    torn = (
        placed.groupBy("bucket")
        .agg(
            F.min("component_id").alias("low"), F.max("component_id").alias("high"),
            F.count(F.lit(1)).alias("members"),
            F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("k1"),
            F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("k2"),
        )
        .filter("low < high")
        .groupBy("members", "k1", "k2")  # buckets of the same members are compared once
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    rest = placed.join(torn, "bucket", "left_semi").filter("doc_id <> pivot").select(
        "bucket", "doc_id", "component_id"
    )
    more = stored(_other_links(rest, sets, percent), "links")
    if not more.isEmpty():
        groups = components(links.unionByName(more))
    groups = groups.withColumnRenamed("id", "doc_id")
    found = signs.select("doc_id", F.col("n").alias("n_shingles")).join(groups, "doc_id", "left")
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
