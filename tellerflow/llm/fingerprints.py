"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerflow.llm.common import mix, ngram_hashes, slices, stored, word_hashes, words_of

#: A fingerprint has 256 bits, four 64-bit words.
_LANES = np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
BITS = 64 * len(_LANES)
_TERMS_AT_ONCE = 4096


def simhash(text: str | None, sizes: tuple[int, ...] = (1, 5)) -> bytes:
    """The fingerprint of a text, 32 bytes.

    Terms are the distinct runs of each size of words, A-Z lower-cased; of a text with fewer words
    the whole run. A term weighs 1 + ln(occurrences), in sixteenths, and votes for or against each
    bit as its hash has it. Votes are whole numbers, so that equal texts have equal fingerprints
    on any machine. Without words all bits are 0.
    """
    hashes = word_hashes(words_of(text, fold=True))
    votes = np.zeros(BITS)
    for size in dict.fromkeys(min(n, len(hashes)) for n in sizes):
        if not size:
            continue
        terms, counts = np.unique(ngram_hashes(hashes, size), return_counts=True)
        weights = np.rint(16 * (1 + np.log(counts))).astype(np.float32)
        for first in range(0, len(terms), _TERMS_AT_ONCE):
            part = slice(first, first + _TERMS_AT_ONCE)
            lanes = mix(terms[part, None] + _LANES).astype("<u8")
            bits = np.unpackbits(lanes.view(np.uint8), axis=1).astype(np.float32)
            votes += weights[part] @ (bits * 2 - 1)
    return np.packbits(votes > 0).tobytes()


def distance(a: bytes, b: bytes) -> int:
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine that the fingerprints' distance estimates, 0 for unrelated texts and below."""
    return max(0.0, float(np.cos(np.pi * distance(a, b) / BITS)))


_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_NAMES = [field.split()[0] for field in _ROW.split(", ")]
_EDGE = "part int, head boolean, edge string"


def _compared(number: int | None, text: str, mark: bytes, following: str, mark2: bytes) -> tuple:
    """One row: a text, and the same with its second half replaced by the next one's beginning."""
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    mark3 = simhash(edited)
    return (number, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, mark3,
            likeness(mark, mark3), likeness(mark, mark2))


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition, each compared with the one behind it. The first text, and the
    last one with its id, are handed out beside, for the partitions next to this."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("part", pa.int32()), ("head", pa.bool_()), ("edge", pa.string()),
    ])
    blank = (None,) * (len(_NAMES) - 1)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(zip(*rows), schema.types)],
            schema=schema,
        )

    held, place = None, None
    for batch in batches:
        for part in slices(batch, 2):
            rows = []
            for place, number, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                text = text or ""
                now = (number, text, simhash(text))
                if held is None:
                    rows.append((None, *blank, place, True, text))
                else:
                    rows.append((*_compared(*held, *now[1:]), place, None, None))
                held = now
            if rows:
                yield batch_of(rows)
    if held is not None:
        yield batch_of([(held[0], *blank, place, False, held[1])])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comparisons over (doc_id, text, next text), for the ends of partitions."""
    for batch in batches:
        for number, text, following in zip(*(c.to_pylist() for c in batch.columns)):
            row = _compared(number, text, simhash(text), following, simhash(following))
            yield pa.RecordBatch.from_arrays([pa.array([v]) if v is not None else
                                              pa.nulls(1, pa.int64()) for v in row], _NAMES)


def half_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How fingerprints follow an edit, for every document: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint (32 bytes each), near_edited, near_next.

    The edited text has the last half of the code points, rounded down, replaced by the first as
    many of the next document in descending order of ids (all, if it has fewer); after the last
    comes the first. Texts are dealt out once, by ranges of ids; only the two texts at the ends
    of each range meet those of other ranges, in a join.

    A null text is an empty one. Null ids come after all others; rows with one id are ordered by a
    hash of their text. A single row is its own next. Other columns are ignored, an empty table
    gives an empty one.
    """
    text = F.col(text_col).cast("string")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .orderBy(F.desc_nulls_last("doc_id"), "tie", "row")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    found = stored(ordered.mapInArrow(_along, f"{_ROW}, {_EDGE}"), "half_edits")
    heads = found.filter("head").select(F.col("part").alias("next_part"), F.col("edge").alias("following"))
    tails = found.filter("NOT head")
    everywhere = Window.orderBy("part")  # one row a partition
    after = F.coalesce(F.lead("part").over(everywhere), F.first("part").over(everywhere))
    tails = tails.join(tails.select("part", after.alias("next_part")), "part").join(heads, "next_part")
    ends = tails.select("doc_id", F.col("edge").alias("text"), "following").mapInArrow(_across, _ROW)
    return found.filter("head IS NULL").select(*_NAMES).unionByName(ends)


def _cell_pairs(rows: tuple[np.ndarray, ...], table: int, cell: tuple[int, int], radius: int):
    """Of one bucket or one pair of its parts: per row the documents near it and their least id.

    A pair that agrees in several blocks is counted in the first of them only.
    """
    marks, salts, n, least = rows
    blocks = marks.view(np.uint32).reshape(len(marks), -1)
    words = marks.reshape(len(marks), -1)
    total, lowest = np.zeros(len(n), np.int64), np.full(len(n), np.iinfo(np.int64).max)
    for first in range(0, len(n), 256):
        part = slice(first, first + 256)
        near = np.bitwise_count(words[part, None] ^ words).sum(axis=2) <= radius
        near[np.arange(len(n[part])), np.arange(first, first + len(n[part]))] = False
        if cell[0] != cell[1]:
            near &= salts[part, None] != salts
        left, right = np.nonzero(near)
        new = (blocks[left + first, :table] != blocks[right, :table]).all(axis=1)
        left, right = left[new] + first, right[new]
        np.add.at(total, left, n[right])
        np.minimum.at(lowest, left, least[right])
    return total, lowest


def _near_in_cells(radius: int):
    """A function over rows sorted by cell: table, cell key, salt pair, mark, salt, n, least."""

    def closed(rows: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        marks = np.frombuffer(b"".join(rows["mark"].tolist()), np.uint64)
        out = _cell_pairs(
            (marks.reshape(len(rows["n"]), -1), rows["salt"], rows["n"], rows["least"]),
            int(rows["block"][0]), (rows["low"][0], rows["high"][0]), radius,
        )
        some = np.flatnonzero(out[0])
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["mark"][some].tolist(), pa.binary()), pa.array(out[0][some]), pa.array(out[1][some])],
            ["fingerprint", "n_near", "near_least"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            if held is not None:
                rows = {name: np.concatenate([held[name], rows[name]]) for name in rows}
            key = np.stack([rows[c].astype(np.int64) for c in ("block", "value", "low", "high")])
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0).any(axis=0)) + 1)]
            for first, last in zip(cuts, cuts[1:]):
                if last - first > 1:
                    found = closed({name: v[first:last] for name, v in rows.items()})
                    if found is not None:
                        yield found
            held = {name: v[cuts[-1] :] for name, v in rows.items()}
        if held is not None and len(held["n"]) > 1:
            found = closed(held)
            if found is not None:
                yield found

    return run


def near_fingerprints(marks: DataFrame, radius: int = 7, cell: int = 2048) -> DataFrame:
    """All fingerprints within ``radius`` bits: fingerprint, n_near, near_least.

    ``marks``: (doc_id, fingerprint) rows, fingerprints of 32 bytes. Two fingerprints that differ in
    at most seven bits agree in one of eight 32-bit blocks; so each distinct fingerprint stands
    in eight tables, each led by another block, and is compared with those alike in it. Blocks
    that occur once are left out before fingerprints are shuffled. A block shared by more than
    ``cell`` fingerprints is divided into parts whose pairs are compared in tasks of their own;
    results are counts, never pairs. n_near counts the documents of other fingerprints, near_least
    is the smallest of their ids. Fingerprints near no other are not returned; null ones neither.
    """
    if not 0 <= radius < BITS // 32:
        raise ValueError(f"eight blocks find up to {BITS // 32 - 1} bits")
    distinct = stored(
        marks.filter("fingerprint IS NOT NULL")
        .groupBy(F.col("fingerprint").alias("mark"))
        .agg(F.count("*").alias("n"), F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("least")),
        "fingerprints",
    )
    value = F.conv(F.hex(F.expr("substring(mark, block * 4 + 1, 4)")), 16, 10).cast("long")
    blocks = distinct.select("*", F.explode(F.sequence(F.lit(0), F.lit(BITS // 32 - 1))).alias("block"))
    blocks = blocks.withColumn("value", value)
    shared = blocks.groupBy("block", "value").agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / cell).cast("int")
    salted = blocks.join(shared, ["block", "value"]).withColumns(
        {"parts": parts, "salt": F.pmod(F.xxhash64("mark"), parts).cast("int")}
    )
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = salted.withColumn("other", other).select(
        F.col("block").cast("int").alias("block"), "value",
        F.least("salt", "other").alias("low"), F.greatest("salt", "other").alias("high"),
        "mark", "salt", "n", "least",
    )
    keys = ["block", "value", "low", "high"]
    near = cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _near_in_cells(radius), "fingerprint binary, n_near long, near_least long"
    )
    return near.groupBy("fingerprint").agg(
        F.sum("n_near").alias("n_near"), F.min("near_least").alias("near_least")
    )


def fingerprints(
    docs: DataFrame, sizes: tuple[int, ...] = (1, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and fingerprint (32 bytes) of every row; null and empty texts have all bits 0."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [simhash(t, sizes) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.binary())], ["doc_id", "fingerprint"]
                )

    given = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return given.mapInArrow(mark, "doc_id long, fingerprint binary")


def with_near(rows: DataFrame, radius: int = 7) -> DataFrame:
    """Rows of (doc_id, fingerprint, ...) with n_near, the other documents within the radius, and
    group_least, the smallest id among them and the documents with this very fingerprint."""
    own = rows.groupBy("fingerprint").agg(F.count("*").alias("__n"), F.min("doc_id").alias("__least"))
    near = near_fingerprints(rows.select("doc_id", "fingerprint"), radius)
    counts = own.join(near, "fingerprint", "left").select(
        "fingerprint",
        (F.col("__n") - 1 + F.coalesce("n_near", F.lit(0))).alias("n_near"),
        F.least("__least", F.nullif("near_least", F.lit(2**63 - 1))).alias("group_least"),
    )
    return rows.join(counts, "fingerprint", "left").select(*rows.columns, "n_near", "group_least")
