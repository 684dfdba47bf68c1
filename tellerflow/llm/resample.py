"""Importance resampling towards a target distribution, on hashed n-grams from prefix CRCs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.common import free_names, numbered, slices, stored

# Letters and digits of ASCII and all bytes of other characters stay, A-Z lower-cased; what is
# left of ASCII divides words.
_NORMAL = bytes(
    b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower()
)
_POLYNOMIAL = 0xEDB88320


def _byte_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ (steps & np.uint32(1)) * np.uint32(_POLYNOMIAL)
    return steps


_STEP = _byte_steps()
#: _SHIFT[k][j][b]: byte j of a CRC, of value b, moved on by 2**k zero bytes; grows when needed.
_SHIFT: list[np.ndarray] = []


def _moved(crcs: np.ndarray, k: int) -> np.ndarray:
    tables = _SHIFT[k]
    out = tables[0][crcs & np.uint32(255)]
    for j in range(1, 4):
        out = out ^ tables[j][(crcs >> np.uint32(8 * j)) & np.uint32(255)]
    return out


def _grow(k: int) -> None:
    while len(_SHIFT) <= k:
        alone = [np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]
        if _SHIFT:
            now = [_moved(_moved(x, len(_SHIFT) - 1), len(_SHIFT) - 1) for x in alone]
        else:
            now = [_STEP[x & np.uint32(255)] ^ (x >> np.uint32(8)) for x in alone]
        _SHIFT.append(np.stack(now))


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC times x**(8 * length) over GF(2): what it adds to the CRC of a text that many
    bytes longer."""
    out = crcs.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        _grow(k)
        moved = np.flatnonzero(lengths >> k & 1)
        out[moved] = _moved(out[moved], k)
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words of the normalised text: lower-cased A-Z, digits and all characters beyond ASCII."""
    return text.encode().translate(_NORMAL).split() if text else []


class Prefixes:
    """One scan over words joined by single spaces; then the CRC-32 of any run of words."""

    def __init__(self, words: list[bytes]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths + 1)  # each word with the space before it
        self.starts = self.ends - lengths
        running = accumulate(words, lambda crc, w: crc32(b" " + w, crc), initial=0)
        running = np.fromiter(running, np.uint32, len(words) + 1)
        self.upto = running[1:]
        before = ~running[:-1]  # zlib gives the register inverted
        self.before = ~(_STEP[(before ^ np.uint32(32)) & np.uint32(255)] ^ (before >> np.uint32(8)))

    def crcs(self, size: int) -> np.ndarray:
        """CRC-32 of each run of ``size`` words: the prefix up to its end, less the prefix up to
        its start moved on by the bytes of the run."""
        count = max(0, len(self.ends) - size + 1)
        ends = self.ends[size - 1 :]
        return self.upto[size - 1 :] ^ shift(self.before[:count], ends - self.starts[:count])


def _buckets(texts: list[str | None], max_words: int, buckets: int) -> tuple[np.ndarray, ...]:
    """Of all texts, scanned as one: words per text, and text and bucket of each feature."""
    found = [words_of(t) for t in texts]
    n_words = np.fromiter(map(len, found), np.int64, len(found))
    owner = np.repeat(np.arange(len(found)), n_words)
    scan = Prefixes([w for words in found for w in words])
    owners, values = [], []
    for size in range(1, max_words + 1):
        whole = owner[: max(0, len(owner) - size + 1)] == owner[size - 1 :]
        owners.append(owner[size - 1 :][whole])
        values.append((scan.crcs(size)[whole] % np.uint32(buckets)).astype(np.int64))
    return n_words, np.concatenate(owners), np.concatenate(values)


_FEATURES = "n_words long, n_features long, buckets array<int>, counts array<int>"


def features(df: DataFrame, max_words: int, buckets: int) -> DataFrame:
    """Per row of (id, text): id, text_key, n_words, n_features and its buckets with counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                n_words, owner, bucket = _buckets(part.column(2).to_pylist(), max_words, buckets)
                keys, counts = np.unique(owner * buckets + bucket, return_counts=True)
                ends = np.searchsorted(keys, np.arange(len(n_words) + 1) * buckets)
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32)))
                         for v in (keys % buckets, counts)]
                n = np.bincount(owner, minlength=len(n_words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n_words), pa.array(n), *lists],
                    ["doc_id", "text_key", "n_words", "n_features", "buckets", "counts"],
                )

    return df.mapInArrow(scan, "doc_id long, text_key long, " + _FEATURES)


def _totals(found: DataFrame, name: str) -> DataFrame:
    """Features per bucket; counts are summed within tasks before they are shuffled."""
    each = found.select(F.inline(F.arrays_zip("buckets", "counts")))
    return each.groupBy(F.col("buckets").cast("long").alias("bucket")).agg(
        F.sum(F.col("counts").cast("long")).alias(name)
    )


def _gains(found: DataFrame, wanted: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket, an array of ``buckets`` integers, whatever the size of the data."""
    spark = found.sparkSession
    sums = [x.agg(F.coalesce(F.sum("n_features"), F.lit(0)).alias("n")).scalar().cast("double")
            for x in (found, wanted)]
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in "st")
    ratio = (t + 1) * (sums[0] + buckets) / ((s + 1) * (sums[1] + buckets))
    rows = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(_totals(found, "s"), "bucket", "left")
        .join(_totals(wanted, "t"), "bucket", "left")
        .select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))
    )
    table = np.zeros(buckets, np.int64)
    for bucket, gain in rows.collect():
        table[bucket] = gain
    return table


def _weighed(found: DataFrame, gains: np.ndarray) -> DataFrame:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = batch.column(4), batch.column(5)
            parts = gains[buckets.flatten().to_numpy()] * counts.flatten().to_numpy()
            upto = np.concatenate([[0], np.cumsum(parts)])
            ends = np.concatenate([[0], np.cumsum(buckets.value_lengths().to_numpy())])
            weight = pa.array(np.diff(upto[ends]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), weight],
                ["doc_id", "text_key", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(
        weigh, "doc_id long, text_key long, n_words long, n_features long, weight long"
    )


def _given(df: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    number = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    text = F.col(text_col).cast("string")
    return df.select(number.alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def importance(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    max_words: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Weight, score and rank of every document, towards the distribution of ``target``'s texts.

    Rows: doc_id, text_key, n_words, n_features, weight, score, rank. Each text is scanned once;
    the CRC of a run of words comes from two stored prefix CRCs. Per document the buckets and
    their counts are kept in the shared folder. Only the gains, ``buckets`` integers, pass through
    the driver. The best are drawn by a distributed sort; equal scores go by id, nulls last, and
    then by text.

    A null or empty text has no features and weight 0. A null id is an empty one in the hash.
    Repeated rows are documents of their own, with equal weight and score. Without documents
    there is no row; without target texts every t is 0. Other columns are ignored.
    """
    found = stored(features(_given(docs, id_col, text_col), max_words, buckets), "features")
    wanted = stored(features(_given(target, None, text_col), max_words, buckets), "target")
    rows = stored(_weighed(found, _gains(found, wanted, buckets)), "weights")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    rows = rows.withColumn("score", F.col("weight") + noise)
    able = F.col("n_words") >= least_words
    placed = numbered(
        rows.filter(able),
        [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_key")],
        "rank",
    )
    drawn = placed.agg(F.floor(F.count("*") * percent / 100).alias("n")).scalar()
    rank = (F.col("rank") + 1).cast("long")
    return placed.withColumn("rank", F.when(rank <= drawn, rank)).unionByName(
        rows.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    )


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; options are those of ``importance``.

    Rows alike in id and text are drawn together.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    drawn = importance(docs, target, **options).filter("rank IS NOT NULL")
    number, key = free_names(docs, "__id", "__key")
    keys = drawn.select(F.col("doc_id").alias(number), F.col("text_key").alias(key)).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col(number)) & (
        F.xxhash64(F.col(text_col).cast("string")) == F.col(key)
    )
    return docs.join(keys, same, "left_semi")
