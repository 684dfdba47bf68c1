"""Removal of word runs that already occur earlier, by seed and extend on winnowed anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerflow.llm.common import (
    MULTIPLIER,
    free_names,
    mix,
    ngram_hashes,
    rows_of,
    sliced,
    stored,
    word_hashes,
    words_of,
)

MIN_WORDS = 20
SEED_WORDS = 6

# A place is start << 32 | windows << 16 | 16 bits of the text's hash, a span being cut where its
# windows fill their bits. Rows that share an id are
# told apart by those bits; places are ordered by their start alone.
_START, _COUNT, _MOST = 32, 16, 0xFFFF
_INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((MULTIPLIER, _INVERSE)):
            table = np.full(1 << n.bit_length(), base)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=np.uint64)
    return _powers


class _Text:
    """Hashes of the words of one text and of every run of them."""

    def __init__(self, text: str | None, length: int, seed: int):
        self.words = word_hashes(words_of(text))
        n = len(self.words)
        self.windows = max(0, n - length + 1)
        self.length = length
        self.tag = xxhash.xxh64_intdigest((text or "").encode()) & 0xFFFF
        if self.windows:
            self.up, self.down = _power_tables(n + 1)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.words * self.up[:n], out=self.sums[1:])
            seeds = ngram_hashes(self.words, seed)
            view = sliding_window_view(seeds, length - seed + 1)
            self.anchor = view.argmin(axis=1) + np.arange(self.windows)
            self.anchor_hash = seeds[self.anchor]

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def spans(self) -> tuple[np.ndarray, ...]:
        """Maximal runs of windows with one anchor: anchor hash, content hash, place."""
        part = (self.anchor - np.arange(self.windows)) // _MOST
        turn = np.flatnonzero((np.diff(self.anchor) != 0) | (np.diff(part) != 0)) + 1
        start = np.concatenate([np.zeros(1, np.int64), turn])
        last = np.concatenate([turn, np.full(1, self.windows)]) - 1
        shape = ((self.anchor[start] - start) << 32 | (last - start)).astype(np.uint64)
        content = mix(self.run(start, last + self.length) + shape)
        place = (start << _START) | ((last - start + 1) << _COUNT) | self.tag
        return self.anchor_hash[start], content, place

    def single(self, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """The windows of the given spans of this text, one by one."""
        places = places[(places & 0xFFFF) == self.tag]
        count = (places >> _COUNT) & _MOST
        start = np.repeat(places >> _START, count)
        start += np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
        content = self.run(start, start + self.length)
        return self.anchor_hash[start], content, (start << _START) | (1 << _COUNT) | self.tag


_ROW = "anchor long, content long, doc_id long, place long, again boolean, torn boolean"

#: Contents of one anchor in a batch beyond which its spans are torn without asking the others.
CROWD = 16


def _found(parts: list[tuple], ids: list[int], crowd: int = 0) -> pa.RecordBatch | None:
    """Rows of one batch. What repeats an earlier place of the batch needs no other proof: it is
    marked, and its key replaced by one of its own, so that a hot key leaves a task as one row.

    With ``crowd``, an anchor of more contents than that is known to be torn. Its spans are marked
    so in the same way, but for the two of least and largest content: they tell the other batches.
    """
    if not parts:
        return None
    anchor, content, place = (np.concatenate(c) for c in zip(*parts, strict=True))
    doc = np.repeat(np.array(ids, np.int64), [len(p[0]) for p in parts])
    order = np.lexsort((place, doc, content, anchor))
    anchor, content, doc, place = anchor[order], content[order], doc[order], place[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    again = (doc != doc[head]) | (place >> _START != place[head] >> _START)
    torn = np.zeros(len(doc), bool)
    if crowd:
        turn = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, [len(doc)]])
        contents = np.add.reduceat(fresh.astype(np.int64), turn[:-1])
        torn = fresh & np.repeat(contents > crowd, np.diff(turn))
        torn[turn[:-1]] = False
        torn[head[turn[1:] - 1]] = False
    known = again | torn
    anchor = np.where(known, mix(doc.view(np.uint64) * MULTIPLIER + place.view(np.uint64)), anchor)
    content = np.where(known, np.uint64(0), content)
    columns = (anchor.view(np.int64), content.view(np.int64), doc, place, again, torn)
    return pa.RecordBatch.from_arrays(
        list(map(pa.array, columns)), ["anchor", "content", "doc_id", "place", "again", "torn"]
    )


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``again`` also where an earlier one of equal ``keys`` is in another batch."""
    at = F.struct("doc_id", F.shiftright("place", _START).alias("start"))
    first = F.min(at).over(Window.partitionBy(*keys))
    return rows.withColumn("first", first).withColumn("again", F.col("again") | (at > F.col("first")))


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with what the whole corpus says: ``again`` and, for first ones, ``torn`` if their
    anchor also occurs with other content."""
    by_anchor = Window.partitionBy("anchor")
    return (
        _repeated(rows.repartition("anchor"), "anchor", "content")
        .withColumn("low", F.min("content").over(by_anchor))
        .withColumn("high", F.max("content").over(by_anchor))
        .withColumn("torn", ~F.col("again") & (F.col("torn") | (F.col("low") < F.col("high"))))
        .filter("again OR torn")
        .select("doc_id", "place", "again", "torn")
    )


def repeated_runs(
    docs: DataFrame, length: int = MIN_WORDS, seed: int = SEED_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, places: the runs of windows of ``length`` words that also start earlier.

    Seeds are winnowed: the least hash among the ``seed``-word grams of each window, so equal
    windows have equal anchors at equal offsets. Consecutive windows of one anchor form a span.
    Spans are joined on the anchor: equal spans are matches extended to the full both ways;
    where an anchor occurs in unequal spans (at the ends of a match) their windows are joined one
    by one. One copy of the spans of each batch is shuffled, whatever
    a passage's frequency; of an anchor in many surroundings a batch sends no more than CROWD, as
    its spans are torn for certain. Only texts with torn spans are shuffled for the second part.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).filter("doc_id IS NOT NULL")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ids = [], []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = _Text(text, length, seed)
                if t.windows:
                    parts.append(t.spans())
                    ids.append(doc)
            if (found := _found(parts, ids, CROWD)) is not None:
                yield found

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            parts, ids = [], []
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = _Text(text, length, seed).single(np.unique(np.array(places, np.int64)))
                if len(rows[0]):
                    parts.append(rows)
                    ids.append(doc)
            if (found := _found(parts, ids)) is not None:
                yield found

    spans = stored(_judged(texts.mapInArrow(scan, _ROW)), "spans")
    torn = spans.filter("torn").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    torn = stored(torn, "torn")
    texts = rows_of(texts, "doc_id", torn.select("doc_id"))
    ends = _repeated(texts.join(torn, "doc_id").mapInArrow(extend, _ROW), "anchor", "content")
    return (
        spans.unionByName(ends.select(spans.columns))
        .filter("again")
        .groupBy("doc_id")
        .agg(F.collect_list("place").alias("places"))
    )


def dedup_substrings(
    docs: DataFrame, length: int = MIN_WORDS, seed: int = SEED_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with n_words, n_removed, kept_text and kept_sha256.

    A word (a run of anything but space and U+0009 to U+000D) goes if a window of ``length``
    words that covers it also starts earlier: in a smaller id, or before it in the same document.
    kept_text joins the other words by one space.

    A null or blank text has no words and keeps none. Rows without an id take part in nothing and
    keep all words. Rows that share an id count as copies at the same place: neither is earlier at
    an equal start. Added columns replace input columns of their names.
    """
    runs = stored(repeated_runs(docs, length, seed, id_col, text_col), "runs")
    added = ["n_words", "n_removed", "kept_text", "kept_sha256"]
    kept_cols = [c for c in docs.columns if c.lower() not in added]
    number, whole, listed = free_names(docs, "__id", "__text", "__places")
    base = docs.select(
        *kept_cols, F.col(text_col).cast("string").alias(whole), F.col(id_col).cast("long").alias(number)
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.select(kept_cols).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(kept_cols)):
            out = [[], [], [], []]
            texts, places = batch.column(len(kept_cols)), batch.column(len(kept_cols) + 1)
            for text, found in zip(texts.to_pylist(), places.to_pylist(), strict=True):
                words = words_of(text)
                n = len(words)
                if found:
                    found = np.array(found, np.int64)
                    tag = xxhash.xxh64_intdigest((text or "").encode()) & 0xFFFF
                    found = found[(found & 0xFFFF) == tag]
                    start = found >> _START
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + ((found >> _COUNT) & _MOST) - 1 + length, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0)]
                kept = b" ".join(words)
                out[0].append(n)
                out[1].append(n - len(words))
                out[2].append(kept.decode())
                out[3].append(hashlib.sha256(kept).hexdigest())
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            made = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept_cols)], *made], [*kept_cols, *added]
            )

    # Texts without a run to remove are not shuffled.
    ids = runs.select("doc_id")
    joined = rows_of(base, number, ids).join(runs.toDF(number, listed), number)
    others = rows_of(base, number, ids, inside=False).withColumn(
        listed, F.lit(None).cast("array<long>")
    )
    both = joined.select(*kept_cols, whole, listed).unionByName(others.select(*kept_cols, whole, listed))
    return both.mapInArrow(
        cut, f"{fields}, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
