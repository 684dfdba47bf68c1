"""Bounded-space online packing of tokenized documents into training sequences."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.common import sliced, stored
from tellerflow.llm.tokens import byte_letters, tokenizer

#: Words a worker remembers before it starts anew; a word counts from its second occurrence on.
REMEMBERED = 300_000
_MET = 1 << 21
_MERGED = 1 << 62
_PLAIN = re.compile("([a-z\u00df-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)")


class _Encoder:
    """Ids of a text as little-endian 32-bit numbers.

    The vocabularies this serves drop white space and divide at it, so the ids of a text are those
    of its words one after the other. Words are remembered with A-Z folded, as the vocabulary
    folds them. Letters of Latin-1 and a stop mark behind them need no more than lower case before
    the merges; other words, and texts that may hold a special string, are left to the library.
    """

    def __init__(self, path: str):
        own = tokenizer(path)
        self.whole = own
        merge, letters = own.model.tokenize, str.maketrans(
            {chr(b): c for b, c in byte_letters().items()}
        )

        def plain(piece: str) -> list[int]:
            return [t.id for t in merge(piece.encode().decode("latin-1").translate(letters))]
        self.special = {t.content[:2].encode() for t in own.get_added_tokens_decoder().values()}

        class Words(dict):
            met = bytearray(_MET)

            def __missing__(self, word: bytes) -> bytes:
                text = word.decode()
                parts = _PLAIN.fullmatch(text.lower())
                if parts:
                    ids = plain(parts[1]) + (plain(parts[2]) if parts[2] else [])
                else:
                    ids = own.encode(text, add_special_tokens=False).ids
                data = array("I", ids).tobytes()
                slot = hash(word) % _MET
                if self.met[slot] and len(word) < 100:
                    if len(self) >= REMEMBERED:
                        self.clear()
                        self.met = bytearray(_MET)
                    self[word] = data
                self.met[slot] = 1
                return data

        self.words = Words()

    def encode(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        if any(s in raw for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, raw.lower().split()))


_encoders: dict[str, _Encoder] = {}

#: doc_id, start, ids, doc_tokens
Piece = tuple[int | None, int, bytes, int]


def _size(piece: Piece) -> int:
    return len(piece[2]) // 4


def _cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * at], total), (doc, start + at, ids[4 * at :], total)


@dataclass
class _Window:
    pieces: list[Piece] = field(default_factory=list)
    used: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.used += _size(piece)


def _merge(pieces: list[Piece], length: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences from the pieces in their order, cut where one is full; and the rest."""
    full, now = [], _Window()
    for piece in pieces:
        while now.used + _size(piece) >= length:
            head, piece = _cut(piece, length - now.used)
            now.add(head)
            full.append(now.pieces)
            now = _Window()
        if piece[2]:
            now.add(piece)
    return full, now.pieces


def _place(piece: Piece, windows: list[_Window], length: int, limit: int) -> Iterator[list[Piece]]:
    """Put a document into the open windows; yields the sequences this fills."""
    full, rest = _merge([piece], length)
    yield from full
    for piece in rest:
        size = _size(piece)
        fitting = [w for w in windows if w.used + size <= length]
        if fitting:
            best = max(fitting, key=lambda w: w.used)
            best.add(piece)
            if best.used == length:
                windows.remove(best)
                yield best.pieces
            continue
        if len(windows) == limit:  # the fullest is filled with the head of the document
            fullest = max(windows, key=lambda w: w.used)
            head, piece = _cut(piece, length - fullest.used)
            fullest.add(head)
            windows.remove(fullest)
            yield fullest.pieces
            yield from _place(piece, windows, length, limit)
            continue
        windows.append(_Window())
        windows[-1].add(piece)


_COLUMNS = {
    "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(), "ids": pa.binary(),
    "part": pa.int64(),
}
_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, offset long, ids binary, part long")


class _Rows:
    """Output rows of one task."""

    def __init__(self, base: int, with_ids: bool):
        self.next, self.with_ids, self.rows = base, with_ids, []

    def sequence(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, offset,
                              ids if self.with_ids else None, None))
            offset += n
        self.next += 1

    def left(self, pieces: list[Piece], part: int) -> None:
        for order, (doc, start, ids, total) in enumerate(pieces):
            self.rows.append((doc, start, len(ids) // 4, 0, total, None, order, ids, part))

    def columns(self) -> list[pa.Array]:
        rows, self.rows = self.rows, []
        return [pa.array([r[i] for r in rows], k) for i, k in enumerate(_COLUMNS.values())]


def pack(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, open_windows: int = 32,
    merge_parts: int = 64, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids (little-endian uint32).

    A document is its tokens and ``end_id``. Whole sequences of a long one stand alone; the rest
    goes to the open window it fills best. If none has room, the fullest is filled with its head
    and emitted. At the end of a partition the open windows are merged into full sequences, and
    what is left, less than one, is merged with that of up to ``merge_parts`` partitions. The last
    tokens of such a group are divided into powers of two, which need no padding.

    A task holds ``open_windows`` windows, one batch of texts and the tokens of one document. The
    tokenizer file must be readable on every executor. Sequence ids follow from the partition, so
    a task that runs again gives the same rows.

    A null or blank text is the end alone. Null ids are kept as null; rows that repeat an id are
    documents of their own. Other columns are ignored.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = _Encoder(path)
        encode, end = _encoders[path].encode, np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        out, windows = _Rows(part << 32, with_ids), []
        for batch in sliced(batches, 1):
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = encode(text) + end
                for full in _place((doc, 0, ids, len(ids) // 4), windows, length, open_windows):
                    out.sequence(full)
            yield pa.RecordBatch.from_arrays(out.columns(), list(_COLUMNS))
        windows.sort(key=lambda w: -w.used)
        full, rest = _merge([p for w in windows for p in w.pieces], length)
        for pieces in full:
            out.sequence(pieces)
        out.left(rest, part)
        yield pa.RecordBatch.from_arrays(out.columns(), list(_COLUMNS))

    def merge(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["offset"]))
        out = _Rows(_MERGED + (rows[0]["part"] // merge_parts << 32), with_ids)
        full, rest = _merge([(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in rows],
                            length)
        for pieces in full:
            out.sequence(pieces)
        while rest:
            size = 1 << sum(map(_size, rest)).bit_length() - 1
            full, rest = _merge(rest, size)
            for pieces in full:
                out.sequence(pieces)
        return pa.Table.from_arrays(out.columns(), list(_COLUMNS))

    pieces = stored(
        docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
            fill, _SCHEMA
        ),
        "pieces",
    )
    left = pieces.filter("part IS NOT NULL").groupBy(F.floor(F.col("part") / merge_parts))
    all_rows = pieces.filter("part IS NULL").unionByName(left.applyInArrow(merge, _SCHEMA))
    return all_rows.drop("part") if with_ids else all_rows.drop("part", "ids")
