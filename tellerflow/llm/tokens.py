"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# The pattern by which byte-level vocabularies of this kind divide a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Merged strings a worker remembers before it starts anew.
REMEMBERED = 400_000


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to be one token: each was encoded alone and gave its own id."""
    t = tokenizer(path)
    raw = {letter: byte for byte, letter in byte_letters().items()}
    pieces = regex.compile(PATTERN)
    proven = set()
    for letters, number in t.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(raw[c] for c in letters).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: no text is this token alone
        if pieces.fullmatch(text) and t.encode(text, add_special_tokens=False).ids == [number]:
            proven.add(text)
    return frozenset(proven)


class Counter:
    """Counts the tokens of a text with one tokenizer file."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tokenizer = tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = regex.compile(PATTERN).findall
        letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        merge = self.tokenizer.model.tokenize

        class Counts(dict):
            def __missing__(self, piece: str) -> int:
                if len(self) > len(whole) + REMEMBERED:
                    self.clear()
                    self.update(dict.fromkeys(whole, 1))
                n = len(merge(piece.encode().decode("latin-1").translate(letters)))
                if len(piece) < 100:
                    self[piece] = n
                return n

        self.counts = Counts.fromkeys(whole, 1)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        # Special strings are cut out before the text is divided; leave that to the library.
        if any(s in text for s in self.special):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.counts.__getitem__, self.pieces(text)))


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, for a byte-level vocabulary file.

    Texts are divided into pre-tokens; those proven to be one token are counted as they are, and
    only the others are merged. The proof is made once and sent to the workers; its size is the
    vocabulary's. ``path`` must be readable on every executor.

    A null or empty text has no bytes and no tokens. Null and repeated ids are returned as they
    are; other columns are ignored.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path, whole.value)
        counter = _counters[path]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
