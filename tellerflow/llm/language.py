"""Language identification by sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.common import free_names, sliced

BITS = 16
SIZE = 1 << BITS
GRAMS = (1, 2, 3)
CHUNK = 1 << 20
UNDETERMINED = "und"
_letter = regex.compile(r"\p{L}").search


def _buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the lower-cased text's n-grams, in chunks; white space counts as one space."""
    points = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le"), np.uint32)
    last = max(GRAMS) - 1
    for at in range(0, max(1, len(points) - last), CHUNK):
        part = points[at : at + CHUNK + last]
        for n in GRAMS:
            count = len(part) - last if n < max(GRAMS) and at + CHUNK < len(points) else len(part) - n + 1
            if count <= 0:
                continue
            h = np.full(count, n, np.uint32)
            for i in range(n):
                h = (h ^ part[i : i + count]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            yield (h * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(SIZE, np.int64)
    for b in _buckets(text):
        total += np.bincount(b, minlength=SIZE)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class Model:
    """``table`` holds idf times weight per bucket and language, ready to be averaged over a text."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not _letter(text):
            return UNDETERMINED, 0.0
        total, n = np.zeros(len(self.languages)), 0
        for b in _buckets(text):
            total += self.table[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        p = _softmax((total / max(n, 1) + self.bias)[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int,
    alpha: float, beta: float, l1: float, l2: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader, per coordinate, with elastic net; the bias is not penalised."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        some = z[at]
        shrunk = np.sign(some) * np.maximum(np.abs(some) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            w = weights(at)
            p = _softmax((x @ w)[None, :])[0]
            p[label] -= 1
            g = np.outer(x, p)
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    every = weights(np.arange(SIZE + 1))
    return every[:SIZE], every[SIZE]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on rows that were not trained on."""
    if not len(labels):
        return 1.0
    options = np.geomspace(0.05, 20, 121)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-300)).mean()
            for t in options]
    return float(options[int(np.argmin(loss))])


def fit(
    labelled: DataFrame, sample: int = 4000, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
    l1: float = 0.01, l2: float = 1e-4, scale: float = 20.0, text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from rows with a language; document frequencies come from all of them.

    The regression itself is fitted on at most ``sample`` rows, shared equally by the languages
    and chosen by a hash of the row; a fifth of them sets the temperature. Rows without language or text and
    texts without a letter teach nothing; without any row the model knows no language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text"),
                           F.xxhash64(*map(F.col, labelled.columns)).alias("draw"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(SIZE, bool), np.zeros(SIZE, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[:] = False
                for b in _buckets(text):
                    seen[b] = True
                total += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = (
        rows.select("text").mapInArrow(frequencies, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((SIZE, 0), np.float32), np.zeros(0), 1.0)
    idf = np.full(SIZE, np.log(1 + sum(sizes.values())) + 1)
    for r in found:
        idf[r.bucket] -= np.log(1 + r.n)

    each = max(1, sample // len(languages))
    steps = 1 << 30
    chance = F.create_map(*(F.lit(x) for k in languages
                            for x in (k, int(min(1.0, each / sizes[k]) * steps))))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if _letter(text):
                    at, count = _counts(text)
                    out[0].append(lang)
                    out[1].append(at.astype(np.uint16).tobytes())
                    out[2].append((count / count.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.binary()),
                 pa.array(out[2], pa.binary())], ["lang", "at", "tf"])

    drawn = (
        rows.filter(F.pmod("draw", F.lit(steps)) < F.element_at(chance, F.col("lang")))
        .select("lang", "text")
        .mapInArrow(features, "lang string, at binary, tf binary")
        .limit(2 * sample).collect()
    )
    drawn.sort(key=lambda r: (r.lang, r["at"], r.tf))
    order = np.random.default_rng(3).permutation(len(drawn))[:sample]
    place = {lang: i for i, lang in enumerate(languages)}
    made = []
    for i in order:
        at = np.frombuffer(drawn[i]["at"], np.uint16).astype(np.int64)
        x = np.frombuffer(drawn[i].tf, np.float32) * idf[at] * scale
        made.append((np.append(at, SIZE), np.append(x, 1.0), place[drawn[i].lang]))
    cut = len(made) // 5
    weights, bias = _ftrl(made[cut:], len(languages), epochs, alpha, beta, l1, l2)
    full = np.vstack([weights, bias])
    held = np.array([x @ full[at] for at, x, _ in made[:cut]]).reshape(cut, len(languages))
    temperature = _temperature(held, np.array([label for *_, label in made[:cut]], int))
    table = (weights * idf[:, None] * scale).astype(np.float32)
    return Model(languages, table, bias, temperature)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with lang_pred and score (calibrated probability, 0 to 1).

    A text that is null or has no letter, or any text if the model knows no language, is ``und``
    with score 0. Ids may be null or repeat. Added columns replace input columns of their names.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    base = docs.select(*kept, F.col(text_col).cast("string").alias(*free_names(docs, "__text")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema[:-1])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in sliced(batches, len(kept)):
            found = [own.predict(t) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*kept, "lang_pred", "score"],
            )

    return base.mapInArrow(predict, f"{fields}, lang_pred string, score double")
