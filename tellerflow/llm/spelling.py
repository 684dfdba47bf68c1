"""Spelling variants: words that differ by one letter, found on a relational trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tellerflow.llm.common import MULTIPLIER, mix, slices, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "([A-Za-z\\u00C0-\\u00FF]+)"


def word_counts(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    slip: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Runs of letters, A-Z lower-cased, of at least so many code points and occurrences: word, n.

    With ``slip`` a run loses a letter if ``slip`` divides h, the crc32 of ``id:run``: the one at
    h modulo its length. Such planted slips give a corpus with known variants. A null text has no
    words, a null id is an empty one. Counts are summed within tasks before they are shuffled.
    """
    folded = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(folded, F.lit(RUNS), F.lit(1))).alias("run"),
    )
    word = F.col("run")
    if slip is not None:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
        word = F.when(F.col("h") % slip == 0, cut).otherwise(word)
    return (
        runs.select(word.alias("word"))
        .filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )


# A word is walked from both ends, in direction 0 as it is and in direction 1 reversed. A node of
# the trie is a prefix in one direction, named by its hash.

_BACK = np.uint64(pow(int(MULTIPLIER), -1, 2**64))


def _prefix_hashes(letters: np.ndarray, lengths: np.ndarray, direction: int) -> np.ndarray:
    """Of words in a row, a hash for every prefix of each, the empty and the whole one included.

    One running sum goes over all letters; the part before a word is taken off and its powers are
    divided out, which is exact modulo 2**64 as the multiplier is odd.
    """
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(letters), MULTIPLIER)]))
    upto = np.concatenate([[np.uint64(0)], np.cumsum((letters + np.uint64(1)) * powers[:-1])])
    starts = np.cumsum(lengths) - lengths
    backs = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(letters), _BACK)]))[starts]
    word = np.repeat(np.arange(len(lengths)), lengths + 1)
    depth = _depths(lengths)
    total = (upto[starts[word] + depth] - upto[starts][word]) * backs[word]
    return mix(total ^ mix(depth.astype(np.uint64) * np.uint64(2) + np.uint64(direction + 1)))


def _depths(lengths: np.ndarray) -> np.ndarray:
    """0 to n for each n."""
    ends = np.cumsum(lengths + 1)
    return np.arange(ends[-1]) - np.repeat(ends - lengths - 1, lengths + 1)


def _positions(words: DataFrame) -> DataFrame:
    """Every prefix of every word in both directions: id, direction, depth, node, and the code
    point that follows, 0 at the end. A word costs its length, however long it is."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 500_000):
                found = part.column(1).to_pylist()
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                ids = np.repeat(part.column(0).to_numpy(), lengths + 1)
                forth = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
                # Read backwards, the letters of all words are the reversed words in reverse order.
                for direction, letters, sizes, names in (
                    (0, forth, lengths, ids), (1, forth[::-1], lengths[::-1], ids[::-1])
                ):
                    follows = np.insert(letters.astype(np.int32), np.cumsum(sizes), 0)
                    nodes = _prefix_hashes(letters.astype(np.uint64), sizes, direction)
                    columns = [names, np.full(len(names), direction, np.int32),
                               _depths(sizes).astype(np.int32), nodes.view(np.int64), follows]
                    yield pa.RecordBatch.from_arrays(
                        list(map(pa.array, columns)), ["id", "direction", "depth", "node", "next"]
                    )

    return words.select("id", "word").mapInArrow(
        walk, "id long, direction int, depth int, node long, next int"
    )


def _bit(letter: str) -> str:
    """One of 63 bits for a code point; different letters may share one."""
    return f"shiftleft(1L, {letter} % 63)"


def _paths(words: DataFrame) -> DataFrame:
    """Of each word and direction the nodes it passes that are kept: id, direction, letters, path
    of (depth, node, word, nexts). Kept are the root, prefixes followed by more than one letter, and
    words; ``nexts`` has the bits of the letters that follow."""
    positions = stored(_positions(words), "positions")
    kept = (
        positions.filter("depth > 0")
        .groupBy("node")
        .agg(F.min("next").alias("lo"), F.max("next").alias("hi"),
             F.bit_or(F.expr(_bit("next"))).alias("nexts"))
        .filter("lo != hi OR lo = 0")
        .select("node", (F.col("lo") == 0).alias("word"), "nexts")
    )
    names = ["id", "direction", "depth", "node"]
    passed = positions.filter("depth > 0").select(names).join(kept, "node").unionByName(
        positions.filter("depth = 0").select(*names, F.lit(False).alias("word"), F.lit(0).alias("nexts"))
    )
    lists = passed.groupBy("id", "direction").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node", "word", "nexts"))).alias("path")
    )
    letters = F.when(F.col("direction") == 0, F.col("word")).otherwise(F.reverse("word"))
    return lists.join(words, "id").select("id", "direction", letters.alias("letters"), "path")


def _edges(paths: DataFrame) -> DataFrame:
    """The edge table: node, first letter, label, child, whether that is a word, and the letters
    after it. Labels span all letters up to the next kept node, so a node has at most one edge
    per letter of the alphabet."""
    steps = F.arrays_zip(
        F.expr("slice(path, 1, size(path) - 1)").alias("a"), F.expr("slice(path, 2, size(path))").alias("b")
    )
    return (
        paths.select("letters", F.explode(steps).alias("s"))
        .select(
            F.col("s.a.node").alias("node"),
            F.expr("substring(letters, s.a.depth + 1, s.b.depth - s.a.depth)").alias("label"),
            F.col("s.b.node").alias("child"),
            F.col("s.b.word").alias("word"),
            F.col("s.b.nexts").alias("nexts"),
        )
        .distinct()
        .withColumn("first", F.substring("label", 1, 1))
    )


_STATE = ("id", "node", "position", "edits", "rest")


def _hop(child: Column, used: Column, edits: Column) -> Column:
    """The state behind an edge after ``used`` letters of what was left of the word."""
    return F.struct(
        "id", child.alias("node"), (F.col("position") + used).alias("position"),
        edits.cast("int").alias("edits"),
        F.col("rest").substr(used + 1, F.length("rest")).alias("rest"),
    )


def _goes_on(used: Column) -> Column:
    """Whether what follows ``used`` letters may follow the child too: a state with an edit that
    could not take another step is not made."""
    left = F.col("rest").substr(used + 1, F.lit(1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(left) % 63)
    return F.when(left == "", F.col("word")).otherwise(F.col("nexts").bitwiseAND(bit) != 0)


def _level(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one edge further.

    A state without an edit meets all edges of its node: it follows its own unchanged, and any
    whose label is one edit from the letters at hand; or it drops the word's last letter and
    stays. A state with an edit only follows the edge that its letters name.
    """
    size = F.length("label")
    exact = F.startswith("rest", "label")

    def edited(more: int) -> Column:
        used = size + more
        fits = (used >= 0) & (used <= F.length("rest")) & _goes_on(used)
        near = F.levenshtein(F.col("rest").substr(F.lit(1), used), "label", 1) == 1
        return F.when(fits & near, _hop(F.col("child"), used, F.lit(1)))

    open_ = frontier.filter("edits = 0")
    follow = F.when(exact, _hop(F.col("child"), size, F.lit(0)))
    spread = open_.join(edges, "node").select(
        F.inline(F.array_compact(F.array(follow, *map(edited, (-1, 0, 1)))))
    )
    dropped = open_.filter("length(rest) = 1").select(
        F.inline(F.array(_hop(F.col("node"), F.lit(1), F.lit(1))))
    )
    first = F.substring("rest", 1, 1)
    done = frontier.filter("edits = 1").withColumn("first", first).join(edges, ["node", "first"])
    done = done.filter(exact & _goes_on(size)).select(F.inline(F.array(_hop(F.col("child"), size, F.lit(1)))))
    return spread.unionByName(dropped).unionByName(done).select(*_STATE)


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, b), each in both orders, of words that differ by exactly one inserted, deleted or
    replaced code point. ``words``: distinct strings in ``word``.

    States (word, position, node, edits) are joined with the edge table level by level; each level
    is a table in the shared folder. An edit in the second half of a word is found from its
    start, one in the first half from its end; so the walk begins at the last node at or
    before the middle, not at the crowded root. Levels follow the branches of a word, not its
    length. A state is spread over the edges of one node, one per letter of the alphabet at
    most. Node names are hashes; every pair found is confirmed on the words, which leaves no chance
    match, and none can be lost. Null words are ignored, empty ones have no neighbours here.
    """
    named = words.filter("length(word) > 0").select("word").distinct()
    named = stored(named.withColumn("id", F.monotonically_increasing_id()), "words")
    paths = stored(_paths(named), "paths")
    edges = stored(_edges(paths), "trie")
    begin = F.expr("element_at(filter(path, p -> p.depth <= length(letters) div 2), -1)")
    frontier = paths.withColumn("at", begin).select(
        "id", F.col("at.node").alias("node"), F.col("at.depth").alias("position"),
        F.lit(0).alias("edits"), F.expr("substring(letters, at.depth + 1)").alias("rest"),
    )
    ended = F.col("edits") * (F.length("rest") == 0).cast("int")
    found = None
    while True:
        seen = Observation()
        going = F.sum(1 - ended)
        level = stored(_level(frontier, edges).observe(seen, going.alias("going")), "frontier")
        here = level.filter(ended == 1).select("id", "node")
        found = here if found is None else found.unionByName(here)
        if not seen.get["going"]:
            break
        frontier = level.filter(ended == 0)
    ends = paths.select(F.expr("element_at(path, -1).node").alias("node"), F.col("id").alias("other"))
    pairs = found.distinct().join(ends, "node").select("id", "other").distinct()
    a, b = (named.select(F.col("id").alias(i), F.col("word").alias(w))
            for i, w in (("id", "a"), ("other", "b")))
    pairs = pairs.join(a, "id").join(b, "other").select("a", "b")
    return pairs.filter(F.levenshtein("a", "b", 1) == 1)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last one, twice as far in every round."""
    forms = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        seen = Observation()
        more = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = F.count("further").alias("moved")
        joined = forms.join(more, "root", "left").observe(seen, moved)
        forms = stored(joined.select("word", F.coalesce("further", "root").alias("root")), "roots")
        if not seen.get["moved"]:
            return forms


def variants(counts: DataFrame, times: int = 5) -> DataFrame:
    """Each word's usual spelling: word, n, n_near, form, form_n, root.

    ``counts``: word, n, words distinct and not null. The form is the near word of largest n, ties to
    the smallest in code-point order, if it is at least ``times`` as frequent; else null. The root
    is the end of the chain of forms, the word itself if it has none. Forms grow in frequency, so
    chains are short and have an end. An empty table gives an empty one.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    counts = stored(counts.select("word", F.col("n").cast("long").alias("n")), "counts")
    other = counts.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = (
        near_words(counts)
        .join(other, "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("top"))
    )
    usual = -F.col("top.less") >= times * F.col("n")
    table = stored(
        counts.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, F.col("top.b")).alias("form"),
            F.when(usual, -F.col("top.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(table.filter("form IS NOT NULL"))
    return table.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
