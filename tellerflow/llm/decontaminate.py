"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

DataFrame functions only; nothing here runs Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.llm.common import free_names, stored

SHINGLE_WORDS = 5
BLOCKS = 8
BLOCK_RADIUS = 2
#: Two fingerprints this close agree to BLOCK_RADIUS bits in one of the BLOCKS at least.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Rows up to which a table made from the benchmark is sent to every executor.
BROADCAST_ROWS = 1_000_000


def _shingles(text: Column) -> Column:
    """Hashes of the five-word shingles in order of place; null for shorter texts."""
    words = F.filter(F.split(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def joined(h: Column) -> Column:
        return F.when(
            F.size(h) >= SHINGLE_WORDS,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - SHINGLE_WORDS),
                lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(SHINGLE_WORDS))),
            ),
        )

    # One binding for the hashed words, so that they are computed once and not for each place.
    return F.flatten(F.transform(F.array(hashed), joined))


def _simhash(shingles: Column) -> Column:
    """64 bits; a bit is set if more than half of the shingles, each occurrence counted, have it."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.aggregate(
            shingles, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int")
        ) * 2 > F.size(shingles),
    )
    return F.aggregate(
        bits, F.lit(0).cast("long"), lambda f, b: F.shiftleft(f, 1).bitwiseOR(b.cast("long"))
    )


def _block(fingerprint: Column, i: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * i).bitwiseAND(F.lit(255)).cast("int")


def _common(a: Column, b: Column) -> Column:
    """Size of the intersection of two bags."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))

    def times(bag: Column, x: Column) -> Column:
        return F.size(F.filter(bag, lambda y: y == x))

    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))
    )
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def _sent(df: DataFrame) -> DataFrame:
    """With a broadcast hint if its counted rows are few; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit("\0"), F.col(text_col).cast("string"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start, n_words,
    hamming, similarity (of the best window, the first of equals), row_key.

    An item of L words is compared with windows of L words of the lower-cased document (cut at its
    end). Similarity is the weighted Jaccard of five-word shingles, a shingle's weight being the
    number of its occurrences. A window that reaches it has at least ``similarity`` * (L - 4)
    shingles of items of that length, so only such windows get a fingerprint. Fingerprints within
    RADIUS bits of an item's agree in one block up to BLOCK_RADIUS bits; all values of an item's
    blocks that near are looked up by equality. Candidates are then verified on their shingles.

    Null texts and texts or items under five words leak nothing. Repeated documents or items give
    one row per pair of ids. Documents and items without an id are told apart by their text and
    reported with a null id, a row for each. Extra columns are ignored, whatever their names.
    """
    items = stored(
        benchmark.select(
            F.col(item_col).alias("item_id"), _shingles(F.col(item_text_col)).alias("item")
        )
        .filter("size(item) > 0")
        .distinct()
        .withColumn("item_key", F.xxhash64(F.col("item_id").cast("string"), "item"))
        .withColumn("span", F.size("item"))
        .withColumn("item_print", _simhash(F.col("item"))),
        "items",
    )
    grams = stored(
        items.select(F.explode("item").alias("gram"), "span").groupBy("gram")
        .agg(F.collect_set("span").alias("spans")),
        "grams",
    )
    texts = docs.select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"),
        _shingles(F.col(text_col)).alias("all"),
    )
    hits = (
        texts.select("doc_id", "row", F.posexplode("all").alias("at", "gram"))
        .join(_sent(grams), "gram")
        .select("doc_id", "row", F.explode("spans").alias("span"), "at")
    )
    need = F.ceil(F.col("span") * F.lit(similarity) - F.lit(1e-9)).cast("int")

    def starts(i: Column) -> Column:
        first, last = F.get("p", i), F.get("p", i + F.col("need") - 1)
        return F.when(
            last - first < F.col("span"),
            F.sequence(F.greatest(F.lit(0), last - F.col("span") + 1), first),
        ).otherwise(F.array().cast("array<int>"))

    windows = (
        hits.groupBy("doc_id", "row", "span")
        .agg(F.sort_array(F.collect_set("at")).alias("p"))
        .withColumn("need", need)
        .filter("size(p) >= need")
        .withColumn(
            "starts",
            F.array_distinct(
                F.flatten(F.transform(F.sequence(F.lit(0), F.size("p") - F.col("need")), starts))
            ),
        )
        .filter("size(starts) > 0")
        .select("row", "span", "starts")
    )
    windows = stored(windows, "windows")
    printed = (
        texts.join(windows, "row")
        .select("doc_id", "row", "span", "all", F.explode("starts").alias("start"))
        .select("doc_id", "row", "span", "start",
                F.slice("all", F.col("start") + 1, F.col("span")).alias("window"))
        .withColumn("print", _simhash(F.col("window")))
    )
    printed = stored(printed.distinct(), "prints")
    near = F.filter(
        F.sequence(F.lit(0), F.lit(255)),
        lambda v: F.bit_count(v.bitwiseXOR(F.col("value"))) <= BLOCK_RADIUS,
    )
    blocks = F.posexplode(F.array(*(_block(F.col("item_print"), i) for i in range(BLOCKS))))
    lookup = (
        items.select("item_key", "span", "item_print", blocks.alias("block", "value"))
        .withColumn("value", F.explode(near))
    )
    ours = F.posexplode(F.array(*(_block(F.col("print"), i) for i in range(BLOCKS))))
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    candidates = (
        printed.select("doc_id", "row", "span", "start", "print", ours.alias("block", "value"))
        .join(_sent(lookup), ["span", "block", "value"])
        .filter(apart <= RADIUS)
        .select("row", "span", "start", "item_key", apart.alias("hamming"))
        .distinct()
    )
    shared = _common(F.col("window"), F.col("item"))
    found = (
        candidates.join(printed.select("doc_id", "row", "span", "start", "window"),
                        ["row", "span", "start"])
        .join(items.select("item_key", "item_id", "span", "item"), ["item_key", "span"])
        .withColumn("shared", shared)
        .withColumn("similarity",
                    F.col("shared") / (F.size("window") + F.size("item") - F.col("shared")))
        .filter(F.col("similarity") >= similarity)
    )
    best = F.max_by(
        F.struct("start", F.col("span").alias("n_words"), "hamming", "similarity", "row"),
        F.struct("similarity", -F.col("start"), -F.col("span"), "row"),
    )
    no_doc, no_item = (F.when(F.col(i).isNull(), F.col(own)).alias(f"no_{i}")
                       for i, own in (("doc_id", "row"), ("item_id", "item_key")))
    return found.groupBy("doc_id", "item_id", no_doc, no_item).agg(best.alias("b")).select(
        "doc_id",
        "item_id",
        F.col("b.start").cast("long").alias("start"),
        (F.col("b.n_words") + SHINGLE_WORDS - 1).cast("long").alias("n_words"),
        F.col("b.hamming").cast("int").alias("hamming"),
        F.col("b.similarity").alias("similarity"),
        F.col("b.row").alias("row_key"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Goes by id, so a repeated id goes with all its rows; a row without an id goes by itself.
    """
    bad = leaks(docs, benchmark, similarity, id_col, text_col)
    named = stored(bad.select("doc_id", "row_key"), "leaks")
    (leak,) = free_names(docs, "__leak")
    by_id = F.col(id_col) == F.col(leak)
    kept = docs.join(named.select(F.col("doc_id").alias(leak)).distinct(), by_id, "left_anti")
    no_id = named.filter("doc_id IS NULL").select(F.col("row_key").alias(leak)).distinct()
    same_row = F.col(id_col).isNull() & (row_key(id_col, text_col) == F.col(leak))
    return kept.join(no_id, same_row, "left_anti")
