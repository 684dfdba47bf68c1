"""Documents to training sequences in five stages; each works on all rows the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.llm import decontaminate, language, minhash, packing, substring
from tellerflow.llm.common import prepare, rows_of, stored
from tellerflow.llm.queries import table, tokenizer_path

#: A document goes if no language reaches this calibrated probability. Little above chance, since
#: very short texts in a known language score 0.4 and more and are to stay.
LEAST_LANGUAGE_SCORE = 0.3

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the labelled languages stay; null texts and texts without letters go."""
    prepare(spark)
    model = language.fit(docs.select("text", "lang"))
    found = language.identify(docs, model)
    keep = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(keep).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    An id is one document: it goes or stays with all its rows. Of rows alike in id and text one
    stays, the least by its other columns; rows of one id with other texts stay, and rows without
    an id. Only rows of an id that repeats are shuffled.
    """
    prepare(spark)
    groups = minhash.near_duplicates(docs, percent=80, bands=25, rows=5)
    gone = stored(groups.filter("NOT kept").select("doc_id").distinct(), "gone")
    kept = rows_of(docs, "doc_id", gone, inside=False)
    counts = kept.filter("doc_id IS NOT NULL").groupBy("doc_id").count()
    twice = stored(counts.filter("count > 1").select("doc_id"), "twice")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    reduced = (
        rows_of(kept, "doc_id", twice).groupBy("doc_id", "text")
        .agg(F.min(F.struct(*others)).alias("row")).select("doc_id", "text", "row.*")
    )
    once = rows_of(kept, "doc_id", twice, inside=False)
    return once.select(*COLUMNS).unionByName(reduced).select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 20 words that occur earlier are cut out. A text without such runs stays as it is;
    one of which nothing is left goes, while a text that had no words stays."""
    prepare(spark)
    cut = substring.dedup_substrings(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long"))
    return (
        cut.filter("n_removed < n_words OR n_words = 0")
        .withColumn("n_chars", F.coalesce(chars, "n_chars"))
        .withColumn("text", text)
        .select(*COLUMNS)
    )


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids in sequences of 2048."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("minhash_neardup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontaminate", drop_benchmark_leaks),
    ("pack", pack_sequences),
]

#: No stage after the first can do without fitted weights or hashes that SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
