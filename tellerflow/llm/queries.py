"""The numbered queries: each applies one operator to its whole table, (spark, directory) -> rows."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.llm import (
    decontaminate,
    embeddings,
    fingerprints,
    html,
    language,
    lm,
    minhash,
    packing,
    resample,
    spelling,
    substring,
    tokens,
    urls,
)
from tellerflow.llm.common import prepare, stored

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES: list[urls.Rule] = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public tokenizer file; the package is looked up, not imported, to find its folder."""
    return str(Path(importlib.util.find_spec("public_tokenizers").origin).with_name(name))


def remainder(id_col: str, by: int):
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % by


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's number in its path is the document it was made from; that document's quality
    label, where there is one, labels the url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.host_and_path(F.col("url"))[1], "/([0-9]{1,18})(?:[/.]|$)", 1)
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("number"), (F.col("quality") == 0).alias("bad")
    )
    labelled = pages.select("url", number.alias("number")).join(labels, "number")
    return urls.judge(pages, URL_RULES, labelled)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("row_key")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False
    )


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(
        table(spark, sf_dir, "documents"), percent=85, bands=21, rows=6
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(
        table(spark, sf_dir, "documents").select("doc_id", "text")
    ).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")
    )


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.fit(docs.filter(remainder("doc_id", 7) != 2))
    return lm.score_texts(model, docs).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10
    ).select("doc_id", "n_features", "weight", "score", "rank")


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints beside those of the half-edited texts, and the documents within 7 bits."""
    rows = stored(fingerprints.half_edits(table(spark, sf_dir, "documents")), "fingerprints")
    return fingerprints.with_near(rows, radius=7).withColumns(
        {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), slip=199))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    numbered = (
        op1_embedding_neardup, op2_url_filter, op3_decontaminate, op4_packing,
        op5_minhash_neardup, op6_language_id, op7_substring_dedup, op8_token_count,
        op9_html_extract, op10_lm_score, op11_importance_resample,
        op12_document_fingerprints, op13_spelling_groups,
    )
    return {"pipeline": corpus_pipeline.run} | {q.__name__: q for q in numbered}
