"""Filter, deduplicate, decontaminate and pack the documents table in stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import pick, read, stage
from fundlake.llm.decontaminate import contaminations
from fundlake.llm.ngram_join import near_duplicates
from fundlake.llm.packing import pack_documents
from fundlake.llm.quality import score_quality
from fundlake.llm.substrings import remove_repeated

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the ids in ``gone``; a null id is never gone."""
    ids = gone.select(F.col("doc_id").alias("gone_id")).where("gone_id is not null").distinct()
    return docs.join(ids, F.col("doc_id") == F.col("gone_id"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels of ``sf_dir``, does not reject."""
    docs = pick(docs, **COLUMNS)
    labels = read(spark, sf_dir, "labels", doc_id="long", quality="int")
    return _without(docs, score_quality(docs, labels).where("predicted = 0"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; of rows that repeat an id, all."""
    docs = pick(docs, **COLUMNS)
    return _without(docs, near_duplicates(docs).where("component_id < doc_id"))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has. A text that loses words becomes its kept words with one
    space between them; others stay as they are, and a document of which nothing is left goes."""
    cut = remove_repeated(pick(docs, **COLUMNS)).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id", F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark in ``sf_dir``."""
    docs = pick(docs, **COLUMNS)
    benchmark = read(spark, sf_dir, "benchmark", item_id="long", text="string")
    return _without(docs, contaminations(docs, benchmark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place in it."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("substring", substring),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next."""
    docs = read(spark, sf_dir, "documents", **COLUMNS)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
