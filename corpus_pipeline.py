"""A corpus made ready for training: documents pass through five operators.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm import bpe, decontaminate, jaccard, langid, quality
from delaylens.llm.common import held_out, table
from delaylens.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be determined go."""
    net = langid.fit(docs.where(~held_out(F.col("doc_id"), 4)), "text", "lang", "doc_id")
    return langid.determined(docs, "text", net)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted bad go."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 4))
    return quality.good(docs, "text", quality.fit(docs, labels, "text", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.one_of_each(docs, "text", "doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go; a document that is nothing else goes whole."""
    benchmark = table(spark, sf_dir, "benchmark")
    length = "n_chars" if "n_chars" in docs.columns else None
    return decontaminate.remove(docs, benchmark, "doc_id", "text", "item_id", "text", length=length)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens, and digests of its ids and of the text
    decoded from them."""
    return bpe.encode_digests(docs, "text", ["doc_id"], bpe.public_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Trained stages can't be said in SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
