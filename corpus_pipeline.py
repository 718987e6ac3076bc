"""From raw documents to packed sequences: classify, deduplicate, redact, mix, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, folder) and works on all rows that
the stage before has kept. ``run`` applies them to the documents, storing each result as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwave.llm import mixing, ngram_join, packing, pii, quality_model
from stockwave.llm.common import table, unused
from stockwave.session import stage


def classify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the factorisation machine does not reject; it learns from the labelled ones among all documents.

    Null and empty texts are judged by their structure; repeated rows are judged alike, null ids like others; very long
    texts are read whole. An empty table stays empty. All columns stay as they are.
    """
    model = quality_model.fit(table(spark, folder, "documents"), table(spark, folder, "labels"))
    (score,) = unused(docs, "quality")
    return quality_model.with_score(docs, model, score).where(F.col(score) >= quality_model.THRESHOLD).drop(score)


def deduplicate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id, then text digest; of the same row again, one.

    Null ids come last; rows whose text is null, empty or without words are linked with nothing and stay. An empty table
    stays empty. All columns stay as they are.
    """
    return ngram_join.deduplicate(docs)


def redact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars, where there is one, follows the text.

    Null and empty texts, ids and all other columns stay, and so do repeated rows; an empty table stays empty.
    """
    return pii.with_length(pii.redact(docs))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is one of its own; texts without words are never taken. Rows equal in doc_id and text share their
    copies as evenly as possible, ties in the order of their columns. An empty table stays empty. All columns stay as they are.
    """
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences.

    A null or empty text is one piece of the end token; ids are passed on, null and repeated ones included; very long texts are
    cut into pieces. Other columns are not read; an empty table gives no pieces.
    """
    return packing.pack_documents(docs)


STAGES = [("classify", classify), ("deduplicate", deduplicate), ("redact", redact), ("mix", mix), ("pack", pack)]

#: The classifier's fit is no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, folder), f"pipeline-{name}")
    return docs
