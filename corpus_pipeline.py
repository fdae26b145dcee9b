"""From documents to packed training sequences.

Each stage takes the session, the documents that the stage before kept and the folder of the other tables, and returns a
frame; all but the last return the columns of documents. What a stage decides takes effect: rejected and repeated documents
and those with benchmark passages are gone, secrets are replaced by a marker. Defined results: null and empty texts have the
classifier's score of no words, and where they pass it they stay to the end, a piece of one token each; without labels of
both kinds there is no classifier and every document passes; rows of one id are judged each by its text; empty tables of
documents give empty frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.decontaminate import clean_documents
from tidemill.llm.ngram_join import one_of_each
from tidemill.llm.packing import packed
from tidemill.llm.quality import good_documents
from tidemill.llm.secrets import redacted
from tidemill.llm.tables import checkpointed, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a marker."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: SQL has neither the trained classifier nor the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
