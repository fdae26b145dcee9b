"""Reading the document tables, and columns of them; checkpoints go where the library's own do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.checkpoints import checkpointed, settled


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the columns ``more`` alone, whatever else ``docs`` has. How many rows Python gets at
    once is Spark's affair: it closes a batch at ``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by default."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it as often as needed for no column of ``df`` to have it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, also those with dots or backticks in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(docs: DataFrame, bytes_each: int) -> int:
    """How many buckets what is made of the texts of ``docs`` is dealt to: as many as a shuffle of this session has partitions, or more
    where each would have more than about so many bytes of text. The texts are read once for it, for their sizes alone."""
    whole = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(partitions(docs.sparkSession), -(-whole // bytes_each))


__all__ = ["buckets_for", "checkpointed", "columns_of", "free_name", "partitions", "read_table", "settled", "texts"]
