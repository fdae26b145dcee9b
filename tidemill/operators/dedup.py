"""One row for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The row of each key that comes first by ``order_by``; give an order without ties, and the result is always the same.

    Shuffled once, by the keys; only rows of equal keys meet. Null keys are equal."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where("_rank = 1").drop("_rank")


def last_landed(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key that landed last; of equal places, that of the larger row hash."""
    rest = [c for c in df.columns if not c.startswith("_")]
    return dedup_latest(df, keys, [F.desc("_seq"), F.desc("_pos"), F.desc(F.xxhash64(*rest))])


def daily_latest(df: DataFrame, keys: list[str], raw_time: str, day: str, tie: list[Column]) -> DataFrame:
    """One row for each key and day: the latest moment of the day, rows without a readable one last."""
    moment = F.col(raw_time).try_cast("timestamp")
    return dedup_latest(df, [*keys, day], [moment.desc_nulls_last(), *tie])


def duplicate_groups(df: DataFrame, keys: list[str], limit: int = 3) -> DataFrame:
    """The ``limit`` largest groups of rows with equal, non-null keys, and ``n_rows`` of each; a report, not a repair."""
    rows = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1").orderBy(F.desc("n_rows"), *keys).limit(limit)
