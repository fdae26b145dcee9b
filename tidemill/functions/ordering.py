"""Numbers and sums along a global order, without one task that sees all rows.

Rows are cut into ranges of the order, and each range is sorted; what all ranges before a range have together, a row for each
range, is joined to its rows. Rows of equal keys may fall into several ranges, so no key is a hot one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.sources.checkpoints import checkpointed

#: ``monotonically_increasing_id`` counts a partition's rows in its low bits.
_LOW = 33


def in_ranges(df: DataFrame, order: list[Column], parts: int | None) -> DataFrame:
    """``df`` with ``_range`` and ``_at``, the place in the range from 0. Written once: the ranges stay the same, whatever is lost."""
    ties = F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() not in ("map", "variant")), F.monotonically_increasing_id())
    keyed = df.withColumn("_tie", ties)
    by = [*order, F.col("_tie")]
    cut = keyed.repartitionByRange(parts, *by) if parts else keyed.repartitionByRange(*by)
    placed = cut.sortWithinPartitions(*by).drop("_tie").withColumn("_id", F.monotonically_increasing_id())
    return checkpointed(placed.select("*", F.shiftright("_id", _LOW).alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << _LOW) - 1)).alias("_at")).drop("_id"))


def _before(held: DataFrame, amount: Column) -> DataFrame:
    """``_range`` and ``_before``: the sum of ``amount`` in all ranges before. As many rows as there are ranges."""
    by_range = held.groupBy("_range").agg(amount.alias("_amount"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return by_range.select("_range", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).cast("bigint").alias("_before"))


def numbered(df: DataFrame, order: list[Column], name: str = "place", parts: int | None = None) -> DataFrame:
    """``df`` with each row's number in the order, from 1. Equal keys are numbered in some order of their own."""
    held = in_ranges(df, order, parts)
    return held.join(F.broadcast(_before(held, F.count(F.lit(1)))), "_range").select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(name))


def running_total(df: DataFrame, order_by: str, value: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with the sum of the whole-number column ``value`` up to and with each row; nulls add nothing."""
    held = in_ranges(df, [F.col(order_by)], parts)
    here = F.coalesce(F.sum(value).over(Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    both = held.withColumn("_here", here).join(F.broadcast(_before(held, F.sum(value))), "_range")
    return both.select(*df.columns, (F.col("_before") + F.col("_here")).cast("bigint").alias(name))
