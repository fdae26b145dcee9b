"""Weeks, gap-free calendars and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def week_start(ts: Column) -> Column:
    """The Monday of a moment's week, as a date."""
    return F.date_trunc("week", ts).cast("date")


def add_days(day: Column, n: int) -> Column:
    return F.date_add(day, n)


def last_completed_week(as_of: str) -> Column:
    """The Monday of the last week that was over on a day."""
    return week_start(add_days(F.lit(as_of).cast("date"), -7))


def calendar_spine(bounds: DataFrame, step_days: int = 7) -> DataFrame:
    """``day``: each ``step_days`` from ``first`` to ``last`` of a one-row frame; of null bounds, none."""
    return bounds.where("first IS NOT NULL AND last IS NOT NULL").select(F.explode(F.sequence("first", "last", F.expr(f"interval {step_days} days"))).alias("day"))


def trend_of_weeks(weekly: DataFrame, as_of: str) -> DataFrame:
    """``week_start_date``, ``new_entities``, ``cumulative_entities`` of the completed weeks, without gaps, from counts ``n`` by ``week_start_date``."""
    counts = weekly.where(F.col("week_start_date") <= last_completed_week(as_of)).withColumnRenamed("n", "new_entities")
    bounds = counts.agg(F.min("week_start_date").alias("first"), F.greatest(F.max("week_start_date"), last_completed_week(as_of)).alias("last"))
    bounds = bounds.withColumn("last", F.when(F.col("first").isNotNull(), F.col("last")))
    spine = calendar_spine(bounds).withColumnRenamed("day", "week_start_date")
    filled = spine.join(counts, "week_start_date", "left").select("week_start_date", F.coalesce("new_entities", F.lit(0)).cast("bigint").alias("new_entities"))
    # A row each week by now: one task orders a few thousand. For raw rows there is ``ordering.running_total``.
    total = F.sum("new_entities").over(Window.orderBy("week_start_date").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return filled.withColumn("cumulative_entities", total.cast("bigint"))


def first_seen_trend(events: DataFrame, entity: str, ts: str, as_of: str) -> DataFrame:
    """``trend_of_weeks`` of the weeks in which entities were first seen. Events after ``as_of`` don't count. The data shrinks to a row for each
    entity, then for each week, before anything is ordered."""
    now = F.lit(as_of).cast("timestamp")
    first = events.where(F.col(ts).cast("timestamp") <= now).groupBy(entity).agg(week_start(F.min(ts)).alias("week_start_date"))
    return trend_of_weeks(first.groupBy("week_start_date").agg(F.count("*").alias("n")), as_of)
