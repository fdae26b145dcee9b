"""Which rows a run takes: windows, watermarks, parent keys, and what is left to do."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.coerce import split_first

MODES = ("full", "forward", "backfill", "transform")


def date_window(mode: str, coverage: dict | None, as_of: datetime, start: datetime | None = None, end: datetime | None = None) -> tuple[datetime | None, datetime | None]:
    """Where a run's rows start and end. Two given dates win; a forward run goes from the forward watermark to the present, a
    backfill up to the backward watermark; a full run has no bounds. ``coverage``: the watermarks, as a row of one."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if start is not None and end is not None:
        return start, end
    marks = coverage or {}
    if mode == "forward":
        return marks.get("forward_watermark"), as_of
    if mode == "backfill":
        return None, marks.get("backward_watermark") or as_of
    return None, None


def in_window(df: DataFrame, column: str, start: datetime | None, end: datetime | None = None, as_of: datetime | None = None, lookback_days: int | None = None, besides: Column | None = None) -> DataFrame:
    """Rows from ``start`` (taken in) to ``end``; with a lookback, none older than that many days; and those of the condition
    ``besides``, wherever they are. Plain comparisons with literals of the column's own type, so that they reach the scan."""
    if lookback_days is not None and as_of is not None:
        cap = as_of - timedelta(days=lookback_days)
        start = cap if start is None else max(start, cap)
    kind = df.schema[column].dataType
    bounds = [F.col(column) >= F.lit(start).cast(kind)] if start is not None else []
    bounds += [F.col(column) <= F.lit(end).cast(kind)] if end is not None else []
    for bound in bounds:
        df = df.where(bound if besides is None else bound | besides)
    return df


def watermarks(df: DataFrame, column: str, *by: str) -> DataFrame:
    """``low``, ``high``, ``n_unread`` of an incremental column, text or moment, for each ``by``; what can't be read doesn't count."""
    moment = F.col(column).cast("string").try_cast("timestamp")
    aggregates = (F.min(moment).alias("low"), F.max(moment).alias("high"), F.count_if(F.col(column).isNotNull() & moment.isNull()).alias("n_unread"))
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def coverage_update(marks: DataFrame, mode: str) -> DataFrame:
    """``marks`` (``dataset``, ``tenant``, ``low``, ``high``) as an update of coverage: full and forward runs move the forward mark, full and
    backfill runs the backward one; datasets without dates have none."""
    null = F.lit(None).cast("timestamp")
    return marks.where("low IS NOT NULL").select(
        "dataset", "tenant", (F.col("high") if mode in ("full", "forward") else null).alias("forward_watermark"), (F.col("low") if mode in ("full", "backfill") else null).alias("backward_watermark")
    )


def merge_coverage(coverage: DataFrame, update: DataFrame) -> DataFrame:
    """Coverage with an update; marks only move outwards, and what an update doesn't say stays."""
    new = update.toDF(*(c if c in ("dataset", "tenant") else f"new_{c}" for c in update.columns))
    both = coverage.join(new, ["dataset", "tenant"], "full")
    return both.select("dataset", "tenant", F.greatest("forward_watermark", "new_forward_watermark").alias("forward_watermark"), F.least("backward_watermark", "new_backward_watermark").alias("backward_watermark"))


def tenant_prefix(column: str, tenant: str) -> Column:
    """Keys of a tenant, ``tenant/...``, whatever their case; no tenant: all."""
    return F.startswith(F.lower(column), F.lit(f"{tenant.lower()}/")) if tenant else F.lit(True)


def entity_keys(parent: DataFrame, key: list[str], tenant: str = "", limit: int | None = None) -> DataFrame:
    """The different keys of a parent table, of a tenant if one is named. ``limit`` is for trials."""
    keys = parent.select(*(F.col(f"`{k}`") for k in key)).where(tenant_prefix(f"`{key[0]}`", tenant)).distinct()
    return keys if limit is None else keys.orderBy(*(f"`{k}`" for k in key)).limit(limit)


def of_parents(children: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key a parent has (null keys: no parent has them); Spark broadcasts the keys or not by their size."""
    return children.join(keys, on, "left_semi")


def remaining(keys: DataFrame, ledger: DataFrame, on: list[str]) -> DataFrame:
    """Keys that the ledger of done work doesn't have."""
    return keys.join(ledger.select(*on), on, "left_anti")


def split_names(df: DataFrame, column: str, head: str, rest: str) -> DataFrame:
    """``owner/name`` as two columns, split at the first slash; rows without both parts are dropped."""
    parts = split_first(F.col(column), "/")
    return df.withColumn("_parts", parts).where("_parts IS NOT NULL").withColumn(head, F.col("_parts.head")).withColumn(rest, F.col("_parts.rest")).drop("_parts")


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def decode(df: DataFrame, column: str, choices: DataFrame, element: str, into: str) -> DataFrame:
    """``df`` with the label that ``choices`` (``element``, ``value``, ``label``) has for a coded column; unknown codes stay without."""
    labels = choices.where(F.col("element") == element).groupBy("value").agg(F.min("label").alias(into))
    return df.join(labels.withColumnRenamed("value", column), column, "left").select(*df.columns, into)
