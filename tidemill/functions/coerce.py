"""Casts and small text functions. What cannot be read as the wanted type is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_bool(x: Column) -> Column:
    """Exactly ``true`` or ``false``; anything else is null (a plain cast would take ``TRUE`` and ``1``)."""
    return F.when(x == "true", True).when(x == "false", False)


def to_double(x: Column) -> Column:
    return x.try_cast("double")


def to_timestamp(x: Column) -> Column:
    """A moment, read as UTC where no offset is given; empty text is null."""
    return F.nullif(x, F.lit("")).try_cast("timestamp")


def date_prefix(x: Column) -> Column:
    """Midnight UTC of the date in a text's first ten characters."""
    return F.substring(x, 1, 10).try_cast("date").cast("timestamp")


def sniff_timestamps(df: DataFrame, order_by: str) -> DataFrame:
    """Text columns whose first non-empty value, in the order of ``order_by``, looks like a date with a time of day become
    timestamps; values that aren't become null. One aggregate row reaches the driver."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    filled = [F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(order_by))).alias(c) for c in names]
    first = df.agg(*(x.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}").alias(c) for c, x in zip(names, filled, strict=True))).first()
    return df.select(*(to_timestamp(F.col(c)).alias(c) if c in names and first[c] else F.col(c) for c in df.columns))


def truncate_middle(x: Column, limit: int = 4000, head: int = 2000, tail: int = 2000, marker: str = "[truncated]") -> Column:
    """A text of more than ``limit`` characters: its head, a marker and its tail. Others and null as they are."""
    return F.when(F.length(x) > limit, F.concat(F.left(x, F.lit(head)), F.lit(marker), F.right(x, F.lit(tail)))).otherwise(x)


def split_first(x: Column, separator: str) -> Column:
    """(head, rest) at the first separator; null where there is none or either side is empty."""
    head = F.substring_index(x, separator, 1)
    rest = F.substring(x, F.length(head) + 1 + len(separator), F.length(x))
    return F.when(F.contains(x, F.lit(separator)) & (head != "") & (rest != ""), F.struct(head.alias("head"), rest.alias("rest")))


def empty_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def array_text(values: Column) -> Column:
    """The elements with commas between; null where there are none."""
    return empty_to_null(F.array_join(values, ","))


def array_json(values: Column) -> Column:
    """A list as JSON text; null where it is null or empty."""
    return F.when(F.size(values) > 0, F.to_json(values))


def repack(**parts: Column) -> Column:
    """An object of the given parts as JSON text; nulls are left out, and of nulls alone it is null."""
    return F.nullif(F.to_json(F.struct(*(x.alias(n) for n, x in parts.items()))), F.lit("{}"))


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(3.6e9)
