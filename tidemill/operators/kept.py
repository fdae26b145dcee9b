"""What is kept beside a table and changes with it: counts of groups and first moments.

Both are states that merge. Counts take what was added and give back what was removed; a first moment is a minimum, made again from the
table only for entities whose first row was removed. A change reads its own rows and those files of the state that hold
its groups, never the table as a whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.calendar import week_start
from tidemill.sources.snapshots import Side, Snapshots, nullable


@dataclass(frozen=True)
class Change:
    """Rows that came, rows that went (none: all there were), and a way to the whole table as it will be."""

    added: DataFrame
    removed: DataFrame | None
    whole: Callable[[], DataFrame]


class Kept(Protocol):
    def updated(self, target: Snapshots, base: dict | None, name: str, change: Change) -> dict[str, Side]:
        """The sides after a change of the version ``base``."""


def _summed(target: Snapshots, old: Side, moved: DataFrame, groups: list[str]) -> Side:
    """A side of counts with ``moved`` added to it; groups that nothing is left of go. Only files that hold one of its groups are rewritten."""
    schema = old.schema
    delta = target.put(moved.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("n")).where("n <> 0").select(*schema.names))
    touched = target.holding(old.files, schema, target.keys_of(delta, schema, groups), groups)
    both = target.frame(touched, schema).unionByName(target.frame(delta, schema))
    new = target.put(both.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("n")).where("n > 0").select(*schema.names))
    target.remove(delta)
    return Side([*(f for f in old.files if f not in touched), *new], schema)


@dataclass(frozen=True)
class Counts:
    """How many rows each group has. ``groups`` makes the group columns of some rows; rows with a null among them don't count."""

    groups: Callable[[DataFrame], DataFrame]

    def counted(self, rows: DataFrame) -> DataFrame:
        named = self.groups(rows).dropna()
        return named.groupBy(*named.columns).agg(F.count("*").alias("n"))

    def updated(self, target: Snapshots, base: dict | None, name: str, change: Change) -> dict[str, Side]:
        old = target.side_of(base, name)
        if old is None or change.removed is None:
            made = self.counted(change.whole() if change.removed is not None else change.added)
            return {name: Side(target.put(made), nullable(made.schema))}
        gone = self.counted(change.removed).withColumn("n", -F.col("n"))
        return {name: _summed(target, old, self.counted(change.added).unionByName(gone), [c for c in old.schema.names if c != "n"])}


def unique_set(columns: tuple[str, ...]) -> Counts:
    """Counts of the values of a unique set."""
    return Counts(lambda rows: rows.select(*columns))


@dataclass(frozen=True)
class FirstSeen:
    """The first ``moment`` of each ``entity``, and beside it, as ``<name>:weeks``, how many entities came first in each week."""

    entity: str
    moment: str

    def firsts(self, rows: DataFrame) -> DataFrame:
        there = rows.where(F.col(self.entity).isNotNull() & F.col(self.moment).isNotNull())
        return there.groupBy(F.col(self.entity).alias("entity")).agg(F.min(self.moment).alias("first_at"))

    def updated(self, target: Snapshots, base: dict | None, name: str, change: Change) -> dict[str, Side]:
        old, weeks = target.side_of(base, name), target.side_of(base, f"{name}:weeks")
        if old is None or weeks is None or change.removed is None:
            made = self.firsts(change.whole() if change.removed is not None else change.added)
            files = target.put(made)
            by_week = _weeks(target.frame(files, nullable(made.schema)))
            return {name: Side(files, nullable(made.schema)), f"{name}:weeks": Side(target.put(by_week), nullable(by_week.schema))}
        came, went = self.firsts(change.added), self.firsts(change.removed)
        named = target.put(came.select("entity").unionByName(went.select("entity")).distinct())
        touched = target.holding(old.files, old.schema, target.keys_of(named, old.schema, ["entity"]), ["entity"])
        held = target.frame(touched, old.schema)
        lost = held.join(went.withColumnRenamed("first_at", "_gone"), "entity").where("_gone <= first_at").select("entity")
        known, again = held, came
        if not lost.isEmpty():
            known = held.join(lost, "entity", "left_anti")
            again = came.unionByName(self.firsts(change.whole().join(lost.withColumnRenamed("entity", self.entity), self.entity, "left_semi")))
        new = target.put(known.unionByName(again).groupBy("entity").agg(F.min("first_at").alias("first_at")))
        moved = _weeks(target.frame(new, old.schema)).unionByName(_weeks(held).withColumn("n", -F.col("n")))
        after = {name: Side([*(f for f in old.files if f not in touched), *new], old.schema), f"{name}:weeks": _summed(target, weeks, moved, ["week_start_date"])}
        target.remove(named)
        return after


def _weeks(firsts: DataFrame) -> DataFrame:
    return firsts.groupBy(week_start(F.col("first_at")).alias("week_start_date")).agg(F.count("*").alias("n"))
