"""Checks of a frame, compiled to one aggregate pass; checks of uniqueness have a shuffle of their own."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.coerce import empty_to_null


@dataclass(frozen=True)
class CheckReport:
    """``violations``: the rows that break a check of rows, with the names of those checks in ``_broken``, if they were asked for."""

    failures: tuple[str, ...] = ()
    warnings: tuple[str, ...] = ()
    violations: DataFrame | None = None

    @property
    def passed(self) -> bool:
        return not self.failures


class Check:
    """A check names the aggregates it needs, then reads them. ``blocking``: what it finds fails the run. Checks of single rows also tell
    which rows break them."""

    blocking = True

    def aggregates(self, df: DataFrame) -> dict[str, Column]:
        return {}

    def breaks(self, df: DataFrame) -> dict[str, Column]:
        """By the name of a violation, whether a row has it."""
        return {}

    def messages(self, df: DataFrame, got: dict) -> list[str]:
        raise NotImplementedError


def _nulls(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


@dataclass(frozen=True)
class RowCount(Check):
    min_rows: int = 1

    def messages(self, df, got):
        return [f"{got['rows']} rows, expected at least {self.min_rows}"] if got["rows"] < self.min_rows else []


@dataclass(frozen=True)
class HasColumns(Check):
    columns: tuple[str, ...]

    def messages(self, df, got):
        lacking = [c for c in self.columns if c not in df.columns]
        return [f"missing columns: {', '.join(lacking)}"] if lacking else []


@dataclass(frozen=True)
class NotNull(Check):
    columns: tuple[str, ...]

    def aggregates(self, df):
        return {f"nulls:{c}": _nulls(c) for c in self.columns if c in df.columns}

    def breaks(self, df):
        return {f"null:{c}": F.col(c).isNull() for c in self.columns if c in df.columns}

    def messages(self, df, got):
        lacking = [f"column {c} is missing" for c in self.columns if c not in df.columns]
        return lacking + [f"column {c}: {n} nulls" for c in self.columns if c in df.columns and (n := got[f"nulls:{c}"])]


@dataclass(frozen=True)
class NotAllNull(Check):
    columns: tuple[str, ...] | None = None

    def aggregates(self, df):
        return {f"held:{c}": F.count(c) for c in self.columns or df.columns}

    def messages(self, df, got):
        return [f"column {c} has only nulls" for c in self.columns or df.columns if not got[f"held:{c}"]]


@dataclass(frozen=True)
class NullRate(Check):
    default: float = 0.02
    per_column: dict[str, float] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    blocking = False

    def aggregates(self, df):
        return {f"nulls:{c}": _nulls(c) for c in df.columns if c not in self.exclude}

    def messages(self, df, got):
        out = []
        for c in df.columns:
            limit = self.per_column.get(c, self.default)
            if c not in self.exclude and limit < 1 and got["rows"] and got[f"nulls:{c}"] / got["rows"] > limit:
                out.append(f"column {c}: {got[f'nulls:{c}'] / got['rows']:.1%} nulls, limit {limit:.1%}")
        return out


@dataclass(frozen=True)
class MaxLength(Check):
    limits: dict[str, int]

    def aggregates(self, df):
        length = {c: F.length(F.col(c).cast("string")) for c in self.limits if c in df.columns}
        return {f"long:{c}": F.count_if(x > self.limits[c]) for c, x in length.items()} | {f"longest:{c}": F.max(x) for c, x in length.items()}

    def breaks(self, df):
        return {f"long:{c}": F.length(F.col(c).cast("string")) > n for c, n in self.limits.items() if c in df.columns}

    def messages(self, df, got):
        return [f"column {c}: {n} values over {limit} characters, the longest {got[f'longest:{c}']}" for c, limit in self.limits.items() if c in df.columns and (n := got[f"long:{c}"])]


@dataclass(frozen=True)
class Oversized(Check):
    threshold: int = 10_000
    blocking = False

    def aggregates(self, df):
        return {f"longest:{c}": F.max(F.length(c)) for c in _strings(df)}

    def breaks(self, df):
        return {f"oversized:{c}": F.length(c) > self.threshold for c in _strings(df)}

    def messages(self, df, got):
        return [f"column {c}: a value of {n} characters" for c in _strings(df) if (n := got[f"longest:{c}"] or 0) > self.threshold]


@dataclass(frozen=True)
class Unparseable(Check):
    """Values of a text column that are no moment."""

    column: str
    blocking = False

    def aggregates(self, df):
        return {f"unread:{self.column}": F.count_if(self._unread())}

    def breaks(self, df):
        return {f"unread:{self.column}": self._unread()}

    def _unread(self):
        return F.col(self.column).isNotNull() & F.col(self.column).cast("string").try_cast("timestamp").isNull()

    def messages(self, df, got):
        return [f"column {self.column}: {n} values are no dates"] if (n := got[f"unread:{self.column}"]) else []


@dataclass(frozen=True)
class Unique(Check):
    columns: tuple[str, ...]

    def messages(self, df, got):
        n = duplicate_rows(df, list(self.columns)).first()["n_rows"]
        return [f"{n} rows share {', '.join(self.columns)}"] if n else []


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_rows``, how many rows are in groups of equal keys (nulls are equal)."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"))


def _wanted(df: DataFrame, checks: list[Check]) -> list[Column]:
    wanted: dict[str, Column] = {"rows": F.count("*")}
    for check in checks:
        wanted |= check.aggregates(df)
    return [x.alias(n) for n, x in wanted.items()]


def measured(df: DataFrame, checks: list[Check], *by: str) -> DataFrame:
    """What the checks count, as a row (for each ``by``): ``rows`` and a column for each aggregate, by its name. One pass."""
    named = _wanted(df, checks)
    return df.groupBy(*by).agg(*named) if by else df.agg(*named)


def broken(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``df`` with ``_broken``: the names of the violations that a row has, in the order of the checks."""
    named = {n: x for check in checks for n, x in check.breaks(df).items()}
    return df.withColumn("_broken", F.array_compact(F.array(*(F.when(x, F.lit(n)) for n, x in named.items()))) if named else F.array().cast("array<string>"))


def run_checks(df: DataFrame, checks: list[Check], into: str | None = None) -> CheckReport:
    """All checks, in order; one job for those that aggregate, and one more for each ``Unique``. ``into``: a new folder for the rows that
    break a check of rows, which are written in the same pass as everything is counted."""
    violations = None
    if into is None:
        counts = measured(df, checks)
        got = dict(zip(counts.columns, counts.first(), strict=True))
    else:
        seen, rows = Observation(), broken(df, checks)
        rows.observe(seen, *_wanted(df, checks)).where(F.size("_broken") > 0).write.parquet(into)
        got = seen.get
        violations = df.sparkSession.read.schema(rows.schema).parquet(into)
    failures, warnings = [], []
    for check in checks:
        (failures if check.blocking else warnings).extend(check.messages(df, got))
    return CheckReport(tuple(failures), tuple(warnings), violations)


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name``, ``n_rows``, ``n_null``, ``null_rate`` of each column, from one pass."""
    counts = df.agg(F.count("*").alias("n"), *(_nulls(c).alias(c) for c in columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(c).alias("n_null")) for c in columns))
    out = counts.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("null_rate", F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).otherwise(0.0))


def completeness(rows: DataFrame, keys: list[str], announced: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row: ``announced``, ``collected`` (different keys), ``shortfall`` (share) and ``verdict``: ok, warn or fail."""
    got = rows.agg(F.count_distinct(*keys).alias("collected"))
    both = announced.join(got)  # a row each
    short = F.when(F.col("announced") > F.col("collected"), (F.col("announced") - F.col("collected")) / F.col("announced")).otherwise(0.0)
    return both.select("announced", "collected", short.alias("shortfall")).withColumn("verdict", F.when(F.col("shortfall") > tolerance, "fail").when(F.col("shortfall") > 0, "warn").otherwise("ok"))


def anomalies(history: DataFrame, last: int = 5, ratio: float = 0.5) -> DataFrame:
    """``history`` (``dataset``, ``tenant``, ``started_at``, ``rows_loaded``) with ``usual``, the mean of the ``last`` runs before, and whether a run
    has less than ``ratio`` of it. A window for each dataset and tenant: a row each run, never the data."""
    from pyspark.sql import Window

    before = Window.partitionBy("dataset", "tenant").orderBy("started_at").rowsBetween(-last, -1)
    usual = F.avg("rows_loaded").over(before)
    return history.withColumn("usual", usual).withColumn("anomalous", F.coalesce(F.col("rows_loaded") < ratio * F.col("usual"), F.lit(False)))


def stale_sources(registry: DataFrame, sources: DataFrame, as_of: datetime | str, hours: int = 24) -> DataFrame:
    """The ``source``s that were never loaded or not within ``hours`` before ``as_of``, and ``last_success_at``."""
    known = registry.select(F.col("dataset").alias("source"), "last_success_at")
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"interval {hours} hours")
    return sources.join(known, "source", "left").where(F.col("last_success_at").isNull() | (F.col("last_success_at").cast("timestamp") < limit))


def without_empty(df: DataFrame, unique: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Empty text in columns of unique sets as null, so that empty values don't count as equal."""
    names = {c for u in unique for c in u} & set(_strings(df))
    return df.withColumns({c: empty_to_null(F.col(c)) for c in sorted(names)}) if names else df
