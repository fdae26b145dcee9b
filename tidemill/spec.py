"""What is declared about a dataset: its columns and where they come from, its key, how it is loaded and what it must satisfy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

#: Declared types, as Spark has them. Identifiers and JSON are kept as text.
TYPES = {
    "text": T.StringType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "numeric": T.DecimalType(38, 18),
    "json": T.StringType(),
    "uuid": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    """A column. ``path``: where its value is in a record (default: its name); ``on_null_parent``: what it is if the object that
    holds it is null; ``fallback``: paths tried in turn while the value is null; ``form``: "scalar", "joined" (a list as text
    with commas), "json" (a list or object as JSON text, empty: null); ``key``: it comes from the page's entity key instead."""

    name: str
    type: str = "text"
    path: str | None = None
    nullable: bool = True
    on_null_parent: str | None = None
    fallback: tuple[str, ...] = ()
    form: str = "scalar"
    key: str | None = None
    optional: bool = False
    sensitive: bool = False
    only: tuple[str, ...] = ()

    def __post_init__(self):
        if self.type not in TYPES:
            raise ValueError(f"column {self.name}: unknown type {self.type}")

    @property
    def source(self) -> str:
        return self.path or self.name


@dataclass(frozen=True)
class Context:
    """What a run is told. ``as_of`` stands for the present, so that results can be made again."""

    run_id: str
    mode: str
    as_of: datetime
    tenant: str = ""
    start: datetime | None = None
    end: datetime | None = None


@dataclass(frozen=True)
class Dataset:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...]
    records: str | None = ""  # path of the records in a body; "": the body is the list; None: the body is the record
    load: str = "upsert"
    mode: str = "full"
    incremental: str | None = None
    parent: str | None = None
    parent_key: dict[str, str] = field(default_factory=dict)  # part of a page's entity key ("*": the whole): column of the parent's rows
    parent_rows: Callable[[DataFrame], DataFrame] | None = None  # which rows of the parent have pages, and their key's columns
    by_tenant: str | None = None  # column of the parent's rows that begins with the tenant's name and a slash
    unique: tuple[tuple[str, ...], ...] = ()
    null_limit: float = 0.02
    null_limits: dict[str, float] = field(default_factory=dict)
    max_lengths: dict[str, int] = field(default_factory=dict)
    min_rows: int = 1
    guarded: bool = False  # error envelopes among the pages fail the run
    announced: str | None = None  # where a page says how many there are in all; a larger shortfall fails the run
    required: tuple[str, ...] = ()  # what ``parse`` names in its column ``_absent``
    noted: dict[str, Callable[[DataFrame], Column]] = field(default_factory=dict)  # before ``transform``: rows to be counted in a warning
    contract: str = "evolve"
    lookback_days: int | None = None
    where: Callable[[DataFrame], DataFrame] | None = None  # on records, before columns are made
    parse: Callable[[DataFrame], DataFrame] | None = None  # pages to rows, in place of the field map
    transform: Callable[[DataFrame, Context], DataFrame] | None = None
    checks: tuple = ()
    apart: bool = True  # whether rows of one entity's pages can be made apart from each other
    kept: dict[str, object] = field(default_factory=dict)  # counts and first moments kept beside the table, see ``operators/kept.py``
    sources: tuple[str, ...] = ()  # of a dataset made from others; "table:side" is what is kept beside a table
    build: Callable[[SparkSession, Context, dict[str, DataFrame]], DataFrame] | None = None
    sql: str | None = None  # in place of ``build``: text over the sources as {name}, with the run's present as :as_of

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if twice := sorted({n for n in names if names.count(n) > 1}):
            raise ValueError(f"{self.name}: columns declared twice: {', '.join(twice)}")
        if missing := [k for k in self.primary_key if k not in names]:
            raise ValueError(f"{self.name}: no such key columns: {', '.join(missing)}")
        if self.load not in ("replace", "upsert", "append"):
            raise ValueError(f"{self.name}: unknown load strategy {self.load}")

    @property
    def made(self) -> bool:
        """Whether it is made from other tables."""
        return self.build is not None or self.sql is not None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, TYPES[f.type], f.nullable, {"sensitive": f.sensitive}) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]
