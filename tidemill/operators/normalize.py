"""From records to rows: fields by path, keys from the page, sub-objects and lists as text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.coerce import array_json, array_text, date_prefix, repack, to_bool, to_double, to_timestamp
from tidemill.sources.pages import at
from tidemill.spec import TYPES, Field

#: What is at a dotted path of a record, as a variant; null where it is missing.
Look = Callable[[str], Column]


def is_null(here: Column) -> Column:
    """Whether a path holds null. ``here``: what ``at`` gives there."""
    return F.coalesce(F.is_variant_null(here), F.lit(False))


def opened(records: DataFrame, paths: set[str], column: str = "record") -> tuple[DataFrame, Look]:
    """``records`` with a column for each object on the way to ``paths``, and how to look paths up in these; it gives the same as ``at``. So an object
    is gone through once for all keys that are asked of it, and not once for each path and question."""
    ways: dict[str, list[str]] = {}
    for path in sorted({p for path in paths if path for p in (*_ways(path), path)}):
        above, _, key = path.rpartition(".")
        if key.lower() not in (k.lower() for k in ways.setdefault(above, [])):  # Spark tells a struct's fields by name without case
            ways[above].append(key)
    held = {way: f"_open{i}" for i, way in enumerate(ways)}

    def look(path: str) -> Column:
        above, _, key = path.rpartition(".")
        return F.col(held[above])[key] if key in ways.get(above, ()) else at(F.col(column), path)

    for way in sorted(ways, key=_depth):
        kind = f"struct<{', '.join(f'`{k}`: variant' for k in ways[way])}>"
        records = records.withColumn(held[way], at(look(way) if way else F.col(column), "", kind))
    return records, look


def _ways(path: str) -> list[str]:
    """The objects on the way to a path, without the record itself."""
    steps = path.split(".")
    return [".".join(steps[:k]) for k in range(1, len(steps))]


def _depth(way: str) -> int:
    return way.count(".") + 1 if way else 0


def paths_of(field: Field) -> set[str]:
    """The paths at which a field is looked for."""
    own = [field.source, *field.fallback]
    return {f"{p}.{k}" if p else k for p in own for k in field.only} if field.only else set(own)


def value_at(look: Look, field: Field) -> Column:
    """A field's value, before it is cast: JSON strings are text, numbers and truth values their JSON form."""

    def get(path: str) -> Column:
        if field.form == "joined":
            return array_text(at(look(path), "", "array<string>"))
        if field.form == "json":
            if field.only:
                return repack(**{k: look(f"{path}.{k}" if path else k) for k in field.only})
            return array_json(at(look(path), "", "array<string>"))
        # A list or object as a scalar field is its JSON text.
        return F.coalesce(at(look(path), "", "string"), F.when(~F.is_variant_null(look(path)), F.to_json(look(path))))

    value = F.coalesce(*(get(p) for p in (field.source, *field.fallback)))
    if field.on_null_parent is not None and "." in field.source:
        empty = F.lit(False)
        for parent in _ways(field.source):
            empty = empty | is_null(look(parent))
        value = F.when(empty, field.on_null_parent).otherwise(value)
    return value


def cast(value: Column, kind: str) -> Column:
    if kind == "boolean":
        return to_bool(value)
    if kind == "timestamptz":
        return to_timestamp(value)
    if kind == "double":
        return to_double(value)
    return value if kind in ("text", "json", "uuid") else value.try_cast(TYPES[kind])


def key_at(entity_key: Column, field: Field) -> Column:
    """A field from the page's entity key: one part of an object key, or a plain key as a whole."""
    key = F.try_parse_json(entity_key)
    return at(key, "" if field.key == "*" else field.key, "string")


def normalize(records: DataFrame, fields: tuple[Field, ...], keep: tuple[str, ...] = ("tenant", "fetched_at", "page", "seq", "pos"), watch: str | None = None) -> DataFrame:
    """``fields`` of each record, typed, and the columns ``keep`` of its page. Fields that aren't declared are dropped. Besides,
    ``_absent``: the names of the fields that the record lacks altogether; and, of the field ``watch``, ``_unread``: whether it
    holds what can't be read as its type."""
    records, look = opened(records, {p for f in fields if not f.key for p in paths_of(f)})
    raw = {f.name: key_at(F.col("entity_key"), f) if f.key else value_at(look, f) for f in fields}
    made = [cast(raw[f.name], f.type).alias(f.name) for f in fields]
    watched = [f for f in fields if f.name == watch]
    unread = F.coalesce(raw[watch], F.lit("")) != "" if watched else F.lit(False)
    if watched:
        unread = unread & cast(raw[watch], watched[0].type).isNull()
    absent = absent_names(look, asked(fields))
    return records.select(*made, *(F.col(c).alias(f"_{c}") for c in keep), absent.alias("_absent"), unread.alias("_unread"))


def ingest_time(df: DataFrame, column: str, run_time) -> DataFrame:
    """A constant moment: the run's, so that a retry writes the same."""
    return df.withColumn(column, F.lit(run_time).cast("timestamp"))


def asked(fields: tuple[Field, ...]) -> list[Field]:
    """The fields whose paths every record must have."""
    return [f for f in fields if not (f.optional or f.key or f.fallback or f.only)]


def is_absent(look: Look, path: str) -> Column:
    """Whether a path is missing. It is there, with a null, if an object on the way is null; it is missing where a key is absent or
    what should hold it is no object."""
    steps = path.split(".")
    out = F.lit(False)
    for k in reversed(range(len(steps))):
        here = look(".".join(steps[: k + 1]))
        out = F.when(here.isNull(), True).when(F.is_variant_null(here), False).otherwise(out)
    return out


def absent_names(look: Look, fields: list[Field]) -> Column:
    """The names of the fields that a record lacks. They are listed only where there are some."""
    lacks = {f.name: is_absent(look, f.source) for f in fields}
    none = F.array().cast("array<string>")
    if not lacks:
        return none
    return F.when(reduce(or_, lacks.values()), F.array_compact(F.array(*(F.when(x, F.lit(n)) for n, x in lacks.items())))).otherwise(none)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the declared columns and those of its landing; all that are missing are named at once. Only the schema is looked at."""
    if lacking := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    return df.select(*columns, *(c for c in df.columns if c.startswith("_")))


__all__ = ["absent_names", "asked", "cast", "date_prefix", "ingest_time", "is_absent", "normalize", "opened", "require_columns", "value_at"]
