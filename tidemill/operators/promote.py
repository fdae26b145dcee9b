"""From staged rows to the target: contract, dedup, strategy, kept counts, audits, in one atomic commit.

The rows that are new are shuffled once, by their keys, and written once, as files of the next version. Their keys then tell
which of the target's files hold rows that go; those files alone are rewritten, each where it is read: the target is never
shuffled while the new keys are few enough to be broadcast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.dedup import duplicate_groups, last_landed
from tidemill.operators.kept import Change, Kept, unique_set
from tidemill.operators.quality import without_empty
from tidemill.sources.snapshots import CatalogTable, File, Side, Snapshots, tenant_part


class ContractBroken(ValueError):
    """The staged columns are not those of a frozen target."""


@dataclass(frozen=True)
class PromoteResult:
    rows_loaded: int
    version: int
    warnings: tuple[str, ...] = ()


def under_contract(staged: DataFrame, target: T.StructType, contract: str) -> tuple[DataFrame, T.StructType]:
    """The staged rows and the schema that the target will have. "evolve": new columns are added; "freeze": they are refused;
    "discard": they are left out. Columns of the target that the rows lack stay, with nulls."""
    new = [f for f in staged.schema if f.name not in target.names]
    if new and contract == "freeze":
        raise ContractBroken(f"new columns: {', '.join(f.name for f in new)}")
    schema = T.StructType([*target, *new]) if contract == "evolve" else target
    return staged.select(*((F.col(f.name) if f.name in staged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema)), schema


def _as(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def upserted(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of two frames: ``target`` with ``rows``; those of known keys take their place with all columns, nulls too; others are added."""
    return target.join(rows.select(*keys), keys, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def audit_unique(df: DataFrame, unique: tuple[tuple[str, ...], ...]) -> tuple[str, ...]:
    """A warning for each unique set with duplicates, with the largest three groups. The whole frame is grouped."""
    return tuple(said for columns in unique if (said := _not_unique(columns, duplicate_groups(df, list(columns)))))


def _not_unique(columns: tuple[str, ...], largest: DataFrame) -> str:
    samples = largest.collect()  # three at most
    return f"not unique: {', '.join(columns)}; " + "; ".join(f"{tuple(r[c] for c in columns)} x{r['n_rows']}" for r in samples) if samples else ""


def side_name(columns: tuple[str, ...]) -> str:
    """The name of the counts that are kept of a unique set."""
    return "unique:" + ",".join(columns)


def audit_kept(target: Snapshots, sides: dict[str, Side], unique: tuple[tuple[str, ...], ...]) -> tuple[str, ...]:
    """As ``audit_unique``, from the counts kept beside the table. That a count is above one reaches the scan, so that parts of files
    without duplicates aren't read."""
    out = []
    for columns in unique:
        side = sides[side_name(columns)]
        twice = target.frame(side.files, side.schema).where("n > 1").withColumnRenamed("n", "n_rows")
        out.append(_not_unique(columns, twice.orderBy(F.desc("n_rows"), *columns).limit(3)))
    return tuple(said for said in out if said)


def promote(
    staged: DataFrame, target: Snapshots, keys: list[str], strategy: str, contract: str = "evolve", tenant: str = "", unique: tuple[tuple[str, ...], ...] = (), marks: dict | None = None, kept: dict[str, Kept] | None = None, ledger: DataFrame | None = None
) -> PromoteResult:
    """Staged rows (with the columns ``_seq`` and ``_pos`` of their landing, if they have them) into the target.

    An upsert rewrites the files that hold one of its keys. A replacement for a tenant puts the tenant's part in the old one's
    place; others lose only rows whose keys come again. Empty text in columns of unique sets becomes null in the rows that
    are written. ``ledger``: rows that are added to the side of that name."""
    landed = [c for c in ("_seq", "_pos") if c in staged.columns]
    columns = [c for c in staged.columns if not c.startswith("_")]
    target.create_if_missing(staged.select(*columns).schema)
    base = target.current()
    rows = last_landed(staged, keys) if keys and len(landed) == 2 and strategy != "append" else staged
    rows, schema = under_contract(rows.select(*columns), target.schema_of(base), contract)
    rows, counted = without_empty(rows, unique), Observation()
    part = tenant_part(tenant) if strategy == "replace" and tenant else None
    old: list[File] = base["files"]
    new = target.put(rows.observe(counted, F.count(F.lit(1)).alias("n")), part)
    added = target.frame(new, schema)
    removed: DataFrame | None
    if strategy == "append":
        files, removed = [*old, *new], added.limit(0)
    elif strategy == "replace" and not tenant:
        files, removed = new, None
    elif strategy in ("replace", "upsert"):
        own = [f for f in old if part is not None and f["part"] == part]
        others = [f for f in old if f not in own]
        known = target.keys_of(new, schema, keys)
        touched = target.holding(others, schema, known, keys)
        files = [*(f for f in others if f not in touched), *target.survivors(touched, schema, known, keys), *new]
        met = target.frame(touched, schema).join(known, keys, "left_semi") if touched else added.limit(0)
        removed = met.select(*schema.names).unionByName(target.frame(own, schema)) if own else met.select(*schema.names)
    else:
        raise ValueError(f"unknown load strategy {strategy}")
    change = Change(added, removed, lambda: target.frame(files, schema))
    sides: dict[str, Side] = {}
    for name, state in {**{side_name(u): unique_set(u) for u in unique}, **(kept or {})}.items():
        sides |= state.updated(target, base, name, change)
    if ledger is not None:
        before = target.side_of(base, "ledger")
        sides["ledger"] = Side([*(before.files if before else []), *target.put(ledger)], ledger.schema)
    version = target.publish(base, files, schema, sides, marks)
    return PromoteResult(int(counted.get["n"]), version, audit_kept(target, sides, unique))


def promote_to_catalog(staged: DataFrame, table: CatalogTable, keys: list[str], strategy: str, tenant_column: str | None = None, tenant: str = "") -> None:
    """The same strategies by a catalog table's own merge, append and overwrite; dedup first, as a merge takes one row a key."""
    columns = [c for c in staged.columns if not c.startswith("_")]
    landed = keys and {"_seq", "_pos"} <= set(staged.columns) and strategy != "append"
    rows = (last_landed(staged, keys) if landed else staged).select(*columns)
    if strategy == "upsert":
        table.upsert(rows, keys)
    elif strategy == "append":
        table.append(rows)
    elif strategy == "replace":
        table.replace(rows, tenant_column, tenant)
    else:
        raise ValueError(f"unknown load strategy {strategy}")
