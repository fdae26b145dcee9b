"""A run of a dataset from landed pages, or from other tables, to its target. A stream's batches take the same steps."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.history import LEDGER, Ops
from tidemill.operators.incremental import coverage_update, date_window, entity_keys, in_window, of_parents, remaining, tenant_prefix, watermarks
from tidemill.operators.normalize import asked, key_at, normalize, require_columns
from tidemill.operators.promote import promote
from tidemill.operators.quality import Check, CheckReport, MaxLength, NotNull, NullRate, Oversized, RowCount, Unique, completeness, run_checks, stale_sources
from tidemill.operators.tokens import Vault, tokenize, tokenize_with
from tidemill.sources.pages import UNIT, PageWatch, explode_records, read_pages
from tidemill.sources.snapshots import Snapshots, stage, staging_path
from tidemill.spec import Context, Dataset, Field

#: The ledger's pages of the days in question are broadcast up to so many.
BROADCAST_PAGES = 1_000_000


class CheckFailed(ValueError):
    """Staged rows didn't pass; nothing was promoted."""


@dataclass(frozen=True)
class Warehouse:
    """Where things are: landed pages, target tables, staging and the ops tables. ``vault``: who gives tokens, in place of keyed hashes; it is
    asked once for each value, and a token map keeps its answers. ``keep_violations``: whether rows that break a check are written."""

    spark: SparkSession
    root: str
    token_key: str = ""
    vault: Vault | None = None
    keep_violations: bool = True

    @property
    def pages(self) -> str:
        return f"{self.root}/pages"

    def table(self, name: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/tables/{name}")

    def frame(self, name: str) -> DataFrame:
        """A table, or "table:side" for what is kept beside it."""
        table, _, side = name.partition(":")
        if not side:
            return self.table(table).read()
        held = self.table(table).read_side(side)
        if held is None:
            raise CheckFailed(f"nothing is kept as {side} beside {table}")
        return held

    @property
    def tokens(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/tokens")

    def violations(self, dataset: str, run_id: str) -> str | None:
        return f"{staging_path(f'{self.root}/violations', dataset, run_id)}" if self.keep_violations else None

    def staging(self, dataset: str, run_id: str) -> Snapshots:
        return Snapshots(self.spark, staging_path(f"{self.root}/staging", dataset, run_id))

    @property
    def ops(self) -> Ops:
        return Ops(self.spark, f"{self.root}/ops")

    def register(self, datasets: Iterable[Dataset], at: datetime) -> None:
        self.ops.register(datasets, at)


@dataclass(frozen=True)
class RunResult:
    run_id: str
    rows_loaded: int
    warnings: tuple[str, ...]
    promoted: bool
    violations: DataFrame | None = None


def unit_of() -> Column:
    """What the ledgers call a page."""
    return F.struct("tenant", *UNIT).cast("string")


def rows_of(dataset: Dataset, pages: DataFrame, context: Context, late: Observation | None = None) -> DataFrame:
    """A dataset's typed rows from its pages, in the run's window. ``_seq`` and ``_pos`` tell the landing, ``_absent`` the keys that a
    record lacks and ``_unread`` whether its incremental column can't be read. ``late`` counts the rows that the window ends before."""
    if dataset.parse is not None:
        rows = dataset.parse(pages)
    else:
        records = explode_records(pages, dataset.records)
        if dataset.where is not None:
            records = dataset.where(records)
        rows = normalize(records, dataset.fields, watch=dataset.incremental)
    if late is not None:
        beyond = F.col(dataset.incremental).cast("string").try_cast("timestamp") > F.lit(context.end) if dataset.incremental and context.end is not None else F.lit(False)
        rows = rows.observe(late, F.count_if(beyond).alias("n"))
    if dataset.incremental and context.mode in ("forward", "backfill"):
        # Rows that will fail the run, or be counted, must not go before they are seen.
        odd = [c for n, c in (("_absent", F.size("_absent") > 0), ("_unread", F.col("_unread"))) if n in rows.columns]
        besides = F.greatest(*odd, F.lit(False)) if odd else None
        rows = in_window(rows, dataset.incremental, context.start, context.end, context.as_of, dataset.lookback_days, besides)
    return rows


def parent_keys(dataset: Dataset, parents: DataFrame, context: Context, max_entities: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The keys of the pages that the rows of the parent table call for, each part in a column of its name; and the parent's rows
    (of the run's tenant) that they come from."""
    rows = parents.where(tenant_prefix(dataset.by_tenant, context.tenant)) if dataset.by_tenant else parents
    usable = dataset.parent_rows(rows) if dataset.parent_rows is not None else rows
    named = usable.select(*(F.col(column).cast("string").alias(part) for part, column in dataset.parent_key.items()))
    return entity_keys(named, [*dataset.parent_key], limit=max_entities), rows


def pages_of_parents(dataset: Dataset, pages: DataFrame, keys: DataFrame) -> DataFrame:
    """The pages whose entity key a parent has. Keys are a few numbers each; Spark broadcasts them or not by their size."""
    parts = {part: f"_key{i}" for i, part in enumerate(dataset.parent_key)}
    named = pages.withColumns({name: key_at(F.col("entity_key"), Field(name, key=part)) for part, name in parts.items()})
    return of_parents(named, keys.toDF(*parts.values()), [*parts.values()]).select(*pages.columns)


def gate(dataset: Dataset) -> list[Check]:
    """The checks that a dataset's rows must pass, and those that only warn, in order."""
    key = dataset.primary_key
    needed = tuple(f.name for f in dataset.fields if not f.nullable)
    lengths = (MaxLength(dataset.max_lengths),) if dataset.max_lengths else ()
    return [RowCount(dataset.min_rows), NotNull(tuple(dict.fromkeys((*key, *needed)))), *lengths, *dataset.checks, NullRate(dataset.null_limit, dataset.null_limits, tuple(key)), Oversized()]


class Watched:
    """What is counted while rows are staged, in the same pass: absent keys, unread dates, rows that a dataset wants noted."""

    def __init__(self, dataset: Dataset, rows: DataFrame):
        self.dataset, self.seen = dataset, Observation()
        self.names = [f.name for f in asked(dataset.fields)] if dataset.parse is None else list(dataset.required)
        self.noted = {n: F.coalesce(make(rows), F.lit(False)) for n, make in dataset.noted.items()}
        self.before = rows
        lacks = {n: F.array_contains("_absent", n) for n in self.names} if "_absent" in rows.columns else {}
        sums: list[Column] = [F.count(F.lit(1)).alias("rows")]
        sums += [x for i, c in enumerate(lacks.values()) for x in (F.count_if(c).alias(f"n{i}"), F.min(F.when(c, F.col("_seq"))).alias(f"s{i}"))]
        sums += [F.count_if(c).alias(f"note{i}") for i, c in enumerate(self.noted.values())]
        sums += [F.count_if("_unread").alias("unread")] if "_unread" in rows.columns else []
        self.rows = rows.observe(self.seen, *sums).drop("_absent", "_unread")

    def refuse_absent(self) -> None:
        got, paths = self.seen.get, {f.name: f.source for f in self.dataset.fields}
        lacking = [(n, got[f"n{i}"], got[f"s{i}"]) for i, n in enumerate(self.names) if got.get(f"n{i}")]
        if lacking:
            raise CheckFailed("keys missing in records: " + "; ".join(f"{n} ({paths.get(n, n)}) in {many}, first at {seq}" for n, many, seq in lacking))

    def warnings(self) -> tuple[str, ...]:
        got, out = self.seen.get, []
        for i, (name, condition) in enumerate(self.noted.items()):
            if n := got.get(f"note{i}"):
                keys = [k for k in self.dataset.primary_key if k in self.before.columns]
                samples = self.before.where(condition).select(*keys).limit(3).collect()  # only where there are some, and three at most
                out.append(f"{n} rows: {name}; such as " + ", ".join(str(tuple(r)) for r in samples))
        if n := got.get("unread"):
            out.append(f"column {self.dataset.incremental}: {n} values are no dates")
        return tuple(out)


def staged_rows(warehouse: Warehouse, dataset: Dataset, rows: DataFrame, context: Context, folder: str) -> tuple[DataFrame, Watched]:
    """Rows noted, transformed, with sensitive columns as tokens, written to a staging folder and read back. No value of
    a sensitive column is written anywhere."""
    watched = Watched(dataset, rows)
    rows = dataset.transform(watched.rows, context) if dataset.transform is not None else watched.rows
    sensitive = [f.name for f in dataset.fields if f.sensitive]
    if sensitive and warehouse.vault is not None:
        rows = tokenize_with(rows, sensitive, warehouse.vault, warehouse.token_key, warehouse.tokens)
    elif sensitive:
        rows = tokenize(rows, sensitive, warehouse.token_key)
    staged = stage(require_columns(rows, dataset.columns), folder)
    watched.refuse_absent()
    return staged, watched


def judged(dataset: Dataset, staged: DataFrame, into: str | None = None) -> CheckReport:
    """Raises what fails the run; else the report. ``into``: where rows that break a check of rows are written."""
    declared = staged.select(*dataset.columns)
    report = run_checks(declared, gate(dataset), into)
    if not dataset.made and dataset.load == "append":
        report = CheckReport((*report.failures, *run_checks(declared, [Unique(dataset.primary_key)]).failures), report.warnings, report.violations)
    if not report.passed:
        raise CheckFailed("; ".join(report.failures))
    return report


def complete_enough(dataset: Dataset, staged: DataFrame, announced: int | None) -> tuple[str, ...]:
    """Raises if much fewer keys came than the pages announce; a small shortfall is a warning."""
    if announced is None:
        return ()
    row = completeness(staged, list(dataset.primary_key), staged.sparkSession.createDataFrame([(announced,)], "announced bigint")).first()
    if row["verdict"] == "ok":
        return ()
    said = f"{row['collected']} of {row['announced']} announced rows came ({row['shortfall']:.1%} short)"
    if row["verdict"] == "fail":
        raise CheckFailed(said)
    return (said,)


@dataclass(frozen=True)
class Taken:
    """What a commit says of pages: those that the ledger didn't have, and marks by name."""

    ledger: DataFrame | None = None
    marks: dict | None = None


def finish(warehouse: Warehouse, dataset: Dataset, staged: DataFrame, context: Context, strategy: str, tenants: str | None, taken: Taken = Taken()):
    """Promotion, then watermarks (``tenants``: the column of the tenant, or none: the run's) and last success."""
    ops, target = warehouse.ops, warehouse.table(dataset.name)
    done = promote(staged, target, list(dataset.primary_key), strategy, dataset.contract, context.tenant, dataset.unique, taken.marks, dataset.kept, taken.ledger)
    if dataset.incremental and context.mode != "transform":
        tenant = F.col(tenants) if tenants else F.lit(context.tenant)
        marks = watermarks(staged.select(F.lit(dataset.name).alias("dataset"), tenant.alias("tenant"), dataset.incremental), dataset.incremental, "dataset", "tenant")
        ops.cover(coverage_update(marks, context.mode))
    ops.succeeded(dataset.name, context.as_of)
    target.tend()
    return done


def run_dataset(
    warehouse: Warehouse, dataset: Dataset, mode: str | None = None, tenant: str = "", as_of: datetime | None = None, start: datetime | None = None, end: datetime | None = None, dry_run: bool = False, max_pages: int | None = None,
    max_entities: int | None = None, slices: int = 1, resume: bool = False,
) -> RunResult:
    """Window, rows, staging, checks, promotion, watermarks, history. Staged rows are written once; checks and promotion read
    them. What fails is recorded, its staging dropped, and the target stays as it was.

    A forward run takes the pages that the dataset's ledger doesn't have, and looks for them from the day on from which
    some may be new; without any it ends at once. ``slices``: pages are staged in so many jobs by hash of the page, or of its
    entity key where rows of an entity are made together, each noted in a ledger of the staging. ``resume``: the last run of
    this dataset, tenant and mode that crashed, if there is one, is carried on: its staged slices stay and only pages that
    that ledger doesn't have are taken; what came twice goes when rows are made one for each key."""
    ops = warehouse.ops
    mode, as_of, began = mode or dataset.mode, as_of or datetime.now(UTC).replace(tzinfo=None), time.monotonic()
    shown = "transform" if dataset.made else mode
    crashed = ops.crashed(dataset.name, tenant, mode) if resume else None
    run_id = crashed or uuid.uuid4().hex
    low, high = date_window(shown, ops.marks(dataset.name, tenant), as_of, start, end)
    context = Context(run_id, mode, as_of, tenant, low, high)
    ops.register([dataset], as_of)
    begun = None if crashed else ops.record(run_id, dataset.name, tenant, mode, "running", as_of)
    staging = warehouse.staging(dataset.name, run_id)

    def ended(rows: int, warnings: tuple[str, ...], metadata: dict) -> None:
        ops.record(run_id, dataset.name, tenant, mode, "success", as_of, rows, time.monotonic() - began, "; ".join(warnings) or None, json.dumps(metadata), begun)
        staging.drop()

    try:
        warnings: tuple[str, ...] = ()
        taken = Taken()
        if dataset.made:
            warnings, staged = _made(warehouse, dataset, context, staging.path)
        else:
            source = _Source(warehouse, dataset, context, max_pages, max_entities, explicit=start is not None or end is not None)
            if source.nothing_new():
                ended(0, (), {"no_pages": True})
                return RunResult(run_id, 0, (), True)
            staged, warnings = source.staged(staging.path, slices)
        report = judged(dataset, staged, warehouse.violations(dataset.name, run_id))
        warnings += report.warnings
        if not dataset.made:
            taken = source.taken()
            count = staged.count()
            odd = ops.usual(run_id, dataset.name, tenant, count, as_of).where("anomalous").first()
            warnings += (f"{count} rows, where the last runs had {odd['usual']:.0f} on average",) if odd else ()
        if dry_run:
            ended(0, warnings, {"dry_run": True})
            return RunResult(run_id, 0, warnings, False, report.violations)
        done = finish(warehouse, dataset, staged, context, dataset.load, None, taken)
        warnings = (*warnings, *done.warnings)
        ended(done.rows_loaded, warnings, {"version": done.version})
        return RunResult(run_id, done.rows_loaded, warnings, True, report.violations)
    except Exception as error:
        ops.record(run_id, dataset.name, tenant, mode, "failed", as_of, None, time.monotonic() - began, None, str(error)[:2000], begun)
        staging.drop()
        raise


def _made(warehouse: Warehouse, dataset: Dataset, context: Context, folder: str) -> tuple[tuple[str, ...], DataFrame]:
    """Warnings of stale sources, and the staged rows of a dataset that is made from others by a function or by SQL text."""
    spark = warehouse.spark
    tables = sorted({s.partition(":")[0] for s in dataset.sources})
    sources = spark.createDataFrame([(s,) for s in tables], "source string")
    stale = stale_sources(warehouse.ops.known(), sources, context.as_of).orderBy("source").collect()  # a row for each source at most
    warnings = tuple(f"source {r['source']} " + (f"was last loaded at {r['last_success_at']}" if r["last_success_at"] else "has never been loaded") for r in stale)
    rows = made_rows(spark, dataset, context, {s: warehouse.frame(s) for s in dataset.sources})
    return warnings, staged_rows(warehouse, dataset, rows, context, folder + "/rows")[0]


def made_rows(spark: SparkSession, dataset: Dataset, context: Context, tables: dict[str, DataFrame]) -> DataFrame:
    """A dataset's rows from its sources. SQL text names them in braces, a side as ``{table_side}``, and has the run's present as ``:as_of``."""
    if dataset.sql is None:
        return dataset.build(spark, context, tables)
    return spark.sql(dataset.sql, args={"as_of": context.as_of}, **{name.replace(":", "_"): frame for name, frame in tables.items()})


class _Source:
    """The landed pages that a run takes. Files are listed once, so that all steps speak of the same pages, whatever lands meanwhile."""

    def __init__(self, warehouse: Warehouse, dataset: Dataset, context: Context, max_pages: int | None, max_entities: int | None, explicit: bool):
        self.warehouse, self.dataset, self.context, self.limits = warehouse, dataset, context, (max_pages, max_entities)
        self.now = warehouse.table(dataset.name).current()
        self.forward = context.mode == "forward" and not explicit and self.now is not None
        #: Whether what this run takes is taken for good.
        self.whole = context.mode in ("full", "forward") and not explicit and dataset.incremental is not None
        since = self.now["marks"].get(self.mark) if self.forward else None
        self.since = date.fromisoformat(since) if since else None
        self.listed = read_pages(warehouse.spark, warehouse.pages, dataset.name, context.tenant or None, None, self.since)
        pages = self.listed if max_pages is None else self.listed.where(F.col("page") <= max_pages)
        self.pages = not_in_ledger(warehouse.table(dataset.name), self.now, pages, self.since) if self.forward else pages
        self.warnings: tuple[str, ...] = ()
        self.late: list[Observation] = []
        self.of_parents = self.pages
        if dataset.parent:
            self._keep_those_of_parents(max_entities)

    @property
    def mark(self) -> str:
        return f"since:{self.context.tenant}"

    def _keep_those_of_parents(self, max_entities: int | None) -> None:
        warehouse, dataset = self.warehouse, self.dataset
        parent = loaded_parent(warehouse, dataset)
        keys, rows = parent_keys(dataset, parent, self.context, max_entities)
        self.of_parents = pages_of_parents(dataset, self.pages, keys)
        if dataset.parent_rows is not None and (lost := rows.count() - dataset.parent_rows(rows).count()):
            self.warnings += (f"{lost} rows of {dataset.parent} name no entity",)

    def nothing_new(self) -> bool:
        return self.forward and self.of_parents.select("seq").isEmpty()

    def staged(self, folder: str, slices: int) -> tuple[DataFrame, tuple[str, ...]]:
        """The rows of the pages, staged slice by slice, and warnings. Each body is parsed once: guards and totals are counted along."""
        dataset, context, spark = self.dataset, self.context, self.warehouse.spark
        warnings, totals, corrupt = self.warnings, [], 0
        ledger = Snapshots(spark, f"{folder}/ledger")
        ledger.create_if_missing(spark.createDataFrame([], LEDGER).schema)
        pages = self.of_parents
        left = remaining(pages.withColumn("unit", unit_of()), ledger.read(), ["unit"])
        for k in range(slices):
            some = left if slices == 1 else left.where(F.pmod(F.xxhash64("unit" if dataset.apart else "entity_key"), F.lit(slices)) == k)
            watch, late = PageWatch(some.drop("unit"), dataset.announced), Observation()
            staged, watched = staged_rows(self.warehouse, dataset, rows_of(dataset, watch.pages, context, late), context, f"{folder}/rows")
            if dataset.guarded:
                watch.refuse_envelopes()
            totals, corrupt, self.late = [*totals, watch.announced], corrupt + watch.corrupt, [*self.late, late]
            warnings += watched.warnings()
            ledger.commit(some.select(F.lit(context.run_id).alias("run_id"), "unit"), append=True)
        if corrupt:
            warnings += (f"{corrupt} bodies are not JSON",)
        if dataset.announced and self.limits == (None, None) and not self.forward:
            warnings += complete_enough(dataset, staged, max((t for t in totals if t is not None), default=None))
        return staged, warnings

    def taken(self) -> Taken:
        """The ledger's new rows, and the day from which on pages may be new: the last one that has any, or the first with pages that weren't
        taken, for want of a parent or by a limit. Rows beyond the window's end leave all pages for a later run."""
        if not self.whole or any(x.get["n"] for x in self.late):
            return Taken()
        name = unit_of().alias("unit")
        new = self.of_parents.select("day", name).distinct()
        if not self.forward and self.now is not None:
            new = not_in_ledger(self.warehouse.table(self.dataset.name), self.now, self.of_parents, None).select("day", name).distinct()
        latest = self.listed.agg(F.max("day").alias("day")).first()["day"]
        if self.dataset.parent or self.limits != (None, None):
            open_ones = remaining(self.listed.select("day", name), self.of_parents.select(name), ["unit"])
            if self.now is not None and (held := self.warehouse.table(self.dataset.name).read_side("ledger", self.now)) is not None:
                open_ones = remaining(open_ones, held, ["unit"])
            first = open_ones.agg(F.min("day").alias("day")).first()["day"]
            latest = min((d for d in (latest, first) if d is not None), default=None)
        return Taken(new, {self.mark: latest.isoformat()} if latest else None)


def loaded_parent(warehouse: Warehouse, dataset: Dataset) -> DataFrame:
    if not warehouse.table(dataset.parent).exists():
        raise CheckFailed(f"the parent {dataset.parent} was never loaded")
    return warehouse.table(dataset.parent).read()


def not_in_ledger(target: Snapshots, now: dict | None, pages: DataFrame, since: date | None) -> DataFrame:
    """The pages that the target's ledger doesn't have. Of the ledger only the days in question are read; its rows are broadcast up to a
    bound, so that no body is shuffled, and joined with a shuffle beyond."""
    held = target.read_side("ledger", now)
    if held is None:
        return pages
    known = (held if since is None else held.where(F.col("day").isNull() | (F.col("day") >= F.lit(since)))).select("unit")
    known = F.broadcast(known) if known.limit(BROADCAST_PAGES + 1).count() <= BROADCAST_PAGES else known
    return pages.withColumn("unit", unit_of()).join(known, "unit", "left_anti").select(*pages.columns)
