"""What ran: run history, the registry of datasets, and coverage, as small tables next to the data."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.coerce import empty_to_null
from tidemill.operators.incremental import merge_coverage
from tidemill.operators.promote import upserted
from tidemill.operators.quality import anomalies
from tidemill.sources.snapshots import File, Snapshots
from tidemill.spec import Dataset

HISTORY = "run_id string, dataset string, tenant string, mode string, status string, at timestamp, rows_loaded bigint, seconds double, warnings string, metadata string"
REGISTRY = "dataset string, load_strategy string, target string, source string, registered_at timestamp, last_success_at timestamp"
LEDGER = "run_id string, unit string"
COVERAGE = "dataset string, tenant string, forward_watermark timestamp, backward_watermark timestamp"


def latest_runs(history: DataFrame) -> DataFrame:
    """The last event of each run: history is only added to."""
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("at"), F.expr("CASE status WHEN 'running' THEN 1 ELSE 0 END")))
    return history.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_success(history: DataFrame) -> DataFrame:
    """``dataset`` and ``last_success_at``."""
    return history.where("status = 'success'").groupBy("dataset").agg(F.max("at").alias("last_success_at"))


def registered(old: DataFrame, datasets: DataFrame) -> DataFrame:
    """Registry rows with those of ``datasets`` (``dataset``, ``load_strategy``, ``target``, ``source``, ``registered_at``), upserted; empty text is
    null, and what was registered and succeeded before keeps its dates."""
    known = old.select("dataset", F.col("registered_at").alias("_since"), F.col("last_success_at").alias("_last"))
    rows = datasets.join(known, "dataset", "left").select(
        "dataset", *(empty_to_null(F.col(c)).alias(c) for c in ("load_strategy", "target", "source")), F.coalesce("_since", "registered_at").alias("registered_at"), F.col("_last").alias("last_success_at")
    )
    return upserted(old, rows, ["dataset"])


def with_success(registry: DataFrame, successes: DataFrame) -> DataFrame:
    """The registry with the last success of the ``dataset``s of ``successes`` moved on to ``at``, never back."""
    new = successes.groupBy("dataset").agg(F.max("at").alias("_at"))
    return registry.join(new, "dataset", "left").withColumn("last_success_at", F.greatest("last_success_at", "_at")).select(*registry.columns)


class Ops:
    """The tables of what ran, under a folder: one row a run, a dataset, and a dataset and tenant. They are small; each write merges what has piled
    up and removes versions beyond the last few that are older than an hour."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.history, self.registry, self.coverage = (Snapshots(spark, f"{root}/{name}") for name in ("run_history", "dataset_registry", "coverage"))

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def _tended(self, table: Snapshots) -> None:
        table.compact()
        table.vacuum(keep=5, older_than_hours=1)

    def _changed(self, table: Snapshots, schema: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """A small table rewritten; where another run was faster, from what that run left."""
        table.create_if_missing(self._frame([], schema).schema)
        table.changed(lambda now: (table.put(change(table.read(now)).coalesce(1)), table.schema_of(now)))
        self._tended(table)

    def record(
        self, run_id: str, dataset: str, tenant: str, mode: str, status: str, at: datetime, rows: int | None = None, seconds: float | None = None, warnings: str | None = None, metadata: str | None = None, before: list[File] | None = None
    ) -> list[File]:
        """The run's row, in place of what was recorded of it before: only a run that crashed stays as running. ``before``: the files that this
        method gave when the run began, if that is known; else they are looked for."""
        row = self._frame([(run_id, dataset, tenant, mode, status, at, rows, seconds, warnings, metadata)], HISTORY).coalesce(1)
        if status == "running" or before is not None:
            new, gone = self.history.put(row), before or []
            self.history.changed(lambda now: ([*(f for f in (now["files"] if now else []) if f not in gone), *new], row.schema))
        else:
            new = []
            self.history.upsert(row, ["run_id"])
        if status != "running":
            self._tended(self.history)
        return new

    def register(self, datasets: Iterable[Dataset], at: datetime) -> None:
        """Datasets that are new, or loaded otherwise than known, in the registry."""
        wanted = {d.name: (d.load, d.name, None if d.made else d.name.split("_")[0]) for d in datasets}
        known = {r["dataset"]: (r["load_strategy"], r["target"], r["source"]) for r in self.known().where(F.col("dataset").isin(*wanted)).collect()}
        if rows := [(n, *x, at) for n, x in wanted.items() if known.get(n) != x]:
            new = self._frame(rows, "dataset string, load_strategy string, target string, source string, registered_at timestamp")
            self._changed(self.registry, REGISTRY, lambda old: registered(old, new))

    def succeeded(self, dataset: str, at: datetime) -> None:
        done = self._frame([(dataset, at)], "dataset string, at timestamp")
        self._changed(self.registry, REGISTRY, lambda old: with_success(old, done))

    def known(self) -> DataFrame:
        return self.registry.read_or_empty(self._frame([], REGISTRY).schema)

    def marks(self, dataset: str, tenant: str) -> dict | None:
        row = self.coverage.read_or_empty(self._frame([], COVERAGE).schema).where((F.col("dataset") == dataset) & (F.col("tenant") == tenant)).first()
        return row.asDict() if row else None

    def cover(self, update: DataFrame) -> None:
        self._changed(self.coverage, COVERAGE, lambda old: merge_coverage(old, update))

    def runs(self) -> DataFrame:
        """The last event of each run."""
        return latest_runs(self.history.read_or_empty(self._frame([], HISTORY).schema))

    def crashed(self, dataset: str, tenant: str, mode: str) -> str | None:
        """The last run of a dataset that began and neither succeeded nor failed."""
        at = self.runs().where((F.col("dataset") == dataset) & (F.col("tenant") == tenant) & (F.col("mode") == mode))
        row = at.orderBy(F.desc("at")).first()
        return row["run_id"] if row and row["status"] == "running" else None

    def usual(self, run_id: str, dataset: str, tenant: str, rows: int, at: datetime) -> DataFrame:
        """The run at hand among the successful ones of its dataset and tenant, judged by ``anomalies``."""
        before = self.runs().where((F.col("status") == "success") & (F.col("dataset") == dataset) & (F.col("tenant") == tenant) & (F.col("run_id") != run_id))
        now = self._frame([(run_id, dataset, tenant, at, rows)], "run_id string, dataset string, tenant string, started_at timestamp, rows_loaded bigint")
        past = before.where("rows_loaded IS NOT NULL AND coalesce(metadata, '') NOT LIKE '%dry_run%' AND coalesce(metadata, '') NOT LIKE '%no_pages%'").select("run_id", "dataset", "tenant", F.col("at").alias("started_at"), "rows_loaded")
        return anomalies(past.where(F.col("started_at") <= F.lit(at)).unionByName(now)).where(F.col("run_id") == run_id)
