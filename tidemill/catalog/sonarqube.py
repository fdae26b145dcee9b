"""Datasets of projects, branches, issues, analyses and measures."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.coerce import date_prefix, repack
from tidemill.operators.dedup import daily_latest
from tidemill.operators.incremental import drop_null_keys
from tidemill.operators.kept import FirstSeen
from tidemill.operators.normalize import absent_names, ingest_time, is_absent
from tidemill.sources.pages import at, explode_records, unnest
from tidemill.spec import Context, Dataset
from tidemill.spec import Field as f

# Metrics that are kept, of the present measures and of their history, and what kinds of detail an event has.
METRICS = ("ncloc", "bugs", "vulnerabilities", "code_smells", "coverage", "duplicated_lines_density", "sqale_index", "new_coverage", "new_lines_to_cover", "new_line_coverage")
DETAILS = ("qualityGate", "definitionChange", "qualityProfile")
HISTORY_METRICS = ("bugs", "vulnerabilities", "code_smells", "coverage", "security_hotspots", "open_issues", "complexity", "ncloc", "lines_to_cover", "conditions_to_cover", "uncovered_lines", "uncovered_conditions", "new_lines_to_cover", "new_conditions_to_cover", "new_uncovered_lines", "new_uncovered_conditions", "reliability_rating", "sqale_rating", "duplicated_lines", "new_coverage", "security_rating", "tests")
LOOKBACK_DAYS = 720
META = ["tenant", "entity_key", "page", "fetched_at", "seq"]


def _has_key(records: DataFrame) -> DataFrame:
    return records.where(at(F.col("record"), "key", "string").isNotNull())


def _collected(df: DataFrame, context: Context) -> DataFrame:
    return ingest_time(df, "collected_at", context.as_of)


def _events(pages: DataFrame) -> DataFrame:
    """The events of analyses, each with its analysis's key; what kind of detail an event has becomes JSON text."""
    analyses = explode_records(pages, "analyses").select(*META, F.col("pos").alias("outer"), at(F.col("record"), "key", "string").alias("analysis_key"), "record")
    events = unnest(analyses, "record", "events", [*META, "outer", "analysis_key"], "event")
    e = F.col("event")
    absent = F.array_append(absent_names(lambda path: at(e, path), [f(n) for n in ("key", "category", "name", "description")]), F.when(F.col("analysis_key").isNull(), "analysis_key"))
    return events.select(
        at(e, "key", "string").alias("key"), "analysis_key", at(F.try_parse_json("entity_key"), "", "string").alias("project_key"),
        *(at(e, n, "string").alias(n) for n in ("category", "name", "description")), repack(**{n: at(e, n) for n in DETAILS}).alias("details"), *_landing(), F.array_compact(absent).alias("_absent"),
    )


def _landing() -> list:
    """The landing of a child: its parent's place in the page and its own, in one number of 64 bits."""
    return [*(F.col(c).alias(f"_{c}") for c in ("tenant", "fetched_at", "page", "seq")), (F.col("outer").cast("bigint") * (1 << 32) + F.col("pos")).alias("_pos")]


def _branch_key(name: str):
    return at(F.try_parse_json("entity_key"), name, "string")


def _history(pages: DataFrame) -> DataFrame:
    """Two levels down: metrics, then their values in time. The text of the moment stays until one of each day is chosen."""
    metrics = explode_records(pages, "measures").select(*META, F.col("pos").alias("outer"), at(F.col("record"), "metric", "string").alias("metric_key"), "record")
    values = unnest(metrics, "record", "history", [*META, "outer", "metric_key"], "value_at")
    v = F.col("value_at")
    return values.where(F.col("metric_key").isNull() | F.col("metric_key").isin(*HISTORY_METRICS)).select(
        _branch_key("project_key").alias("project_key"), _branch_key("branch").alias("branch"), "metric_key", date_prefix(at(v, "date", "string")).alias("analysis_date"), at(v, "value", "string").alias("value"),
        F.lit(None).cast("timestamp").alias("collected_at"), at(v, "date", "string").alias("_raw"), *_landing(),
        F.array_compact(F.array(F.when(F.col("metric_key").isNull(), "metric_key"), F.when(is_absent(lambda path: at(v, path), "date"), "analysis_date"))).alias("_absent"),
        (date_prefix(at(v, "date", "string")).isNull() & (F.coalesce(at(v, "date", "string"), F.lit("")) != "")).alias("_unread"),
    )


HISTORY_KEY = ["project_key", "branch", "metric_key", "analysis_date"]


def _one_a_day(df: DataFrame, context: Context) -> DataFrame:
    keyed = drop_null_keys(df, HISTORY_KEY)
    recent = keyed.where(F.col("analysis_date") >= F.lit(context.as_of - timedelta(days=LOOKBACK_DAYS)))
    day = daily_latest(recent, ["project_key", "branch", "metric_key"], "_raw", "analysis_date", [F.desc("_seq"), F.desc("_pos")])
    return _collected(day.drop("_raw"), context)


# The longest text that a column may hold; longer ones fail the run.
LENGTHS = {"key": 500, "project_key": 500, "project": 500, "rule": 500, "severity": 100, "status": 100, "type": 100, "category": 200}


def _lengths(*names: str) -> dict[str, int]:
    return {n: LENGTHS[n] for n in names}


OF_PROJECT = {"parent": "sonarqube_projects", "parent_key": {"*": "key"}}
OF_BRANCH = {"parent": "sonarqube_branches", "parent_key": {"project_key": "project_key", "branch": "name"}}

PROJECTS = Dataset("sonarqube_projects", (f("key", nullable=False), f("name"), f("qualifier")), ("key",), "components", "replace", announced="paging.total", max_lengths={"key": 500, "name": 500, "qualifier": 10})
PROJECT_DETAILS = Dataset(
    "sonarqube_project_details",
    (f("key", nullable=False, path="component.key"), *(f(n, path=f"component.{n}") for n in ("name", "description", "visibility", "version")), f("analysis_date", "timestamptz", "component.analysisDate"), f("leak_period_date", "timestamptz", "component.leakPeriodDate"), f("tags", "json", "component.tags", form="json")),
    ("key",), None, "replace", where=lambda r: r.where(at(F.col("record"), "component.key", "string").isNotNull()), max_lengths=_lengths("key"), **OF_PROJECT,
)
BRANCHES = Dataset(
    "sonarqube_branches",
    (f("project_key", nullable=False, key="*"), f("name", nullable=False), f("is_main", "boolean", "isMain"), f("type"), f("quality_gate_status", path="status.qualityGateStatus"), f("analysis_date", "timestamptz", "analysisDate", optional=True), f("excluded_from_purge", "boolean", "excludedFromPurge")),
    ("project_key", "name"), "branches", "replace", max_lengths=_lengths("project_key", "type"), **OF_PROJECT,
)
ISSUES = Dataset(
    "sonarqube_issues",
    (f("key", nullable=False), *(f(n) for n in ("rule", "severity", "component", "project")), f("line", "integer", optional=True), *(f(n) for n in ("message", "status", "type")), f("creation_date", "timestamptz", "creationDate"), f("update_date", "timestamptz", "updateDate")),
    ("key",), "issues", mode="forward", incremental="update_date", null_limits={"line": 1.0}, max_lengths=_lengths("key", "rule", "severity", "project", "status", "type"), **OF_PROJECT,
)
ANALYSES = Dataset(
    "sonarqube_analyses",
    (f("key", nullable=False), f("project_key", nullable=False, key="*"), f("date", "timestamptz"), f("project_version", path="projectVersion", optional=True), f("revision", optional=True), f("detected_ci", path="detectedCI", optional=True)),
    ("key",), "analyses", mode="forward", incremental="date", max_lengths=_lengths("key", "project_key"), **OF_PROJECT,
)
ANALYSIS_EVENTS = Dataset(
    "sonarqube_analysis_events", (*(f(n, nullable=n not in ("key", "analysis_key", "project_key")) for n in ("key", "analysis_key", "project_key", "category", "name", "description")), f("details", "json")),
    ("key",), "analyses", "replace", parse=_events, required=("key", "analysis_key", "category", "name", "description"), max_lengths=_lengths("key", "project_key", "category"), **OF_PROJECT,
)
MEASURES = Dataset(
    "sonarqube_measures",
    (f("project_key", nullable=False, key="project_key"), f("branch", nullable=False, key="branch"), f("metric_key", path="metric", nullable=False), f("metric_value", path="value", fallback=("period.value",)), f("collected_at", "timestamptz", optional=True)),
    ("project_key", "branch", "metric_key"), "component.measures", "replace", where=lambda r: r.where(at(F.col("record"), "metric", "string").isNull() | at(F.col("record"), "metric", "string").isin(*METRICS)), transform=_collected, null_limits={"metric_value": 1.0}, max_lengths=_lengths("project_key"), **OF_BRANCH,
)
MEASURES_HISTORY = Dataset(
    "sonarqube_measures_history",
    (*(f(n, nullable=False) for n in ("project_key", "branch", "metric_key")), f("analysis_date", "timestamptz", nullable=False), f("value"), f("collected_at", "timestamptz")),
    tuple(HISTORY_KEY), "measures", mode="forward", incremental="analysis_date", parse=_history, apart=False, kept={"first_seen": FirstSeen("project_key", "analysis_date")}, required=("metric_key", "analysis_date"), transform=_one_a_day, lookback_days=LOOKBACK_DAYS, null_limits={"value": 1.0}, max_lengths=_lengths("project_key"),
    noted={"dropped for want of a part of the key": lambda df: F.greatest(*(F.col(k).isNull() for k in HISTORY_KEY))}, **OF_BRANCH,
)
DATASETS = (PROJECTS, PROJECT_DETAILS, BRANCHES, ISSUES, ANALYSES, ANALYSIS_EVENTS, MEASURES, MEASURES_HISTORY)
