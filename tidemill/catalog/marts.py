"""Tables made from other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.calendar import trend_of_weeks
from tidemill.spec import Dataset
from tidemill.spec import Field as f


def daily_counts(rows: DataFrame, day: str, *groups: str) -> DataFrame:
    """``report_date``, the groups (null: Unknown) and ``row_count`` of rows with a moment. Null and "Unknown" are one group."""
    named = rows.where(F.col(day).isNotNull()).select(F.to_date(day).alias("report_date"), *(F.coalesce(g, F.lit("Unknown")).alias(g) for g in groups))
    return named.groupBy("report_date", *groups).agg(F.count("*").cast("int").alias("row_count"))


def by_day(rows: DataFrame) -> DataFrame:
    """The groups that incidents are counted in; kept beside the incidents, so that the mart never reads them."""
    return rows.where("opened_at IS NOT NULL").select(F.to_date("opened_at").alias("report_date"), *(F.coalesce(g, F.lit("Unknown")).alias(g) for g in ("priority", "state")))


def _incidents(spark, context, tables) -> DataFrame:
    return tables["servicenow_incidents:by_day"].select("report_date", "priority", "state", F.col("n").cast("int").alias("incident_count"))


def _adoption(spark, context, tables) -> DataFrame:
    trend = trend_of_weeks(tables["sonarqube_measures_history:first_seen:weeks"], context.as_of.isoformat(" "))
    return trend.toDF("week_start_date", "new_projects", "cumulative_projects")


SUMMARY_FIELDS = (f("report_date", "date", nullable=False), f("priority", nullable=False), f("state", nullable=False), f("incident_count", "integer", nullable=False))
TREND_FIELDS = (f("week_start_date", "date", nullable=False), f("new_projects", "bigint", nullable=False), f("cumulative_projects", "bigint", nullable=False))
INCIDENT_SUMMARY = Dataset("incident_summary", SUMMARY_FIELDS, ("report_date", "priority", "state"), load="replace", mode="transform", sources=("servicenow_incidents:by_day",), build=_incidents)
ADOPTION_TREND = Dataset("sonarqube_adoption_trend", TREND_FIELDS, ("week_start_date",), load="replace", mode="transform", sources=("sonarqube_measures_history:first_seen:weeks",), build=_adoption)

#: The same marts as text, from the tables themselves.
INCIDENT_SUMMARY_SQL = Dataset(
    "incident_summary_sql", SUMMARY_FIELDS, ("report_date", "priority", "state"), load="replace", mode="transform", sources=("servicenow_incidents",),
    sql="""SELECT to_date(opened_at) AS report_date, coalesce(priority, 'Unknown') AS priority, coalesce(state, 'Unknown') AS state, cast(count(*) AS int) AS incident_count
FROM {servicenow_incidents} WHERE opened_at IS NOT NULL GROUP BY ALL""",
)
ADOPTION_TREND_SQL = Dataset(
    "sonarqube_adoption_trend_sql", TREND_FIELDS, ("week_start_date",), load="replace", mode="transform", sources=("sonarqube_measures_history",),
    sql="""WITH last AS (SELECT cast(date_trunc('week', :as_of - INTERVAL 7 DAYS) AS date) AS week),
weekly AS (SELECT week_start_date, count(*) AS n FROM (SELECT cast(date_trunc('week', min(analysis_date)) AS date) AS week_start_date FROM {sonarqube_measures_history} WHERE analysis_date <= :as_of GROUP BY project_key), last WHERE week_start_date <= week GROUP BY ALL),
spine AS (SELECT explode(sequence(min(week_start_date), greatest(max(week_start_date), max(week)), INTERVAL 7 DAYS)) AS week_start_date FROM weekly, last)
SELECT s.week_start_date, coalesce(n, 0) AS new_projects, cast(sum(coalesce(n, 0)) OVER (ORDER BY s.week_start_date) AS bigint) AS cumulative_projects FROM spine s LEFT JOIN weekly w ON w.week_start_date = s.week_start_date""",
)
DATASETS = (INCIDENT_SUMMARY, ADOPTION_TREND)
