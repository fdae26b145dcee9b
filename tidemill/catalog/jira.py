"""Datasets of projects and issues."""

from __future__ import annotations

from tidemill.spec import Dataset
from tidemill.spec import Field as f

# Fixed values here: names of columns and paths, the longest text that a column may hold, and the share of nulls that it may have.
PROJECTS = Dataset("jira_projects", (f("id", nullable=False), f("key", nullable=False), f("name"), f("project_type_key", path="projectTypeKey"), f("style"), f("is_private", "boolean", "isPrivate")), ("key",), "values", "replace", max_lengths={"id": 100, "key": 100, "name": 500, "project_type_key": 100, "style": 100})
ISSUES = Dataset(
    "jira_issues",
    (
        f("id", nullable=False), f("key", nullable=False), f("summary", path="fields.summary"), *(f(n, path=p, on_null_parent="") for n, p in (("status", "fields.status.name"), ("priority", "fields.priority.name"), ("issue_type", "fields.issuetype.name"), ("project_key", "fields.project.key"))),
        f("assignee", path="fields.assignee.displayName"), f("reporter", path="fields.reporter.displayName"), f("created", "timestamptz", "fields.created"), f("updated", "timestamptz", "fields.updated"), f("resolution_date", "timestamptz", "fields.resolutiondate"), f("labels", path="fields.labels", form="joined"),
    ),
    ("id",), "issues", mode="forward", incremental="updated", parent="jira_projects", parent_key={"*": "key"}, unique=(("key",),), null_limits={"assignee": 0.5, "reporter": 0.2, "resolution_date": 1.0, "labels": 1.0},
    max_lengths={"id": 100, "key": 100, "status": 100, "priority": 100, "issue_type": 100, "project_key": 100, "assignee": 500, "reporter": 500},
)
DATASETS = (PROJECTS, ISSUES)
