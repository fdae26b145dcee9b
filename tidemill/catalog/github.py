"""Datasets of repositories, people, commits, reviews, workflows, runners and deployments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.coerce import truncate_middle
from tidemill.operators.incremental import split_names
from tidemill.sources.pages import at
from tidemill.spec import Context, Dataset
from tidemill.spec import Field as f


#: Descriptions of more characters lose their middle.
LONGEST = 4000


def _times(*names: str) -> tuple[f, ...]:
    return tuple(f(n, "timestamptz") for n in names)


def _deployment(df: DataFrame, context: Context) -> DataFrame:
    """The key and address of a deployment from its parts, and long descriptions cut in the middle."""
    name = F.concat("organization", F.lit("/"), "repo_name")
    url = F.concat(F.lit("https://github.com/"), name, F.lit("/deployments"))
    return df.withColumns({"org_repo_key": name, "source_url": url, "description": truncate_middle(F.col("description"), LONGEST)})


# Fixed values here: names of tables, columns and paths, the longest text that a column may hold, and the share of nulls that it may have.
OF_REPO = {"parent": "github_repos", "parent_key": {"*": "full_name"}, "by_tenant": "full_name"}

REPOS = Dataset(
    "github_repos",
    (
        f("id", "bigint", nullable=False), f("full_name", nullable=False), f("name"), f("owner_login", path="owner.login", on_null_parent=""), f("private", "boolean"), f("description"),
        f("language"), f("default_branch"), *_times("created_at", "updated_at", "pushed_at"), f("archived", "boolean"), f("html_url"),
    ),
    ("full_name",), null_limits={"description": 0.5, "language": 0.5, "pushed_at": 0.5},
    max_lengths={"full_name": 200, "name": 100, "owner_login": 100, "default_branch": 256, "html_url": 2048},
)
MEMBERS = Dataset("github_members", (f("login", nullable=False), f("id", "bigint"), f("avatar_url"), f("type")), ("login",), unique=(("id",),), max_lengths={"login": 100, "avatar_url": 2048, "type": 100})
USER_DETAILS = Dataset(
    "github_user_details",
    (f("login", nullable=False), f("name"), f("company"), f("location"), f("email"), f("bio"), f("public_repos", "integer"), f("followers", "integer"), *_times("created_at", "updated_at")),
    ("login",), records=None, load="replace", parent="github_members", parent_key={"*": "login"}, where=lambda r: r.where(at(F.col("record"), "login", "string").isNotNull()),
)
BRANCHES = Dataset("github_branches", (f("repo_full_name", nullable=False, key="*"), f("name", nullable=False), f("protected", "boolean"), f("commit_sha", path="commit.sha", on_null_parent="")), ("repo_full_name", "name"), load="replace", max_lengths={"repo_full_name": 200, "name": 256, "commit_sha": 40}, **OF_REPO)
COMMITS = Dataset(
    "github_commits",
    (
        f("sha", nullable=False), f("repo_full_name", key="*"), f("author_login", path="author.login", on_null_parent=""), f("author_date", "timestamptz", "commit.author.date"),
        f("committer_login", path="committer.login", on_null_parent=""), f("committer_date", "timestamptz", "commit.committer.date"), f("message", path="commit.message"), f("html_url"),
    ),
    ("sha",), mode="forward", incremental="committer_date", max_lengths={"sha": 40, "repo_full_name": 200, "author_login": 100, "committer_login": 100, "html_url": 2048}, **OF_REPO,
)
PULL_REQUESTS = Dataset(
    "github_pull_requests",
    (
        f("id", "bigint", nullable=False), f("number", "integer"), f("title"), f("state"), f("user_login", path="user.login", on_null_parent=""), f("repo_full_name", path="base.repo.full_name", on_null_parent=""),
        *_times("created_at", "updated_at", "closed_at", "merged_at"), f("draft", "boolean"), f("head_ref", path="head.ref", on_null_parent=""), f("base_ref", path="base.ref", on_null_parent=""), f("html_url"),
    ),
    ("id",), mode="forward", incremental="updated_at", null_limits={"closed_at": 1.0, "merged_at": 1.0},
    max_lengths={"state": 100, "user_login": 100, "repo_full_name": 200, "head_ref": 256, "base_ref": 256, "html_url": 2048}, **OF_REPO,
)
WORKFLOWS = Dataset("github_workflows", (f("id", "bigint", nullable=False), f("repo_full_name", key="*"), f("name"), f("path"), f("state"), *_times("created_at", "updated_at")), ("id",), "workflows", "replace", **OF_REPO)
WORKFLOW_RUNS = Dataset(
    "github_workflow_runs",
    (
        f("id", "bigint", nullable=False), f("repo_full_name", key="*"), f("name"), f("workflow_id", "bigint"), f("status"), f("conclusion"), f("head_branch"), f("head_sha"), f("event"),
        f("run_number", "integer"), f("run_attempt", "integer"), *_times("created_at", "updated_at", "run_started_at"), f("html_url"),
    ),
    ("id",), "workflow_runs", mode="forward", incremental="updated_at",
    max_lengths={"repo_full_name": 200, "name": 1024, "status": 100, "conclusion": 100, "head_branch": 256, "head_sha": 40, "event": 100, "html_url": 2048}, **OF_REPO,
)
WORKFLOW_JOBS = Dataset(
    "github_workflow_jobs",
    (f("id", "bigint", nullable=False), f("run_id", "bigint"), f("name"), f("status"), f("conclusion"), *_times("started_at", "completed_at"), f("runner_name"), f("runner_group_name")),
    ("id",), "jobs", mode="forward", incremental="completed_at", parent="github_workflow_runs", parent_key={"repo_full_name": "repo_full_name", "id": "id"},
)
RUNNER_GROUPS = Dataset("github_runner_groups", (f("id", "bigint", nullable=False), f("name"), f("visibility"), f("default", "boolean"), f("allows_public_repositories", "boolean")), ("id",), "runner_groups", max_lengths={"name": 500, "visibility": 100})
RUNNER_GROUP_REPOS = Dataset(
    "github_runner_group_repos", (f("runner_group_id", "bigint", nullable=False, key="*"), f("repo_id", "bigint", "id", nullable=False), f("repo_full_name", path="full_name")), ("runner_group_id", "repo_id"), "repositories", "replace", parent="github_runner_groups", parent_key={"*": "id"}
)
REPO_PROPERTIES = Dataset("github_repo_properties", (f("repo_full_name", nullable=False, key="*"), f("property_name", nullable=False), f("value")), ("repo_full_name", "property_name"), load="replace", **OF_REPO)
DEPLOYMENTS = Dataset(
    "github_deployments",
    (
        f("deployment_id", "bigint", "databaseId", nullable=False), f("organization", nullable=False, key="owner"), f("repo_name", nullable=False, key="name"), f("org_repo_key", nullable=False, optional=True), f("environment"), f("description"),
        f("state"), f("latest_status", path="latestStatus.state"), f("creator_login", path="creator.login"), f("sha", path="commit.oid"), f("created_at", "timestamptz", "createdAt", nullable=False), f("updated_at", "timestamptz", "updatedAt"), f("source_url", optional=True),
    ),
    ("deployment_id", "organization"), "data.repository.deployments.nodes", mode="forward", incremental="created_at", lookback_days=720, transform=_deployment, guarded=True,
    parent="github_repos", by_tenant="full_name", parent_key={"owner": "owner", "name": "repo"}, parent_rows=lambda repos: split_names(repos, "full_name", "owner", "repo"),
    noted={"description cut in the middle": lambda df: F.length("description") > LONGEST}, max_lengths={"organization": 100, "repo_name": 100, "org_repo_key": 200, "environment": 256, "description": 4100, "state": 30, "latest_status": 30, "creator_login": 100, "sha": 40, "source_url": 512},
)
DATASETS = (REPOS, MEMBERS, USER_DETAILS, BRANCHES, COMMITS, PULL_REQUESTS, WORKFLOWS, WORKFLOW_RUNS, WORKFLOW_JOBS, RUNNER_GROUPS, RUNNER_GROUP_REPOS, REPO_PROPERTIES, DEPLOYMENTS)
