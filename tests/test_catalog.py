"""Own bodies of the shapes that the datasets declare, and the rows that must come of them."""

import json
from datetime import datetime

import pytest

from tidemill.catalog import DATASETS
from tidemill.plans.run import CheckFailed, Watched, rows_of
from tidemill.sources.pages import SCHEMA, BadPages, announced_total, guard_envelopes
from tidemill.spec import Context

AS_OF = datetime(2024, 6, 1)


def landed(spark, name, *bodies, key=None, tenant="acme"):
    rows = [(name, tenant, json.dumps(key), i + 1, datetime(2024, 5, 1), 100 + i, b if isinstance(b, str) else json.dumps(b), None) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, name, *bodies, key=None, mode="full"):
    dataset = DATASETS[name]
    context = Context("run", mode, AS_OF)
    watched = Watched(dataset, rows_of(dataset, landed(spark, name, *bodies, key=key), context))
    df = dataset.transform(watched.rows, context) if dataset.transform is not None else watched.rows
    out = [r.asDict() for r in df.collect()]
    watched.refuse_absent()
    return [{c: r[c] for c in dataset.columns} for r in out]


def test_there_are_all_datasets():
    assert len(DATASETS) == 38
    for d in DATASETS.values():
        assert set(d.primary_key) <= set(d.columns)


def test_repos_keep_absent_owner_text_and_nulls(spark):
    body = [{"id": 2**33, "full_name": "acme/a", "name": "a", "owner": None, "private": True, "description": "", "language": None, "default_branch": "main", "created_at": "2024-01-02T03:04:05Z", "updated_at": "", "pushed_at": None, "archived": False, "html_url": "u", "more": 1}]
    (row,) = rows(spark, "github_repos", body)
    assert row["id"] == 2**33 and row["owner_login"] == "" and row["private"] is True and row["language"] is None and row["description"] == ""
    assert row["created_at"] == datetime(2024, 1, 2, 3, 4, 5) and row["updated_at"] is None


def test_missing_key_fails_and_null_parent_does_not(spark):
    pr = {"id": 1, "number": 1, "title": "t", "state": "open", "user": None, "created_at": None, "updated_at": "2024-01-01T00:00:00Z", "closed_at": None, "merged_at": None, "draft": False, "head": {"ref": "h"}, "base": {"ref": "b", "repo": None}, "html_url": "u"}
    (row,) = rows(spark, "github_pull_requests", [pr])
    assert row["user_login"] == "" and row["repo_full_name"] == "" and row["head_ref"] == "h"
    with pytest.raises(CheckFailed, match="head_ref"):
        rows(spark, "github_pull_requests", [pr | {"head": {}}])
    with pytest.raises(CheckFailed, match="title"):
        rows(spark, "github_pull_requests", [{k: v for k, v in pr.items() if k != "title"}])


def test_keys_come_from_the_page(spark):
    (row,) = rows(spark, "github_branches", [{"name": "main", "protected": True, "commit": {"sha": "s"}}], key="acme/a")
    assert row == {"repo_full_name": "acme/a", "name": "main", "protected": True, "commit_sha": "s"}
    (row,) = rows(spark, "github_runner_group_repos", {"total_count": 1, "repositories": [{"id": 5, "full_name": "acme/a"}]}, key=77)
    assert row == {"runner_group_id": 77, "repo_id": 5, "repo_full_name": "acme/a"}


def test_wrong_shapes_have_no_rows(spark):
    assert rows(spark, "github_members", {"login": "x"}) == []
    assert rows(spark, "github_workflows", [1, 2], key="a/b") == []
    assert rows(spark, "github_user_details", {"message": "gone"}) == []
    assert rows(spark, "github_members", "<html>") == []


def test_deployments(spark):
    node = {"databaseId": 2**40, "environment": "prod", "description": "x" * 4001, "state": "ok", "createdAt": "2024-05-01T00:00:00Z", "updatedAt": "2024-05-02T00:00:00Z", "creator": None, "commit": {"oid": "c"}, "latestStatus": None}
    body = {"data": {"repository": {"deployments": {"nodes": [node, node | {"databaseId": 1, "createdAt": "2020-01-01T00:00:00Z", "description": None}]}}}}
    got = rows(spark, "github_deployments", body, key={"owner": "acme", "name": "a"}, mode="forward")
    assert len(got) == 1 and got[0]["org_repo_key"] == "acme/a" and got[0]["source_url"].endswith("acme/a/deployments")
    assert got[0]["description"] == "x" * 2000 + "[truncated]" + "x" * 2000 and got[0]["latest_status"] is None


def test_error_envelopes(spark):
    good = landed(spark, "d", {"data": {}}, {"errors": []})
    assert guard_envelopes(good).count() == 2
    for bad in ({"errors": [{"message": "slow down"}]}, [1], "oops"):
        with pytest.raises(BadPages):
            guard_envelopes(landed(spark, "d", {"data": {}}, bad))


def test_servicenow_types(spark):
    user = dict.fromkeys(DATASETS["servicenow_users"].columns, "x") | {"active": "true", "last_login_time": "", "sys_updated_on": "2024-01-01 10:00:00", "email": ""}
    got = rows(spark, "servicenow_users", {"result": [user, user | {"sys_id": "y", "active": "TRUE"}]})
    assert got[0]["active"] is True and got[1]["active"] is None and got[0]["last_login_time"] is None and got[0]["sys_updated_on"] == datetime(2024, 1, 1, 10)
    place = dict.fromkeys(DATASETS["servicenow_locations"].columns, "x") | {"latitude": "-33.5", "longitude": "", "sys_updated_on": "2024-01-01 10:00:00"}
    (row,) = rows(spark, "servicenow_locations", {"result": [place]})
    assert row["latitude"] == -33.5 and row["longitude"] is None


def test_sonarqube_details_branches_issues(spark):
    body = {"component": {"key": "p", "name": "n", "qualifier": "TRK", "description": None, "visibility": "public", "version": "1", "analysisDate": "2024-01-01T00:00:00+0000", "leakPeriodDate": None, "tags": ["a", "b"]}}
    (row,) = rows(spark, "sonarqube_project_details", body)
    assert row["tags"] == '["a","b"]' and row["analysis_date"] == datetime(2024, 1, 1)
    (row,) = rows(spark, "sonarqube_project_details", {"component": body["component"] | {"tags": []}})
    assert row["tags"] is None
    (row,) = rows(spark, "sonarqube_branches", {"branches": [{"name": "main", "isMain": True, "type": "LONG", "status": None, "excludedFromPurge": True}]}, key="p")
    assert row["project_key"] == "p" and row["is_main"] is True and row["quality_gate_status"] is None
    issue = {"key": "i", "rule": "r", "severity": "s", "component": "c", "project": "p", "message": "m", "status": "OPEN", "type": "BUG", "creationDate": "2024-01-01T00:00:00+0100", "updateDate": "2024-01-01T00:00:00+0000"}
    (row,) = rows(spark, "sonarqube_issues", {"issues": [issue]})
    assert row["line"] is None and row["creation_date"] == datetime(2023, 12, 31, 23)


def test_sonarqube_events_measures_history(spark):
    analyses = {"analyses": [{"key": "A", "date": "2024-01-01T00:00:00+0000", "events": [{"key": "E1", "category": "QUALITY_GATE", "name": "Red", "description": None, "qualityGate": {"status": "ERROR", "stillFailing": False, "other": 1}}, {"key": "E2", "category": "VERSION", "name": "1.0", "description": "d"}]}, {"key": "B", "date": "x", "events": []}]}
    got = {r["key"]: r for r in rows(spark, "sonarqube_analysis_events", analyses, key="p")}
    assert set(got) == {"E1", "E2"} and got["E1"]["analysis_key"] == "A" and json.loads(got["E1"]["details"]) == {"qualityGate": {"status": "ERROR", "stillFailing": False, "other": 1}} and got["E2"]["details"] is None and got["E1"]["project_key"] == "p"
    measures = {"component": {"measures": [{"metric": "bugs", "value": "3"}, {"metric": "new_coverage", "period": {"value": "80.0"}}, {"metric": "unknown", "value": "1"}]}}
    got = {r["metric_key"]: r["metric_value"] for r in rows(spark, "sonarqube_measures", measures, key={"project_key": "p", "branch": "main"})}
    assert got == {"bugs": "3", "new_coverage": "80.0"}
    history = {"measures": [{"metric": "bugs", "history": [{"date": "2024-05-01T08:00:00+0000", "value": "1"}, {"date": "2024-05-01T18:00:00+0000", "value": "2"}, {"date": "2024-05-02T00:00:00+0000"}, {"date": "2020-01-01T00:00:00+0000", "value": "9"}, {"date": "never", "value": "7"}]}]}
    got = {str(r["analysis_date"].date()): r["value"] for r in rows(spark, "sonarqube_measures_history", history, key={"project_key": "p", "branch": "main"})}
    assert got == {"2024-05-01": "2", "2024-05-02": None}
    assert rows(spark, "sonarqube_measures_history", history, key={"project_key": "p"}) == []


@pytest.mark.parametrize(("name", "body", "said"), [
    ("sonarqube_analysis_events", {"analyses": [{"key": "A", "events": [{"key": "E", "category": "c", "name": "n"}]}]}, "description"),
    ("sonarqube_analysis_events", {"analyses": [{"events": [{"key": "E", "category": "c", "name": "n", "description": None}]}]}, "analysis_key"),
    ("sonarqube_measures_history", {"measures": [{"metric": "bugs", "history": [{"value": "1"}]}]}, "analysis_date"),
    ("sonarqube_measures_history", {"measures": [{"history": [{"date": "2024-05-01T00:00:00+0000", "value": "1"}]}]}, "metric_key"),
    ("sonarqube_measures", {"component": {"measures": [{"value": "1"}]}}, "metric_key"),
])
def test_missing_keys_of_nested_lists(spark, name, body, said):
    with pytest.raises(CheckFailed, match=said):
        rows(spark, name, body, key={"project_key": "p", "branch": "main"})


def test_many_children_of_one_parent_keep_their_order(spark):
    values = [{"date": f"2024-05-01T{k // 60 % 24:02d}:{k % 60:02d}:00+0000", "value": str(k)} for k in range(1440)] * 10
    got = rows(spark, "sonarqube_measures_history", {"measures": [{"metric": "bugs", "history": values}] * 3}, key={"project_key": "p", "branch": "main"})
    assert [r["value"] for r in got] == ["1439"]


def test_jira(spark):
    fields = {"summary": "s", "status": {"name": "Open"}, "priority": None, "issuetype": {"name": "Bug"}, "project": {"key": "P"}, "assignee": None, "reporter": {"displayName": "R"}, "created": "2024-01-01T00:00:00.000+0000", "updated": "2024-01-02T00:00:00.000+0000", "resolutiondate": None, "labels": ["a", "b"]}
    (row,) = rows(spark, "jira_issues", {"issues": [{"id": "1", "key": "P-1", "fields": fields}]})
    assert row["priority"] == "" and row["assignee"] is None and row["labels"] == "a,b" and row["updated"] == datetime(2024, 1, 2)
    (row,) = rows(spark, "jira_issues", {"issues": [{"id": "1", "key": "P-1", "fields": fields | {"labels": []}}]})
    assert row["labels"] is None


def test_announced_total(spark):
    pages = landed(spark, "sonarqube_projects", {"paging": {"total": 7}, "components": []}, {"paging": {"total": 9}, "components": []})
    assert announced_total(pages, "paging.total").first()["announced"] == 9


@pytest.mark.parametrize("name", ["github_repos", "sonarqube_analysis_events", "sonarqube_measures_history", "servicenow_choices"])
def test_no_pages_no_rows(spark, name):
    context = Context("run", "full", AS_OF)
    assert rows_of(DATASETS[name], spark.createDataFrame([], SCHEMA), context).count() == 0
