"""Runs from landed pages to targets, their state and their failures."""

import json
import os
from datetime import date, datetime

import pytest

from tidemill.catalog import DATASETS
from tidemill.catalog.marts import ADOPTION_TREND_SQL
from tidemill.operators.history import latest_runs
from tidemill.operators.promote import ContractBroken, promote
from tidemill.operators.quality import HasColumns, MaxLength, NotAllNull, NotNull, NullRate, Oversized, RowCount, Unique, Unparseable, run_checks
from tidemill.operators.tokens import tokenize, tokenize_with
from tidemill.plans.run import CheckFailed, Warehouse, run_dataset
from tidemill.sources import pages
from tidemill.sources.pages import SCHEMA
from tidemill.sources.snapshots import ConcurrentCommit, Snapshots
from tidemill.spec import Dataset, Field
from tidemill.streaming.ingest import stream_dataset

AS_OF = datetime(2024, 6, 1)


def land(spark, warehouse, name, bodies, seq=0, tenant="acme", key=None, day=date(2024, 5, 1)):
    rows = [(name, tenant, json.dumps(key), i + 1, datetime(2024, 5, 1), seq + i, json.dumps(b), None) for i, b in enumerate(bodies)]
    pages.land(spark.createDataFrame(rows, SCHEMA), warehouse.pages, day)


def incident(i, at, priority="1", **more):
    return dict.fromkeys(DATASETS["servicenow_incidents"].columns, "x") | {"sys_id": f"i{i}", "number": f"N{i}", "opened_at": at, "closed_at": "", "sys_updated_on": at, "priority": priority} | more


def test_full_forward_and_mart(spark, tmp_path):
    w, incidents = Warehouse(spark, str(tmp_path)), DATASETS["servicenow_incidents"]
    land(spark, w, incidents.name, [{"result": [incident(1, "2024-01-01 10:00:00"), incident(2, "2024-01-02 10:00:00", None)]}])
    first = run_dataset(w, incidents, "full", "acme", AS_OF)
    assert first.promoted and first.rows_loaded == 2
    marks = w.ops.marks(incidents.name, "acme")
    assert marks["forward_watermark"] == datetime(2024, 1, 2, 10) and marks["backward_watermark"] == datetime(2024, 1, 1, 10)
    land(spark, w, incidents.name, [{"result": [incident(2, "2024-01-03 10:00:00", "Unknown"), incident(3, "2024-01-03 11:00:00", None)]}], seq=10)
    run_dataset(w, incidents, "forward", "acme", AS_OF)
    run_dataset(w, incidents, "forward", "acme", AS_OF)  # the same window again changes nothing
    got = {r["sys_id"]: r["priority"] for r in w.table(incidents.name).read().collect()}
    assert got == {"i1": "1", "i2": "Unknown", "i3": None}
    run_dataset(w, DATASETS["incident_summary"], as_of=AS_OF)
    rows = {(str(r["report_date"]), r["priority"]): r["incident_count"] for r in w.table("incident_summary").read().collect()}
    assert rows == {("2024-01-01", "1"): 1, ("2024-01-03", "Unknown"): 2}
    assert {r["status"] for r in latest_runs(w.ops.history.read()).collect()} == {"success"}
    known = {r["dataset"]: (r["load_strategy"], r["source"], r["last_success_at"]) for r in w.ops.known().collect()}
    assert known == {incidents.name: ("upsert", "servicenow", AS_OF), "incident_summary": ("replace", None, AS_OF)}


def test_failed_run_leaves_the_target(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["github_members"]
    land(spark, w, d.name, [[{"login": "a", "id": 1, "avatar_url": "u", "type": "User"}]])
    run_dataset(w, d, tenant="acme", as_of=AS_OF)
    before = w.table(d.name).current()
    land(spark, w, d.name, [[{"login": None, "id": 2, "avatar_url": "u", "type": "User"}]], seq=5, tenant="other")
    with pytest.raises(CheckFailed, match="login: 1 nulls"):
        run_dataset(w, d, tenant="other", as_of=AS_OF)
    assert w.table(d.name).current() == before
    with pytest.raises(CheckFailed, match="0 rows"):
        run_dataset(w, d, tenant="nobody", as_of=AS_OF)
    failed = [r for r in w.ops.history.read().collect() if r["status"] == "failed"]
    assert len(failed) == 2


def test_dry_run_promotes_nothing(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["github_members"]
    land(spark, w, d.name, [[{"login": "a", "id": 1, "avatar_url": "u", "type": "User"}]])
    got = run_dataset(w, d, tenant="acme", as_of=AS_OF, dry_run=True)
    assert not got.promoted and not w.table(d.name).exists()


def test_sensitive_columns_are_tokens_before_anything_is_written(spark, tmp_path):
    d = Dataset("people", (Field("id", "bigint", nullable=False), Field("email", sensitive=True)), ("id",))
    w = Warehouse(spark, str(tmp_path), token_key="pepper")
    land(spark, w, "people", [[{"id": 1, "email": "a@b"}, {"id": 2, "email": None}, {"id": 3, "email": "a@b"}]])
    with pytest.raises(ValueError, match="a key that isn't empty"):
        run_dataset(Warehouse(spark, str(tmp_path)), d, as_of=AS_OF, mode="full", tenant="acme")
    run_dataset(w, d, as_of=AS_OF, mode="full", dry_run=False, tenant="acme")
    got = {r["id"]: r["email"] for r in w.table("people").read().collect()}
    assert got[2] is None and got[1] == got[3] and len(got[1]) == 18 and got[1] != "a@b"


def test_promotion_strategies_and_contracts(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"))
    one = spark.createDataFrame([(1, "a", 1, 0), (1, "b", 2, 0), (2, None, 1, 1)], "id int, v string, _seq bigint, _pos int")
    assert promote(one, t, ["id"], "upsert").rows_loaded == 2
    assert {tuple(r) for r in t.read().collect()} == {(1, "b"), (2, None)}
    promote(one, t, ["id"], "upsert")  # twice is as once
    assert t.read().count() == 2
    more = spark.createDataFrame([(3, "c", 1.5)], "id int, v string, w double")
    with pytest.raises(ContractBroken):
        promote(more, t, ["id"], "upsert", "freeze")
    promote(more, t, ["id"], "upsert", "discard")
    assert t.read().columns == ["id", "v"] and t.read().count() == 3
    promote(more, t, ["id"], "upsert", "evolve")
    assert t.read().columns == ["id", "v", "w"] and t.read().where("w IS NULL").count() == 2
    promote(more, t, ["id"], "append")
    assert t.read().count() == 4
    result = promote(spark.createDataFrame([(7, "", 0.0), (8, "", 0.0), (9, "z", 0.0), (10, "z", 0.0)], "id int, v string, w double"), t, ["id"], "replace", unique=(("v",),))
    assert t.read().where("v IS NULL").count() == 2 and len(result.warnings) == 1 and "('z',) x2" in result.warnings[0]


def test_old_snapshot_stays_readable_when_a_write_breaks(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1,)], "id int"))
    held = t.read()
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division"):
        t.commit(spark.range(3).selectExpr("cast(1 / (id - 1) as int) as id"))
    assert [r["id"] for r in t.read().collect()] == [1]
    t.commit(spark.createDataFrame([(2,)], "id int"))
    assert [r["id"] for r in held.collect()] == [1] and [r["id"] for r in t.read().collect()] == [2]


def test_checks_alone_and_together(spark):
    df = spark.createDataFrame([(1, "x" * 5, None, "soon"), (1, None, None, "2024-01-01"), (None, "y", None, None)], "id int, s string, e string, d string")
    checks = [RowCount(4), NotNull(("id", "gone")), Unique(("id",)), NotAllNull(("e",)), MaxLength({"s": 4, "gone": 1}), HasColumns(("zz",)), NullRate(0.4, {"d": 1.0}, ("id",)), Oversized(4), Unparseable("d")]
    whole = run_checks(df, checks)
    apart = [run_checks(df, [c]) for c in checks]
    assert whole.failures == tuple(m for r in apart for m in r.failures) and whole.warnings == tuple(m for r in apart for m in r.warnings)
    assert len(whole.failures) == 7 and "2 rows share id" in whole.failures
    empty = run_checks(df.limit(0), [NotAllNull(), NullRate(), RowCount(0)])
    assert len(empty.failures) == 4 and not empty.warnings


def test_tokens(spark):
    df = spark.createDataFrame([("a", 1.5), (None, 2.0), ("a", 3.0)], "s string, x double")
    got = [r["s"] for r in tokenize(df, ["s", "gone"], "k").collect()]
    assert got[0] == got[2] and got[1] is None
    with pytest.raises(TypeError):
        tokenize(df, ["x"], "k")


def test_a_vault_is_asked_once_for_each_value(spark, tmp_path):
    said = tmp_path / "asked"
    said.mkdir()

    def vault(values):
        for v in values:
            (said / f"{v}-{os.urandom(4).hex()}").touch()
        return [f"t-{v}" for v in values]

    d = Dataset("people", (Field("id", "bigint", nullable=False), Field("email", sensitive=True), Field("boss", sensitive=True)), ("id",))
    w = Warehouse(spark, str(tmp_path), token_key="pepper", vault=vault)
    land(spark, w, "people", [[{"id": 1, "email": "a", "boss": "b"}, {"id": 2, "email": None, "boss": "a"}]])
    run_dataset(w, d, as_of=AS_OF, mode="full")
    assert {tuple(r) for r in w.table("people").read().collect()} == {(1, "t-a", "t-b"), (2, None, "t-a")}
    assert sorted(n.split("-")[0] for n in os.listdir(said)) == ["a", "b"]
    run_dataset(w, d, as_of=AS_OF, mode="full")
    assert len(os.listdir(said)) == 2  # a second run asks for nothing
    land(spark, w, "people", [[{"id": 3, "email": "c", "boss": "a"}]], seq=9)
    stream_dataset(w, d, str(tmp_path / "c1"), AS_OF).awaitTermination()
    assert sorted(n.split("-")[0] for n in os.listdir(said)) == ["a", "b", "c"]
    assert (3, "t-c", "t-a") in {tuple(r) for r in w.table("people").read().collect()}
    for folder, _, names in os.walk(tmp_path / "tokens"):
        assert all(b"t-a" in (held := open(os.path.join(folder, n), "rb").read()) or b"email" not in held for n in names)
    frame = spark.createDataFrame([("x",), ("y",)], "s string")
    for bad in (lambda values: [], lambda values: [None] * len(values)):
        with pytest.raises(Exception, match="the vault gave"):
            tokenize_with(frame, ["s"], bad, "pepper", w.tokens)
    with pytest.raises(ValueError, match="a key that isn't empty"):
        tokenize_with(frame, ["s"], vault, "", w.tokens)
    with pytest.raises(TypeError):
        tokenize_with(spark.createDataFrame([(1.5,)], "x double"), ["x"], vault, "k", w.tokens)


def member(login, i):
    return {"login": login, "id": i, "avatar_url": "u", "type": "User"}


def test_stream_takes_each_page_once(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path), token_key="pepper"), DATASETS["github_members"]

    def take(checkpoint):
        stream_dataset(w, d, str(tmp_path / checkpoint), AS_OF).awaitTermination()

    def got():
        return {(r["login"], r["id"]) for r in w.table(d.name).read().collect()}

    land(spark, w, d.name, [[member("a", 1), member("b", 2)]])
    take("c1")
    land(spark, w, d.name, [[member("b", 3), member("c", 4)]], seq=9)
    take("c1")
    take("c1")
    assert got() == {("a", 1), ("b", 3), ("c", 4)}
    take("c2")  # all pages again, as after a lost checkpoint
    assert got() == {("a", 1), ("b", 3), ("c", 4)}
    assert w.ops.known().first()["last_success_at"] == AS_OF
    assert {r["status"] for r in w.ops.runs().collect()} == {"success"}


def test_stream_tokenizes_guards_and_keeps_watermarks(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path), token_key="pepper")
    d = Dataset("people", (Field("email", sensitive=True, nullable=False), Field("seen", "timestamptz")), ("email",), records="rows", incremental="seen", guarded=True)
    land(spark, w, d.name, [{"rows": [{"email": "a@b.example", "seen": "2024-01-02 00:00:00"}]}], tenant="acme")
    land(spark, w, d.name, [{"rows": [{"email": "a@b.example", "seen": "2024-01-03 00:00:00"}, {"email": "c", "seen": "2024-01-01 00:00:00"}]}], seq=9, tenant="other")
    stream_dataset(w, d, str(tmp_path / "c1"), AS_OF).awaitTermination()
    rows = w.table(d.name).read().collect()
    assert len(rows) == 2 and all(len(r["email"]) == 18 and "@" not in r["email"] for r in rows)
    for folder, _, names in os.walk(tmp_path / "tables"):
        assert all(b"a@b.example" not in open(os.path.join(folder, n), "rb").read() for n in names)
    assert w.ops.marks(d.name, "acme")["forward_watermark"] == datetime(2024, 1, 2) and w.ops.marks(d.name, "other")["forward_watermark"] == datetime(2024, 1, 3)
    assert w.ops.marks(d.name, "acme")["backward_watermark"] is None  # a stream only goes forward
    land(spark, w, d.name, [{"errors": [{"message": "slow down"}]}], seq=20)
    query = stream_dataset(w, d, str(tmp_path / "c1"), AS_OF)
    with pytest.raises(Exception, match="slow down"):
        query.awaitTermination()
    assert "failed" in {r["status"] for r in w.ops.runs().collect()} and w.table(d.name).read().count() == 2


def test_upserts_on_tokens_meet_their_rows(spark, tmp_path):
    d = Dataset("people", (Field("email", sensitive=True, nullable=False), Field("n", "bigint")), ("email",))
    w = Warehouse(spark, str(tmp_path), token_key="pepper")
    land(spark, w, "people", [[{"email": "a", "n": 1}, {"email": "b", "n": 2}]])
    run_dataset(w, d, as_of=AS_OF)
    land(spark, w, "people", [[{"email": "a", "n": 5}]], seq=7)
    run_dataset(w, d, as_of=AS_OF)
    run_dataset(w, d, as_of=AS_OF)
    assert sorted(r["n"] for r in w.table("people").read().collect()) == [2, 5]


def test_a_tenants_run_leaves_other_tenants_rows(spark, tmp_path):
    d = Dataset("flows", (Field("id", "bigint", nullable=False), Field("name")), ("id",), load="replace")
    w = Warehouse(spark, str(tmp_path))
    land(spark, w, "flows", [[{"id": 1, "name": "a1"}, {"id": 2, "name": "a2"}]], tenant="acme")
    land(spark, w, "flows", [[{"id": 3, "name": "o3"}]], tenant="other")
    for tenant in ("acme", "other"):
        run_dataset(w, d, tenant=tenant, as_of=AS_OF)

    def got():
        return {(r["id"], r["name"]) for r in w.table("flows").read().collect()}

    assert got() == {(1, "a1"), (2, "a2"), (3, "o3")}
    before = {f["path"] for f in w.table("flows").current()["files"]}
    land(spark, w, "flows", [[{"id": 2, "name": "o2"}]], seq=5, tenant="other")  # a key that moves to the other tenant
    run_dataset(w, d, tenant="other", as_of=AS_OF)
    assert got() == {(1, "a1"), (2, "o2"), (3, "o3")}
    run_dataset(w, d, tenant="other", as_of=AS_OF)
    assert got() == {(1, "a1"), (2, "o2"), (3, "o3")} and not before & {f["path"] for f in w.table("flows").current()["files"]}
    run_dataset(w, d, as_of=AS_OF)  # of all tenants: everything anew
    assert got() == {(1, "a1"), (2, "o2"), (3, "o3")} or got() == {(1, "a1"), (2, "a2"), (3, "o3")}


def test_upserts_rewrite_only_the_files_that_hold_their_keys(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"))
    t.commit(spark.range(0, 6000, 1, 60).selectExpr("id", "'a' AS v"))  # sixty files of a hundred keys
    before = {f["path"] for f in t.current()["files"]}
    new = spark.createDataFrame([(k, "b") for k in range(50, 6050, 200)], "id bigint, v string")
    assert promote(new, t, ["id"], "upsert").rows_loaded == 30
    after = {f["path"] for f in t.current()["files"]}
    assert len(before) == 60 and len(before & after) == 30
    assert t.read().count() == 6000 and t.read().where("v = 'b'").count() == 30
    after = {f["path"] for f in t.current()["files"]}
    promote(spark.createDataFrame([(10_000, "c")], "id bigint, v string"), t, ["id"], "upsert")
    assert len(after & {f["path"] for f in t.current()["files"]}) == len(after)  # a new key touches no file


def test_an_upsert_shuffles_new_rows_once_and_the_target_never(spark, tmp_path):
    """The plans of all jobs of an upsert, by their exchanges of rows."""
    t = Snapshots(spark, str(tmp_path / "t"))
    t.commit(spark.range(0, 1000, 1, 4).selectExpr("id", "'a' AS v"))
    staged = spark.range(0, 100, 1, 3).selectExpr("id * 7 AS id", "'b' AS v", "id AS _seq", "0 AS _pos")
    from tidemill.operators.dedup import last_landed

    def exchanges(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]

    assert len(exchanges(last_landed(staged, ["id"]))) == 1
    new = t.put(last_landed(staged, ["id"]).select("id", "v"))
    schema, files = t.schema_of(t.current()), t.current()["files"]
    keys = t.keys_of(new, schema, ["id"])
    assert not exchanges(t.frame(files, schema).join(keys, ["id"], "left_anti"))
    assert "BroadcastHashJoin" in t.frame(files, schema).join(keys, ["id"], "left_anti")._jdf.queryExecution().executedPlan().toString()


def test_two_writers(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"))
    t.commit(spark.createDataFrame([(1,)], "id int"))
    base = t.current()
    t.commit(spark.createDataFrame([(2,)], "id int"), append=True)
    with pytest.raises(ConcurrentCommit):
        t.commit(spark.createDataFrame([(3,)], "id int"), base=base)
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]


def test_small_files_are_merged_and_old_ones_removed(spark, tmp_path, monkeypatch):
    from tidemill.sources import snapshots

    monkeypatch.setattr(snapshots, "MANY", 4)
    t = Snapshots(spark, str(tmp_path / "t"))
    for k in range(7):
        t.commit(spark.createDataFrame([(k,)], "id int").coalesce(1), append=True)
    t.publish(t.current(), t.current()["files"], t.schema_of(t.current()), marks={"stream:x": 3})
    held = t.current()
    assert t.compact() and len(t.current()["files"]) < 5 and not t.compact()
    assert t.current()["marks"] == {"stream:x": 3}
    assert sorted(r["id"] for r in t.read(held).collect()) == list(range(7)) == sorted(r["id"] for r in t.read().collect())
    assert t.vacuum(keep=1) == 0  # nothing is old enough
    assert t.vacuum(keep=1, older_than_hours=-1) == 7 and len(t.versions()) == 1
    assert sorted(r["id"] for r in t.read().collect()) == list(range(7))


def test_ops_tables_stay_small(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["github_members"]
    land(spark, w, d.name, [[member("a", 1)]])
    for _ in range(3):
        run_dataset(w, d, tenant="acme", as_of=AS_OF)
    assert w.ops.history.read().count() == 3  # a row each run
    assert len(w.ops.registry.versions()) <= 5


def test_children_come_from_their_parents(spark, tmp_path):
    w, repos, branches = Warehouse(spark, str(tmp_path)), DATASETS["github_repos"], DATASETS["github_branches"]
    for key in ("acme/a", "ACME/b", "other/c"):
        land(spark, w, branches.name, [[{"name": "main", "protected": True, "commit": {"sha": "s"}}]], key=key)
    with pytest.raises(CheckFailed, match="never loaded"):
        run_dataset(w, branches, tenant="acme", as_of=AS_OF)
    land(spark, w, repos.name, [[repo("acme/a"), repo("ACME/b"), repo("other/c")]])
    run_dataset(w, repos, tenant="acme", as_of=AS_OF)
    run_dataset(w, branches, tenant="acme", as_of=AS_OF)
    assert sorted(r["repo_full_name"] for r in w.table(branches.name).read().collect()) == ["ACME/b", "acme/a"]
    run_dataset(w, branches, tenant="acme", as_of=AS_OF, max_entities=1)
    assert [r["repo_full_name"] for r in w.table(branches.name).read().collect()] == ["ACME/b"]


def repo(full_name):
    return dict.fromkeys(DATASETS["github_repos"].columns, None) | {"id": abs(hash(full_name)), "full_name": full_name, "name": "n", "owner": {"login": "o"}}


def test_deployments_warn_of_names_without_a_slash_and_cut_descriptions(spark, tmp_path):
    w, repos, d = Warehouse(spark, str(tmp_path)), DATASETS["github_repos"], DATASETS["github_deployments"]
    land(spark, w, repos.name, [[repo("acme/a"), repo("nameless")]])
    run_dataset(w, repos, as_of=AS_OF)
    node = {"databaseId": 1, "environment": "prod", "description": "x" * 4001, "state": "ok", "createdAt": "2024-05-01T00:00:00Z", "updatedAt": "2024-05-02T00:00:00Z", "creator": {"login": "c"}, "commit": {"oid": "c"}, "latestStatus": {"state": "s"}}
    land(spark, w, d.name, [{"data": {"repository": {"deployments": {"nodes": [node]}}}}], key={"owner": "acme", "name": "a"})
    got = run_dataset(w, d, "full", as_of=AS_OF)
    assert got.rows_loaded == 1 and any("1 rows of github_repos name no entity" in x for x in got.warnings) and any("description cut in the middle; such as (1, 'acme')" in x for x in got.warnings)
    land(spark, w, d.name, [{"errors": [{"message": "rate limit"}]}], seq=8, key={"owner": "acme", "name": "a"})
    with pytest.raises(Exception, match="rate limit"):
        run_dataset(w, d, "full", as_of=AS_OF)
    assert w.table(d.name).read().count() == 1


def test_too_long_values_fail_the_run(spark, tmp_path):
    w, incidents = Warehouse(spark, str(tmp_path)), DATASETS["servicenow_incidents"]
    assert sum(bool(d.max_lengths) for d in DATASETS.values()) >= 28
    land(spark, w, incidents.name, [{"result": [incident(1, "2024-01-01 10:00:00", number="N" * 41)]}])
    with pytest.raises(CheckFailed, match="column number: 1 values over 40 characters, the longest 41"):
        run_dataset(w, incidents, "full", "acme", AS_OF)


@pytest.mark.parametrize(("total", "outcome"), [(2, ()), (1, ()), (None, ()), (3, "fail")])
def test_completeness_of_projects(spark, tmp_path, total, outcome):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["sonarqube_projects"]
    land(spark, w, d.name, [{"paging": {"total": total}, "components": [{"key": k, "name": k, "qualifier": "TRK"} for k in "ab"]}])
    if outcome == "fail":
        with pytest.raises(CheckFailed, match="2 of 3 announced"):
            run_dataset(w, d, as_of=AS_OF)
        assert run_dataset(w, d, as_of=AS_OF, max_pages=5).rows_loaded == 2  # a part is meant to be a part
    else:
        assert run_dataset(w, d, as_of=AS_OF).warnings == outcome


def test_a_small_shortfall_warns(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["sonarqube_projects"]
    land(spark, w, d.name, [{"paging": {"total": 40}, "components": [{"key": f"k{i}", "name": "n", "qualifier": "TRK"} for i in range(39)]}])
    assert run_dataset(w, d, as_of=AS_OF).warnings == ("39 of 40 announced rows came (2.5% short)",)


def test_few_rows_and_stale_sources_warn(spark, tmp_path):
    w, incidents = Warehouse(spark, str(tmp_path)), DATASETS["servicenow_incidents"]
    land(spark, w, incidents.name, [{"result": [incident(i, "2024-01-01 10:00:00") for i in range(10)]}])
    run_dataset(w, incidents, "full", "acme", datetime(2024, 5, 1))
    land(spark, w, incidents.name, [{"result": [incident(3, "2024-02-01 10:00:00")]}], seq=4)
    got = run_dataset(w, incidents, "forward", "acme", datetime(2024, 5, 2), start=datetime(2024, 1, 15), end=datetime(2024, 5, 2))
    assert "1 rows, where the last runs had 10 on average" in got.warnings
    got = run_dataset(w, DATASETS["incident_summary"], as_of=AS_OF)
    assert got.warnings[0].startswith("source servicenow_incidents was last loaded at 2024-05-02")
    history = w.table("sonarqube_measures_history")
    history.create_if_missing(DATASETS["sonarqube_measures_history"].schema)
    with pytest.raises(CheckFailed, match="nothing is kept as first_seen:weeks beside sonarqube_measures_history"):
        run_dataset(w, DATASETS["sonarqube_adoption_trend"], as_of=AS_OF)
    with pytest.raises(CheckFailed, match="0 rows"):
        run_dataset(w, ADOPTION_TREND_SQL, as_of=AS_OF)


def test_a_crashed_run_is_carried_on(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    taken = []

    class Killed(BaseException):
        pass

    def watching(rows, context):
        taken.append(rows.count())
        if len(taken) == 3:
            raise Killed
        return rows

    d = Dataset("units", (Field("id", "bigint", nullable=False), Field("k", key="*")), ("id",), transform=watching)
    for k in range(20):
        land(spark, w, "units", [[{"id": k}, {"id": 100 + k}]], seq=k, key=f"e{k}")
    with pytest.raises(Killed):
        run_dataset(w, d, as_of=AS_OF, slices=4)
    assert not w.table("units").exists() and sum(taken[:2]) > 0
    before = len(taken)
    done = run_dataset(w, d, as_of=AS_OF, slices=4, resume=True)
    assert w.table("units").read().count() == 40 == done.rows_loaded
    assert sum(taken[before:]) + sum(taken[:2]) == 40  # what was staged isn't taken again
    assert [r["status"] for r in w.ops.runs().collect()] == ["success"]
