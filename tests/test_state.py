"""What lasts between runs and streams: ledgers of pages, marks of streams, counts kept beside tables; and other ways in and out."""

import gzip
import json
import os
import random
from datetime import date, datetime
from unittest import mock

import pytest
from pyspark.sql import functions as F

from tidemill.catalog import DATASETS
from tidemill.catalog.marts import ADOPTION_TREND_SQL, INCIDENT_SUMMARY_SQL, daily_counts
from tidemill.functions.calendar import first_seen_trend, trend_of_weeks
from tidemill.functions.ordering import numbered, running_total
from tidemill.operators.kept import Counts, FirstSeen
from tidemill.operators.promote import audit_unique, promote, promote_to_catalog
from tidemill.operators.quality import MaxLength, NotNull, Oversized, RowCount, Unparseable, run_checks
from tidemill.plans.run import CheckFailed, Warehouse, run_dataset
from tidemill.sources.pages import SCHEMA, land, raw_pages, read_pages, read_raw, stream_raw
from tidemill.sources.snapshots import CatalogTable, Snapshots
from tidemill.spec import Dataset, Field
from tidemill.streaming.ingest import stream_dataset, take_batch

AS_OF = datetime(2024, 6, 1)
PEOPLE = Dataset("people", (Field("id", "bigint", nullable=False), Field("name"), Field("seen", "timestamptz")), ("id",), incremental="seen", mode="forward")


def person(i, name="n", seen="2024-01-01 00:00:00"):
    return {"id": i, "name": name, "seen": seen}


def put(spark, w, bodies, seq=0, tenant="acme", day=date(2024, 5, 1), name="people", key=None):
    rows = [(name, tenant, json.dumps(key), i + 1, datetime(2024, 5, 1), seq + i, b if isinstance(b, str) else json.dumps(b), None) for i, b in enumerate(bodies)]
    land(spark.createDataFrame(rows, SCHEMA), w.pages, day)


def names(w, table="people"):
    return {r["id"]: r["name"] for r in w.table(table).read().collect()}


# ---- pruned landing and ledger -------------------------------------------------------------------------------------


def test_conditions_on_pages_choose_folders(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1)]])
    put(spark, w, [[person(2)]], name="others", tenant="")
    plan = read_pages(spark, w.pages, "people", "acme", since=date(2024, 5, 1))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "dataset" in filters and "tenant" in filters and "day" in filters
    assert read_pages(spark, w.pages, "others", "").count() == 1 and read_pages(spark, w.pages, "people", since=date(2024, 5, 2)).count() == 0


def test_a_forward_run_parses_new_pages_only(spark, tmp_path, monkeypatch):
    from tidemill.plans import run

    w, parsed = Warehouse(spark, str(tmp_path)), []

    class Watching(run.PageWatch):
        @property
        def corrupt(self):
            parsed.append(self.n_pages)
            return super().corrupt

    monkeypatch.setattr(run, "PageWatch", Watching)
    put(spark, w, [[person(i)] for i in range(5)])
    run_dataset(w, PEOPLE, "full", "acme", AS_OF)
    put(spark, w, [[person(7)], [person(1, "later")]], seq=50, day=date(2024, 5, 3))
    run_dataset(w, PEOPLE, "forward", "acme", AS_OF)
    assert parsed == [5, 2] and names(w)[1] == "later" and len(names(w)) == 6
    assert w.table("people").current()["marks"]["since:acme"] == "2024-05-03"
    again = run_dataset(w, PEOPLE, "forward", "acme", AS_OF)
    assert parsed == [5, 2] and again.promoted and again.rows_loaded == 0  # nothing new: nothing parsed
    put(spark, w, [[person(8)]], seq=60, day=date(2024, 5, 3))  # on a day that was seen already
    run_dataset(w, PEOPLE, "forward", "acme", AS_OF)
    assert parsed == [5, 2, 1] and 8 in names(w)
    assert w.table("people").read_side("ledger").count() == 8


def test_pages_that_were_not_taken_whole_come_again(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1)], [person(2, seen="2024-07-01 00:00:00")]])
    run_dataset(w, PEOPLE, "full", "acme", AS_OF, max_pages=1)
    assert set(names(w)) == {1} and w.table("people").current()["marks"]["since:acme"] == "2024-05-01"
    put(spark, w, [[person(3)]], seq=9, day=date(2024, 5, 9))
    run_dataset(w, PEOPLE, "forward", "acme", AS_OF)  # page 2 is of a day after this run's present
    assert set(names(w)) == {1, 3}
    run_dataset(w, PEOPLE, "forward", "acme", datetime(2024, 8, 1))
    assert set(names(w)) == {1, 2, 3}


def test_children_whose_parents_come_later_are_taken_later(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    parents = Dataset("parents", (Field("key", nullable=False),), ("key",))
    child = Dataset("kids", (*PEOPLE.fields, Field("parent", key="*")), ("id",), incremental="seen", mode="forward", parent="parents", parent_key={"*": "key"})
    put(spark, w, [[{"key": "a"}]], name="parents")
    run_dataset(w, parents, "full", "acme", AS_OF)
    put(spark, w, [[person(1)]], name="kids", key="a", day=date(2024, 5, 1))
    put(spark, w, [[person(2)]], name="kids", key="b", day=date(2024, 5, 2), seq=4)
    put(spark, w, [[person(3)]], name="kids", key="a", day=date(2024, 5, 3), seq=5)
    run_dataset(w, child, "full", "acme", AS_OF)
    assert set(names(w, "kids")) == {1, 3} and w.table("kids").current()["marks"]["since:acme"] == "2024-05-02"
    put(spark, w, [[{"key": "b"}]], name="parents", seq=7)
    run_dataset(w, parents, "full", "acme", AS_OF)
    run_dataset(w, child, "forward", "acme", AS_OF)
    assert set(names(w, "kids")) == {1, 2, 3} and w.table("kids").current()["marks"]["since:acme"] == "2024-05-03"


# ---- streams -------------------------------------------------------------------------------------------------------


def test_streams_of_two_tenants(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1, "a")]], tenant="acme")
    put(spark, w, [[person(2, "o")]], tenant="other", seq=3)
    for tenant in ("acme", "other"):
        stream_dataset(w, PEOPLE, str(tmp_path / tenant), AS_OF, tenant).awaitTermination()
    assert names(w) == {1: "a", 2: "o"}
    assert sum(m.startswith("stream:") for m in w.table("people").current()["marks"]) == 2


def test_a_new_checkpoint_takes_what_is_new(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1, "old")]])
    stream_dataset(w, PEOPLE, str(tmp_path / "c1"), AS_OF).awaitTermination()
    put(spark, w, [[person(1, "new")]], seq=5)
    run_dataset(w, PEOPLE, "forward", "acme", AS_OF)
    put(spark, w, [[person(2, "fresh")]], seq=9)
    stream_dataset(w, PEOPLE, str(tmp_path / "c2"), AS_OF).awaitTermination()  # its batch 0 holds all pages
    assert names(w) == {1: "new", 2: "fresh"}


def test_a_replay_after_a_run_undoes_nothing(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1, "old")]])
    first = read_pages(spark, w.pages, "people")
    take_batch(w, PEOPLE, first, "s", 0, AS_OF)
    put(spark, w, [[person(1, "new"), person(2)]], seq=5)
    run_dataset(w, PEOPLE, "forward", "acme", AS_OF)
    w.table("people").compact()
    version = w.table("people").current()["version"]
    take_batch(w, PEOPLE, first, "s", 0, AS_OF)
    assert names(w) == {1: "new", 2: "n"} and w.table("people").current()["version"] == version


def test_a_stream_of_children_follows_the_rule_of_runs(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["github_branches"]
    put(spark, w, [[{"name": "main", "protected": True, "commit": {"sha": "s"}}]], name=d.name, key="acme/a")
    query = stream_dataset(w, d, str(tmp_path / "c"), AS_OF)
    with pytest.raises(Exception, match="never loaded"):
        query.awaitTermination()
    assert not w.table(d.name).exists()


def test_a_stream_reads_its_datasets_folders(spark, tmp_path):
    from tidemill.streaming.ingest import stream_pages

    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1)]])
    put(spark, w, [["other"]], name="others")
    query = stream_pages(w, PEOPLE, "acme").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 1
    plan = query._jsq.explainInternal(False)
    assert "dataset" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]


# ---- what is kept beside tables ------------------------------------------------------------------------------------


def test_kept_counts_equal_the_full_audit(spark, tmp_path):
    r = random.Random(5)
    t, unique = Snapshots(spark, str(tmp_path / "t")), (("v",), ("v", "w"))
    kept = {"by_w": Counts(lambda rows: rows.select("w")), "first": FirstSeen("w", "at")}

    def rows(n, seq):
        made = [(r.randrange(40), r.choice(["", None, "a", "b", f"x{r.randrange(30)}"]), r.choice("pqr"), datetime(2024, 1, 1 + r.randrange(28), r.randrange(24)), seq, i) for i in range(n)]
        return spark.createDataFrame(made, "id int, v string, w string, at timestamp, _seq int, _pos int")

    steps = [("upsert", ""), ("upsert", ""), ("append", ""), ("replace", "acme"), ("upsert", ""), ("replace", "acme"), ("upsert", ""), ("replace", "")]
    for k, (strategy, tenant) in enumerate(steps):
        got = promote(rows(25, k), t, ["id"], strategy, tenant=tenant, unique=unique, kept=kept)
        now = t.read()
        assert got.warnings == audit_unique(now, unique), strategy
        assert sorted(map(tuple, t.read_side("by_w").collect())) == sorted(map(tuple, now.groupBy("w").count().collect()))
        assert sorted(map(tuple, t.read_side("first").collect())) == sorted(map(tuple, now.groupBy("w").agg(F.min("at")).collect()))
        as_of = "2024-02-20"
        assert sorted(map(tuple, trend_of_weeks(t.read_side("first:weeks"), as_of).collect())) == sorted(map(tuple, first_seen_trend(now, "w", "at", as_of).collect()))


def test_marts_read_what_is_kept(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["servicenow_incidents"]

    def incident(i, at, priority):
        return dict.fromkeys(d.columns, "x") | {"sys_id": f"i{i}", "number": f"N{i}", "opened_at": at, "closed_at": "", "sys_updated_on": at, "priority": priority}

    def summaries():
        run_dataset(w, DATASETS["incident_summary"], as_of=AS_OF)
        run_dataset(w, INCIDENT_SUMMARY_SQL, as_of=AS_OF)
        kept, text = (sorted(map(tuple, w.table(n).read().collect())) for n in ("incident_summary", "incident_summary_sql"))
        full = daily_counts(w.table(d.name).read(), "opened_at", "priority", "state")
        assert kept == text == sorted(map(tuple, full.collect()))
        return kept

    put(spark, w, [{"result": [incident(1, "2024-01-01 10:00:00", "1"), incident(2, "2024-01-02 10:00:00", None)]}], name=d.name)
    run_dataset(w, d, "full", "acme", AS_OF)
    assert len(summaries()) == 2
    put(spark, w, [{"result": [incident(2, "2024-01-03 10:00:00", "1"), incident(3, "2024-01-03 10:00:00", "1"), incident(4, "", "1")]}], name=d.name, seq=7)
    run_dataset(w, d, "full", "acme", AS_OF)
    assert [(str(r[0]), r[3]) for r in summaries()] == [("2024-01-01", 1), ("2024-01-03", 2)]


# ---- order without one task ----------------------------------------------------------------------------------------


def test_running_totals_and_numbers_by_ranges(spark):
    r = random.Random(8)
    rows = [(k, r.choice([None, *range(9)])) for k in r.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    total, want = 0, []
    for k, v in sorted(rows):
        total += v or 0
        want.append((k, v, total))
    got = running_total(df, "k", "v", "total", parts=7)
    assert sorted(map(tuple, got.collect())) == want
    assert "SinglePartition" not in got.select("k", "total")._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    same = numbered(df.withColumn("g", F.lit(1)), [F.col("g")], parts=5).collect()  # one key alone
    assert sorted(x["place"] for x in same) == list(range(1, 701))
    assert running_total(df.limit(0), "k", "v", "total").count() == 0


# ---- violations ----------------------------------------------------------------------------------------------------


def test_violations_are_written_where_checks_are_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, "x" * 5, "soon"), (1, None, "2024-01-01"), (None, "y", None), (2, "ok", None)], "id int, s string, d string")
    checks = [RowCount(5), NotNull(("id", "gone")), MaxLength({"s": 4, "gone": 1}), Oversized(4), Unparseable("d")]
    report, plain = run_checks(df, checks, str(tmp_path / "v")), run_checks(df, checks)
    assert (report.failures, report.warnings) == (plain.failures, plain.warnings) and plain.violations is None
    assert {(r["id"], r["s"]): r["_broken"] for r in report.violations.collect()} == {(1, "x" * 5): ["long:s", "oversized:s", "unread:d"], (1, None): ["oversized:d"], (None, "y"): ["null:id"]}
    w = Warehouse(spark, str(tmp_path))
    put(spark, w, [[person(1), {"id": None, "name": "bad", "seen": None}]])
    with pytest.raises(CheckFailed, match="id: 1 nulls"):
        run_dataset(w, PEOPLE, "full", "acme", AS_OF)
    folder = next((tmp_path / "violations").iterdir())
    assert [r["name"] for r in spark.read.parquet(str(folder)).collect()] == ["bad"]


# ---- raw files -----------------------------------------------------------------------------------------------------


def test_raw_files_give_the_rows_of_pages(spark, tmp_path):
    raw = tmp_path / "raw"
    for key in ("acme", "b c"):
        (raw / key).mkdir(parents=True)
    (raw / "acme" / "page-1.json").write_text(json.dumps([person(1, "é"), person(2)]))
    with gzip.open(raw / "acme" / "page-2.json.gz", "wt") as f:
        f.write(json.dumps([person(3)]))
    (raw / "b c" / "page-1.json").write_text(json.dumps([person(4)], indent=1))
    (raw / "b c" / "page-7.json").write_bytes(b"\xff\xfe no json")
    d = Dataset("people", (*PEOPLE.fields, Field("owner", key="*")), ("id",), incremental="seen", mode="forward")
    how = {"dataset": "people", "tenant": "acme", "key_of": r"raw/([^/]+)/"}
    pages = raw_pages(read_raw(spark, str(raw)), **how)
    assert sorted((r["page"], r["entity_key"]) for r in pages.collect()) == [(1, '"acme"'), (1, '"b c"'), (2, '"acme"'), (7, '"b c"')]
    composite = raw_pages(read_raw(spark, str(raw)), "people", "acme", key_of={"owner": r"raw/([^/]+)/", "n": r"page-(\d+)"}).collect()
    assert {json.loads(r["entity_key"])["n"] for r in composite} == {"1", "2", "7"}
    w = Warehouse(spark, str(tmp_path / "w"))
    pages.write.partitionBy("dataset", "tenant", "day").parquet(w.pages)
    got = run_dataset(w, d, "full", "acme", AS_OF)
    assert "1 bodies are not JSON" in got.warnings
    want = {(1, "é", "acme"), (2, "n", "acme"), (3, "n", "acme"), (4, "n", "b c")}
    assert {(r["id"], r["name"], r["owner"]) for r in w.table("people").read().collect()} == want
    streamed = Warehouse(spark, str(tmp_path / "s"))
    stream_dataset(streamed, d, str(tmp_path / "c"), AS_OF, pages=raw_pages(stream_raw(spark, str(raw)), **how)).awaitTermination()
    assert {(r["id"], r["name"], r["owner"]) for r in streamed.table("people").read().collect()} == want


# ---- catalogs and text ---------------------------------------------------------------------------------------------


def test_catalog_tables_merge_themselves(spark):
    """What is asked of a catalog; there is none with row-level changes here."""
    rows = spark.createDataFrame([(1, "a", 1, 0), (1, "b", 2, 0)], "id int, v string, _seq int, _pos int")
    table = CatalogTable(spark, "cat.db.people")
    with mock.patch("pyspark.sql.classic.dataframe.DataFrame.mergeInto") as merge:
        promote_to_catalog(rows, table, ["id"], "upsert")
    name, same = merge.call_args.args
    assert name == "cat.db.people" and "cat.db.people.id" in str(same) and "_new.id" in str(same)
    with mock.patch("pyspark.sql.classic.dataframe.DataFrame.writeTo") as write:
        promote_to_catalog(rows, table, ["id"], "append")
        promote_to_catalog(rows, table, ["id"], "replace", "tenant", "acme")
    assert write.return_value.append.called and "acme" in str(write.return_value.overwrite.call_args.args[0])
    with pytest.raises(Exception, match="cat"):
        promote_to_catalog(rows, table, ["id"], "upsert")


def test_the_trend_as_text(spark, tmp_path):
    w, d = Warehouse(spark, str(tmp_path)), DATASETS["sonarqube_measures_history"]
    rows = [(f"p{k % 7}", datetime(2024, 1, 1 + k)) for k in range(25)] + [("late", datetime(2024, 7, 1))]
    frame = spark.createDataFrame(rows, "project_key string, analysis_date timestamp")
    promote(frame, w.table(d.name), ["project_key", "analysis_date"], "upsert", kept=d.kept)
    for mart in (DATASETS["sonarqube_adoption_trend"], ADOPTION_TREND_SQL):
        run_dataset(w, mart, as_of=AS_OF)
    kept, text = (sorted(map(tuple, w.table(n).read().collect())) for n in ("sonarqube_adoption_trend", ADOPTION_TREND_SQL.name))
    assert kept == text and len(kept) > 15 and kept[-1][2] == 7
