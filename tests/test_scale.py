"""What must not grow faster than the input: tasks, files, and how often a record is gone through."""

import json

from pyspark.sql import functions as F

from tidemill.catalog import DATASETS
from tidemill.operators import normalize as nm
from tidemill.plans import driver_runs as dr
from tidemill.plans.driver import Tables
from tidemill.sources.pages import at, explode_records
from tidemill.spec import Field

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _pages(spark, bodies):
    rows = [("", "null", 1, k, body) for k, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "tenant string, entity_key string, page int, seq bigint, body string").withColumn("fetched_at", F.lit(None).cast("timestamp"))


def test_refused_pages_are_not_dealt_by_their_tenant(spark, monkeypatch):
    """all pages have one tenant, so a window over it was one task with every body."""
    plans, land = [], dr._land
    monkeypatch.setattr(dr, "_land", lambda w, name, pages, *day: (plans.append(_plan(pages)), land(w, name, pages, *day)))
    assert dr.run_refused(Tables(spark, SMALL)).first()["n_failed"] == 1
    assert len(plans) == 2 and not any("Window" in p for p in plans)


def test_raw_files_are_few(spark, monkeypatch):
    """a file for each 200 orders, each in a folder of its own, took the driver longer than the run."""
    seen, read = [], dr.read_raw
    monkeypatch.setattr(dr, "read_raw", lambda s, path: (seen.append(read(s, path).count()), read(s, path))[1])
    t = Tables(spark, LARGER)
    assert dr.raw_files(t).count() == t.orders.count()
    assert 1 < seen[0] <= 1 + t.orders.count() // dr.RAW_RECORDS


def test_an_object_is_opened_once_for_all_its_fields(spark):
    """each field went through the record, and through the objects on its way, several times."""
    d = DATASETS["jira_issues"]
    rows = nm.normalize(explode_records(_pages(spark, ['{"issues": []}']), "issues"), d.fields, watch="updated")
    assert _plan(rows).count("try_variant_get(record#") == 1


def test_what_is_opened_is_what_paths_give(spark):
    """Odd records: lacking, null and wrong objects on the way, lists and objects as values, names that differ by case only."""
    odd = [
        {}, {"a": None}, {"a": 3}, {"a": []}, {"a": {}}, {"a": {"b": None, "c": "x"}}, {"a": {"b": {"d": 1.5, "D": "large"}, "c": [1, "y", None]}}, {"a": {"b": "text", "c": {"e": [True]}}},
        {"A": {"c": "z"}, "e": ""}, {"a": {"c": []}, "A": {"c": "both"}, "e": ["f", 1]}, {"a": {"b": {"d": ""}}, "e": {"z": 1}}, [1], "s", None, 7,
    ]
    paths = ["a", "a.b", "a.c", "a.b.d", "a.b.D", "A.c", "e", "a.c.e", "gone.deep"]
    records = explode_records(_pages(spark, [json.dumps(odd)]), "")
    made, look = nm.opened(records, set(paths))

    def told(lookup):
        return [x.cast("string") for p in paths for x in (F.to_json(lookup(p)), F.is_variant_null(lookup(p)), nm.is_absent(lookup, p))]

    got = made.select("pos", *(x.alias(f"c{i}") for i, x in enumerate(told(look)))).orderBy("pos").collect()
    want = records.select("pos", *(x.alias(f"c{i}") for i, x in enumerate(told(lambda p: at(F.col("record"), p))))).orderBy("pos").collect()
    assert len(got) == len(odd) and got == want


def test_fields_of_odd_records(spark):
    fields = (Field("b", path="a.b", on_null_parent="none"), Field("c", path="a.c", form="joined"), Field("j", path="a.c", form="json"), Field("k", path="a", form="json", only=("b", "x")), Field("e", fallback=("a.b.d",)))
    bodies = [{"a": {"b": {"d": 2}, "c": ["p", "q"]}, "e": None}, {"a": None}, {"a": {"b": True, "c": []}, "e": [1]}, {}]
    rows = nm.normalize(explode_records(_pages(spark, [json.dumps(bodies)]), ""), fields).orderBy("_pos").collect()
    assert [tuple(r)[:5] for r in rows] == [('{"d":2}', "p,q", '["p","q"]', '{"b":{"d":2}}', "2"), ("none", None, None, None, None), ("true", None, None, '{"b":true}', "[1]"), (None, None, None, None, None)]
    assert [r["_absent"] for r in rows] == [[], [], [], ["b", "c", "j"]]
