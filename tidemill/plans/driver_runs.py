"""Registered queries of whole runs: the given tables become landed pages, datasets are run over them, and what the runs leave
behind is returned."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import DATASETS
from tidemill.catalog.marts import ADOPTION_TREND_SQL, INCIDENT_SUMMARY_SQL
from tidemill.operators import promote as pm
from tidemill.operators import quality as qa
from tidemill.operators.tokens import tokenize
from tidemill.plans.driver import _CHANGED, _TREND, NTZ, Tables, _changed, _hmac, _labelled, query
from tidemill.plans.run import CheckFailed, Warehouse, run_dataset
from tidemill.sources.checkpoints import shared_folder
from tidemill.sources.pages import BadPages, land, raw_pages, read_pages, read_raw
from tidemill.sources.snapshots import Snapshots
from tidemill.spec import Dataset, Field
from tidemill.streaming.ingest import stream_dataset, take_batch

AS_OF = datetime(2030, 1, 1)
#: Records in a raw file.
RAW_RECORDS = 5_000


def _warehouse(t: Tables, **more) -> Warehouse:
    return Warehouse(t.spark, shared_folder(t.spark), token_key="pepper", **more)


def _land(w: Warehouse, dataset: str, pages: DataFrame, day: date = date(2024, 1, 1)) -> None:
    """``pages``: ``body`` and, where they have them, ``tenant``, ``entity_key`` and ``seq``."""
    columns = {"dataset": F.lit(dataset), "tenant": F.lit(""), "entity_key": F.lit("null"), "page": F.lit(1), "fetched_at": F.lit(AS_OF).cast("timestamp"), "seq": F.lit(0).cast("bigint")}
    land(pages.select(*(F.col(n) if n in pages.columns else c.alias(n) for n, c in columns.items()), "body"), w.pages, day)


def _bodies(rows: DataFrame, record: Column, inside: str | None, *by: str, size: int = 200) -> DataFrame:
    """Pages of about ``size`` records, however many rows there are, ``by`` kept; ``inside``: the name under which a body holds its
    records, if not at the top."""
    page = F.pmod(F.xxhash64(record), F.lit(1 + rows.count() // size)).alias("_page")
    made = rows.select(*by, page, record.alias("_record")).groupBy(*by, "_page").agg(F.collect_list("_record").alias("_records"))
    body = F.to_json(F.struct(F.col("_records").alias(inside)), {"ignoreNullFields": "false"}) if inside else F.to_json("_records", {"ignoreNullFields": "false"})
    return made.select(*by, F.col("_page").cast("bigint").alias("seq"), body.alias("body"))


def _text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def _incident(state: Column) -> Column:
    filler = [F.lit("x").alias(n) for n in ("short_description", "description", "severity", "category", "assigned_to", "assignment_group")]
    return F.struct(
        F.col("o_orderkey").cast("string").alias("sys_id"), F.concat(F.lit("INC"), "o_orderkey").alias("number"), state.alias("state"), F.col("o_orderpriority").alias("priority"),
        _text("o_orderdate").alias("opened_at"), F.lit("").alias("closed_at"), _text("o_orderdate").alias("sys_updated_on"), *filler,
    )


def _incidents_run(t: Tables) -> Warehouse:
    w = _warehouse(t)
    _land(w, "servicenow_incidents", _bodies(t.orders, _incident(F.col("o_orderstatus")), "result"))
    run_dataset(w, DATASETS["servicenow_incidents"], "full", as_of=AS_OF)
    return w


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, 'INC' || o_orderkey AS number, o_orderstatus AS state, o_orderpriority AS priority, o_orderdate AS opened_at, CAST(NULL AS TIMESTAMP) AS closed_at, o_orderdate AS sys_updated_on FROM orders""")
def run_incidents(t):
    rows = _incidents_run(t).table("servicenow_incidents").read()
    return rows.select("sys_id", "number", "state", "priority", *(F.col(c).cast(NTZ).alias(c) for c in ("opened_at", "closed_at", "sys_updated_on")))


@query("""SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderpriority AS priority, o_orderstatus AS state, CAST(count(*) AS INTEGER) AS incident_count FROM orders GROUP BY 1, 2, 3""")
def run_incident_summary(t):
    w = _incidents_run(t)
    run_dataset(w, DATASETS["incident_summary"], as_of=AS_OF)
    return w.table("incident_summary").read()


def _two_waves(t: Tables) -> Warehouse:
    """Half of the orders in a full run; then all of them, changed, in a forward run, which takes those from the watermark on."""
    w, incidents = _warehouse(t), DATASETS["servicenow_incidents"]
    _land(w, incidents.name, _bodies(t.orders.where("o_orderkey % 2 = 0"), _incident(F.lit("first")), "result"))
    run_dataset(w, incidents, "full", as_of=AS_OF)
    _land(w, incidents.name, _bodies(t.orders, _incident(F.lit("second")), "result").withColumn("seq", F.col("seq") + 1_000_000), date(2024, 1, 2))
    run_dataset(w, incidents, "forward", as_of=AS_OF)
    return w


_MARK = "(SELECT max(o_orderdate) AS m FROM orders WHERE o_orderkey % 2 = 0)"


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, CASE WHEN o_orderdate >= m THEN 'second' ELSE 'first' END AS state FROM orders, {_MARK} WHERE o_orderkey % 2 = 0 OR o_orderdate >= m""")
def run_forward(t):
    return _two_waves(t).table("servicenow_incidents").read().select("sys_id", "state")


@query(f"""SELECT 'servicenow_incidents' AS dataset, '' AS tenant, (SELECT max(o_orderdate) FROM orders) AS forward_watermark, (SELECT min(o_orderdate) FROM orders WHERE o_orderkey % 2 = 0) AS backward_watermark,
'upsert' AS load_strategy, TIMESTAMP '2030-01-01' AS last_success_at, CAST(2 AS BIGINT) AS n_success, CAST((SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) + (SELECT count(*) FROM orders, {_MARK} WHERE o_orderdate >= m) AS BIGINT) AS rows_loaded""")
def run_state(t):
    """Coverage, registry and history after two runs."""
    ops = _two_waves(t).ops
    runs = ops.runs().where("status = 'success'").groupBy("dataset", "tenant").agg(F.count("*").alias("n_success"), F.sum("rows_loaded").cast("bigint").alias("rows_loaded"))
    both = ops.coverage.read().join(runs, ["dataset", "tenant"]).join(ops.known().select("dataset", "load_strategy", "last_success_at"), "dataset")
    marks = [F.col(c).cast(NTZ).alias(c) for c in ("forward_watermark", "backward_watermark", "last_success_at")]
    return both.select("dataset", "tenant", *marks, "load_strategy", "n_success", "rows_loaded")


@query("""SELECT 'servicenow_incidents' AS dataset, 'success' AS status, CAST(0 AS BIGINT) AS rows_loaded, false AS loaded, 'one of each key: ' || count(DISTINCT o_orderkey) AS said FROM orders""")
def run_dry(t):
    """All steps but promotion: nothing is loaded, no watermark and no success is kept."""
    w = _warehouse(t)
    _land(w, "servicenow_incidents", _bodies(t.orders, _incident(F.col("o_orderstatus")), "result"))
    run_dataset(w, DATASETS["servicenow_incidents"], "full", as_of=AS_OF, dry_run=True)
    loaded = w.table("servicenow_incidents").exists() or w.ops.coverage.exists() or not w.ops.known().where("last_success_at IS NOT NULL").isEmpty()
    keys = t.orders.agg(F.concat(F.lit("one of each key: "), F.count_distinct("o_orderkey")).alias("said"))
    return w.ops.runs().select("dataset", "status", "rows_loaded", F.lit(loaded).alias("loaded")).join(keys)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, o_orderstatus AS state, 'success' AS status FROM orders""")
def run_resumed(t):
    """A run that breaks off after two of four slices is carried on from its ledger."""
    w, incidents, stop = _warehouse(t), DATASETS["servicenow_incidents"], {"left": 2}
    pages = _bodies(t.orders, _incident(F.col("o_orderstatus")), "result").withColumn("entity_key", F.to_json(F.struct("seq")))
    _land(w, incidents.name, pages)

    class Killed(BaseException):
        pass

    def breaking(rows: DataFrame, context) -> DataFrame:
        stop["left"] -= 1
        if stop["left"] < 0:
            raise Killed
        return rows

    try:
        run_dataset(w, _with(incidents, transform=breaking), "full", as_of=AS_OF, slices=4)
    except Killed:
        run_dataset(w, incidents, "full", as_of=AS_OF, slices=4, resume=True)
    status = w.ops.runs().groupBy().agg(F.array_join(F.sort_array(F.collect_set("status")), ",").alias("status"))
    return w.table(incidents.name).read().select("sys_id", "state").join(status)


def _with(dataset, **changes):
    from dataclasses import replace

    return replace(dataset, **changes)


def _repo(tenant: Column) -> Column:
    name = F.concat(F.lit("r"), "c_custkey")
    return F.struct(
        F.col("c_custkey").alias("id"), F.concat(tenant, F.lit("/"), name).alias("full_name"), name.alias("name"), F.when(F.col("c_custkey") % 3 != 0, F.struct(F.col("c_mktsegment").alias("login"))).alias("owner"),
        *(F.lit(False).alias(n) for n in ("private", "archived")), *(F.lit("x").alias(n) for n in ("description", "language", "default_branch", "html_url")), *(F.lit("2024-01-02T03:04:05Z").alias(n) for n in ("created_at", "updated_at", "pushed_at")),
    )


_OWNER = "CASE WHEN c_custkey % 2 = 0 THEN 'acme' ELSE 'other' END"


@query(f"""SELECT c_custkey * 10 + k AS id, {_OWNER} || '/r' || c_custkey AS repo_full_name, CASE WHEN c_custkey % 2 = 0 THEN 'again' ELSE 'once' END AS name
FROM customer, (SELECT unnest([1, 2]) AS k) WHERE c_custkey % 2 = 1 OR k = 1""")
def run_tenants(t):
    """A table that is replaced tenant by tenant, as children of another one: a tenant's second run leaves the other's rows."""
    w, repos, flows = _warehouse(t), DATASETS["github_repos"], DATASETS["github_workflows"]
    tenant = F.when(F.col("c_custkey") % 2 == 0, "acme").otherwise("other")
    _land(w, repos.name, _bodies(t.customer.withColumn("tenant", tenant), _repo(tenant), None, "tenant"))

    def flow(k: Column, name: str) -> Column:
        return F.struct((F.col("c_custkey") * 10 + k).alias("id"), F.lit(name).alias("name"), F.lit("p").alias("path"), F.lit("active").alias("state"), *(F.lit("2024-01-02T03:04:05Z").alias(n) for n in ("created_at", "updated_at")))

    def pages(rows: DataFrame, name: str, *numbers: int) -> DataFrame:
        held = F.to_json(F.struct(F.array(*(flow(F.lit(k), name) for k in numbers)).alias("workflows")))
        return rows.select(tenant.alias("tenant"), F.to_json(F.array(F.concat(tenant, F.lit("/r"), "c_custkey"))).alias("entity_key"), F.lit(len(numbers)).cast("bigint").alias("seq"), held.alias("body")).withColumn("entity_key", F.regexp_extract("entity_key", r"^\[(.*)\]$", 1))

    for name in ("acme", "other"):
        run_dataset(w, repos, tenant=name, as_of=AS_OF)
    _land(w, flows.name, pages(t.customer, "once", 1, 2))
    for name in ("acme", "other"):
        run_dataset(w, flows, tenant=name, as_of=AS_OF)
    second = Warehouse(t.spark, w.root + "/second")  # the tenant's pages as they are later
    _land(second, flows.name, pages(t.customer.where("c_custkey % 2 = 0"), "again", 1))
    again = Relanded(t.spark, w.root, later=second.pages)
    run_dataset(again, flows, tenant="acme", as_of=AS_OF)
    return w.table(flows.name).read().select("id", "repo_full_name", "name")


class Relanded(Warehouse):
    """A warehouse whose pages have been landed anew elsewhere."""

    def __init__(self, spark: SparkSession, root: str, later: str):
        super().__init__(spark, root)
        object.__setattr__(self, "_later", later)

    @property
    def pages(self) -> str:
        return self._later


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'P' || (o_custkey % 7) || '-' || o_orderkey AS key, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 5 > 0 THEN 'u' || o_custkey END AS assignee,
'P' || (o_custkey % 7) AS project_key, CASE WHEN o_orderkey % 3 > 0 THEN 'a,' || o_orderstatus END AS labels, o_orderdate AS updated FROM orders WHERE o_custkey % 7 < 5""")
def run_jira_issues(t):
    """Issues of the projects that there are, with null objects on the way and lists as text."""
    w, projects, issues = _warehouse(t), DATASETS["jira_projects"], DATASETS["jira_issues"]
    key = F.concat(F.lit("P"), F.col("o_custkey") % 7)
    known = t.orders.where("o_custkey % 7 < 5").select(key.alias("key")).distinct()
    project = F.struct(F.col("key").alias("id"), "key", F.col("key").alias("name"), F.lit("k").alias("projectTypeKey"), F.lit("s").alias("style"), F.lit(True).alias("isPrivate"))
    _land(w, projects.name, _bodies(known, project, "values"))
    run_dataset(w, projects, as_of=AS_OF)
    moment = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    fields = F.struct(
        F.lit("s").alias("summary"), F.when(F.col("o_orderkey") % 4 != 0, F.struct(F.col("o_orderstatus").alias("name"))).alias("status"), F.struct(F.lit("p").alias("name")).alias("priority"), F.struct(F.lit("Bug").alias("name")).alias("issuetype"),
        F.struct(key.alias("key")).alias("project"), F.when(F.col("o_orderkey") % 5 != 0, F.struct(F.concat(F.lit("u"), "o_custkey").alias("displayName"))).alias("assignee"), F.struct(F.lit("R").alias("displayName")).alias("reporter"),
        moment.alias("created"), moment.alias("updated"), F.lit(None).cast("string").alias("resolutiondate"), F.when(F.col("o_orderkey") % 3 != 0, F.array(F.lit("a"), F.col("o_orderstatus"))).otherwise(F.array().cast("array<string>")).alias("labels"),
    )
    issue = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.concat(key, F.lit("-"), "o_orderkey").alias("key"), fields.alias("fields"))
    pages = _bodies(t.orders.withColumn("entity_key", F.concat(F.lit('"'), key, F.lit('"'))), issue, "issues", "entity_key", size=20)
    _land(w, issues.name, pages)
    run_dataset(w, issues, "full", as_of=AS_OF)
    return w.table(issues.name).read().select("id", "key", "status", "assignee", "project_key", "labels", F.col("updated").cast(NTZ).alias("updated"))


@query("""SELECT 'u' || user_id AS project_key, 'main' AS branch, 'bugs' AS metric_key, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS analysis_date, CAST(event_id AS VARCHAR) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def run_measures_history(t):
    """Grandchildren of projects: two lists deep, one value a day, the last."""
    w, at = _warehouse(t), datetime(2024, 2, 1)
    project = F.concat(F.lit("u"), "user_id")
    known = t.events.select(project.alias("key")).distinct()
    total = known.count()
    one = known.select(F.to_json(F.struct(F.struct(F.lit(total).alias("total")).alias("paging"), F.array(F.struct("key", F.col("key").alias("name"), F.lit("TRK").alias("qualifier"))).alias("components"))).alias("body"))
    _land(w, "sonarqube_projects", one)
    run_dataset(w, DATASETS["sonarqube_projects"], as_of=at)
    branch = F.struct(F.lit("main").alias("name"), F.lit(True).alias("isMain"), F.lit("LONG").alias("type"), F.struct(F.lit("OK").alias("qualityGateStatus")).alias("status"), F.lit(False).alias("excludedFromPurge"))
    _land(w, "sonarqube_branches", known.select(F.concat(F.lit('"'), "key", F.lit('"')).alias("entity_key"), F.to_json(F.struct(F.array(branch).alias("branches"))).alias("body")))
    run_dataset(w, DATASETS["sonarqube_branches"], as_of=at)
    value = F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0000'").alias("date"), F.col("event_id").cast("string").alias("value"))
    lists = t.events.groupBy("user_id").agg(F.sort_array(F.collect_list(value)).alias("history"))
    body = F.to_json(F.struct(F.array(F.struct(F.lit("bugs").alias("metric"), "history"), F.struct(F.lit("unknown").alias("metric"), "history")).alias("measures")))
    _land(w, "sonarqube_measures_history", lists.select(F.to_json(F.struct(project.alias("project_key"), F.lit("main").alias("branch"))).alias("entity_key"), body.alias("body")))
    run_dataset(w, DATASETS["sonarqube_measures_history"], "full", as_of=at)
    return w.table("sonarqube_measures_history").read().select("project_key", "branch", "metric_key", F.col("analysis_date").cast(NTZ).alias("analysis_date"), "value")


@query(f"SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM {_CHANGED}) UNION ALL SELECT * FROM {_CHANGED}")
def promote_pipeline(t):
    """A table, then an upsert into it, twice: files, versions and contract as in a run."""
    table = Snapshots(t.spark, shared_folder(t.spark))
    for rows in (t.customer, _changed(t), _changed(t)):
        pm.promote(rows, table, ["c_custkey"], "upsert")
    return table.read()


@query(f"SELECT {_hmac('c_name')} AS c_name, c_acctbal + 1 AS c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY c_custkey DESC) = 1")
def upsert_on_tokens(t):
    """A key that is a token: what is upserted again meets its own rows."""
    table = Snapshots(t.spark, shared_folder(t.spark))
    rows = t.customer.select("c_name", "c_acctbal", F.col("c_custkey").cast("bigint").alias("_seq"), F.lit(0).alias("_pos"))
    pm.promote(tokenize(rows, ["c_name"], "pepper"), table, ["c_name"], "upsert")
    pm.promote(tokenize(rows.withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_name"], "pepper"), table, ["c_name"], "upsert")
    return table.read()


@query("""SELECT 'keys missing in records: title (title) in ' || count(*) || ', first at 0' AS said, CAST(1 AS BIGINT) AS n_failed, false AS loaded FROM orders""")
def run_refused(t):
    """Records that lack a declared key fail the run; nothing is loaded."""
    w, repos, pulls = _warehouse(t), DATASETS["github_repos"], DATASETS["github_pull_requests"]
    owner = F.lit("acme")
    _land(w, repos.name, _bodies(t.customer.where("c_custkey = 1").withColumn("tenant", owner), _repo(owner), None, "tenant"))
    run_dataset(w, repos, tenant="acme", as_of=AS_OF)
    ref = F.struct(F.lit("r").alias("ref"))
    pull = F.struct(F.col("o_orderkey").alias("id"), F.lit(1).alias("number"), F.lit("open").alias("state"), F.lit(None).cast("string").alias("user"), *(F.lit("2024-01-02T03:04:05Z").alias(n) for n in ("created_at", "updated_at", "closed_at", "merged_at")), F.lit(False).alias("draft"), ref.alias("head"), F.struct(F.lit("b").alias("ref"), F.lit(None).cast("string").alias("repo")).alias("base"), F.lit("u").alias("html_url"))
    pages = _bodies(t.orders.withColumns({"tenant": owner, "entity_key": F.lit('"acme/r1"')}), pull, None, "tenant", "entity_key")
    first = pages.agg(F.min("seq").alias("_first"))  # one row; no page moves for it
    _land(w, pulls.name, pages.crossJoin(F.broadcast(first)).withColumn("seq", F.col("seq") - F.col("_first")))
    try:
        run_dataset(w, pulls, "full", "acme", as_of=AS_OF)
        said = "nothing"
    except CheckFailed as error:
        said = str(error)
    failed = w.ops.runs().where("status = 'failed'").groupBy().agg(F.count("*").alias("n_failed"))
    return failed.select(F.lit(said).alias("said"), "n_failed", F.lit(w.table(pulls.name).exists()).alias("loaded"))


# ---- streams, ledgers and what is kept -----------------------------------------------------------------------------


def _by_state(t: Tables, state: Column | None = None) -> DataFrame:
    """Incident pages of each order status, as a tenant's."""
    rows = t.orders.withColumn("tenant", F.col("o_orderstatus"))
    return _bodies(rows, _incident(F.col("o_orderstatus") if state is None else state), "result", "tenant")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, o_orderstatus AS state, CAST((SELECT count(DISTINCT o_orderstatus) FROM orders) AS BIGINT) AS n_streams FROM orders""")
def stream_tenants(t):
    """A stream for each tenant, each with its own checkpoint, into one table."""
    w, d = _warehouse(t), DATASETS["servicenow_incidents"]
    _land(w, d.name, _by_state(t))
    for tenant in sorted(r[0] for r in t.orders.select("o_orderstatus").distinct().collect()):
        stream_dataset(w, d, f"{w.root}/streams/{tenant}", AS_OF, tenant).awaitTermination()
    table = w.table(d.name)
    streams = sum(m.startswith("stream:") for m in table.current()["marks"])
    return table.read().select("sys_id", "state", F.lit(streams).cast("bigint").alias("n_streams"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, CASE WHEN o_orderkey % 3 = 0 THEN 'third' WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS state FROM orders""")
def stream_replayed(t):
    """A batch, then a run over newer pages, then the batch again, then a new checkpoint with more: rows stay as the newest pages have them."""
    w, d = _warehouse(t), DATASETS["servicenow_incidents"]
    _land(w, d.name, _bodies(t.orders, _incident(F.lit("first")), "result"))
    first = read_pages(t.spark, w.pages, d.name)
    take_batch(w, d, first, "one", 0, AS_OF)
    _land(w, d.name, _bodies(t.orders.where("o_orderkey % 2 = 0"), _incident(F.lit("second")), "result").withColumn("seq", F.col("seq") + 1_000_000), date(2024, 1, 2))
    run_dataset(w, d, "forward", as_of=AS_OF, start=datetime(1990, 1, 1), end=AS_OF)
    take_batch(w, d, first, "one", 0, AS_OF)
    _land(w, d.name, _bodies(t.orders.where("o_orderkey % 3 = 0"), _incident(F.lit("third")), "result").withColumn("seq", F.col("seq") + 2_000_000), date(2024, 1, 3))
    stream_dataset(w, d, f"{w.root}/streams/two", AS_OF).awaitTermination()
    return w.table(d.name).read().select("sys_id", "state")


@query(f"""SELECT 'forward' AS mode, CAST(count(*) AS BIGINT) AS rows_loaded, CAST(0 AS BIGINT) AS again FROM orders, {_MARK} WHERE o_orderdate >= m""")
def run_new_pages(t):
    """What a forward run loads of pages that its ledger doesn't have; and a second one, without any."""
    w = _two_waves(t)
    again = run_dataset(w, DATASETS["servicenow_incidents"], "forward", as_of=AS_OF)
    return w.ops.runs().where("mode = 'forward' AND rows_loaded > 0").select("mode", "rows_loaded", F.lit(again.rows_loaded).cast("bigint").alias("again"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, CAST(0 AS BIGINT) AS n_later FROM orders WHERE o_orderkey % 10 < 3
UNION ALL SELECT 'later', CAST(count(*) AS BIGINT) FROM orders WHERE o_orderkey % 10 >= 3""")
def run_max_pages(t):
    """A trial of the first three pages; a forward run then takes the others, which the ledger doesn't have."""
    w, d = _warehouse(t), DATASETS["servicenow_incidents"]
    rows = t.orders.withColumn("page", (F.col("o_orderkey") % 10 + 1).cast("int")).withColumn("o_orderdate", F.lit(datetime(2024, 1, 1)))
    _land(w, d.name, _bodies(rows, _incident(F.col("o_orderstatus")), "result", "page"))
    run_dataset(w, d, "full", as_of=AS_OF, max_pages=3)
    first = w.table(d.name).read().select("sys_id", F.lit(0).cast("bigint").alias("n_later"))
    later = run_dataset(w, d, "forward", as_of=AS_OF)
    return first.unionByName(first.sparkSession.createDataFrame([("later", later.rows_loaded)], "sys_id string, n_later bigint"))


_DAILY = "SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderpriority AS priority, {state} AS state, CAST(count(*) AS INTEGER) AS incident_count FROM orders{where} GROUP BY 1, 2, 3"


@query(f"""WITH changed AS (SELECT *, CASE WHEN o_orderdate >= m THEN 'second' ELSE 'first' END AS st FROM orders, {_MARK} WHERE o_orderkey % 2 = 0 OR o_orderdate >= m)
SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderpriority AS priority, st AS state, CAST(count(*) AS INTEGER) AS incident_count FROM changed GROUP BY 1, 2, 3""")
def mart_after_increment(t):
    """The summary from the counts that two runs kept, the second of which replaced rows of the first."""
    w = _two_waves(t)
    run_dataset(w, DATASETS["incident_summary"], as_of=AS_OF)
    return w.table("incident_summary").read()


@query(_DAILY.format(state="o_orderstatus", where=""))
def mart_as_text(t):
    w = _incidents_run(t)
    run_dataset(w, INCIDENT_SUMMARY_SQL, as_of=AS_OF)
    return w.table(INCIDENT_SUMMARY_SQL.name).read()


_SEEN = _TREND.format(who="user_id", ts="ts", table="events", as_of="2024-03-01", more="")


def _seen(t: Tables) -> Warehouse:
    """The moments of each user, in three increments of the table that the trend is made from."""
    w, d = _warehouse(t), DATASETS["sonarqube_measures_history"]
    rows = t.events.select(F.concat(F.lit("u"), "user_id").alias("project_key"), F.col("ts").cast("timestamp").alias("analysis_date"), "event_id")
    for k in range(3):
        pm.promote(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == k), w.table(d.name), ["project_key", "analysis_date", "event_id"], "upsert", kept=d.kept)
    return w


def _trend(w: Warehouse, mart) -> DataFrame:
    run_dataset(w, mart, as_of=datetime(2024, 3, 1))
    return w.table(mart.name).read().toDF("week_start_date", "new_entities", "cumulative_entities")


@query(_SEEN)
def trend_after_increments(t):
    return _trend(_seen(t), DATASETS["sonarqube_adoption_trend"])


@query(_SEEN)
def trend_as_text(t):
    return _trend(_seen(t), ADOPTION_TREND_SQL)


@query("""SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 997 = 0) AS n_changed, true AS few_files FROM orders""")
def upsert_by_file(t):
    """A few keys into a table whose files are sorted by key: no more files are rewritten than there are keys."""
    table = Snapshots(t.spark, shared_folder(t.spark))
    table.commit(t.orders.select("o_orderkey", "o_orderstatus").repartitionByRange(40, "o_orderkey"))
    before = {f["path"] for f in table.current()["files"]}
    new = t.orders.where("o_orderkey % 997 = 0").select("o_orderkey", F.lit("changed").alias("o_orderstatus"))
    done = pm.promote(new, table, ["o_orderkey"], "upsert")
    gone = len(before - {f["path"] for f in table.current()["files"]})
    return table.read().agg(F.count("*").alias("n_rows"), F.count_if(F.col("o_orderstatus") == "changed").alias("n_changed"), F.lit(gone <= done.rows_loaded).alias("few_files"))


@query("""SELECT c_mktsegment AS segment, n AS n_rows FROM (SELECT c_mktsegment, count(*) AS n FROM (SELECT coalesce(CASE WHEN c.c_custkey % 3 = 0 THEN CASE WHEN c.c_custkey % 2 = 0 THEN c_mktsegment END ELSE c_mktsegment END, NULL) AS c_mktsegment FROM customer c
UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1) WHERE c_mktsegment IS NOT NULL AND n > 1""")
def audit_after_upsert(t):
    """The groups of equal values of a unique set, from the counts that two upserts kept."""
    table = Snapshots(t.spark, shared_folder(t.spark))
    for rows in (t.customer, _changed(t)):
        pm.promote(rows, table, ["c_custkey"], "upsert", unique=(("c_mktsegment",),))
    return table.read_side(pm.side_name(("c_mktsegment",))).where("n > 1").select(F.col("c_mktsegment").alias("segment"), F.col("n").alias("n_rows"))


# ---- vault, violations, raw files, guards --------------------------------------------------------------------------


def _vault(values: list[str]) -> list[str]:
    return [f"t-{v[::-1]}" for v in values]


@query("""SELECT c_custkey AS id, 't-' || reverse(c_name) AS name, 't-' || reverse(c_mktsegment) AS segment, CAST((SELECT count(DISTINCT c_name) + count(DISTINCT c_mktsegment) FROM customer) AS BIGINT) AS n_known FROM customer""")
def run_vault(t):
    """Names and segments as a vault's tokens; two runs, of which the second asks for nothing."""
    d = Dataset("people", (Field("id", "bigint", nullable=False), Field("name", sensitive=True), Field("segment", sensitive=True)), ("id",))
    w = _warehouse(t, vault=_vault)
    _land(w, d.name, _bodies(t.customer, F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), None))
    for _ in range(2):
        run_dataset(w, d, as_of=AS_OF)
    known = w.tokens.read().agg(F.count("*").alias("n_known"))
    return w.table(d.name).read().join(known)


@query("""SELECT doc_id, '[' || array_to_string(list_filter([CASE WHEN quality IS NULL THEN 'null:quality' END, CASE WHEN length(text) > 2000 THEN 'long:text' END, CASE WHEN length(text) > 10000 THEN 'oversized:text' END], lambda x: x IS NOT NULL), ', ') || ']' AS broken
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR length(text) > 2000""")
def violations(t):
    """The documents that break a check, written in the pass that counts them."""
    checks = [qa.RowCount(1), qa.NotNull(("doc_id", "quality")), qa.MaxLength({"text": 2000}), qa.Oversized()]
    report = qa.run_checks(_labelled(t).select("doc_id", "text", "quality"), checks, f"{shared_folder(t.spark)}/violations")
    return report.violations.select("doc_id", F.concat(F.lit("["), F.array_join("_broken", ", "), F.lit("]")).alias("broken"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS sys_id, o_orderstatus AS state, o_orderdate AS opened_at FROM orders""")
def raw_files(t):
    """Bodies as files, a folder each page, instead of a table of pages."""
    w, d = _warehouse(t), DATASETS["servicenow_incidents"]
    raw = f"{w.root}/raw"
    # Two megabytes a file: what a file costs beside its bytes, on the driver too, stays small.
    _bodies(t.orders, _incident(F.col("o_orderstatus")), "result", size=RAW_RECORDS).select(F.col("seq").alias("page"), "body").repartition("page").write.partitionBy("page").text(raw)
    raw_pages(read_raw(t.spark, raw), d.name, "", page_of=r"page=([0-9]+)/").write.partitionBy("dataset", "tenant", "day").parquet(w.pages)
    run_dataset(w, d, "full", as_of=AS_OF)
    return w.table(d.name).read().select("sys_id", "state", F.col("opened_at").cast(NTZ).alias("opened_at"))


@query("""SELECT count(*) || ' bad pages; the first: slow down ' || min(c_custkey) AS said FROM customer WHERE c_custkey % 50 = 7""")
def guarded_pages(t):
    """Error envelopes among pages fail the run, with their number and the first message."""
    w = _warehouse(t)
    d = Dataset("nodes", (Field("id", "bigint", nullable=False),), ("id",), "rows", guarded=True)
    error = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("slow down "), "c_custkey").alias("message"))).alias("errors")))
    good = F.to_json(F.struct(F.array(F.struct(F.col("c_custkey").alias("id"))).alias("rows")))
    _land(w, d.name, t.customer.select(F.col("c_custkey").cast("bigint").alias("seq"), F.when(F.col("c_custkey") % 50 == 7, error).otherwise(good).alias("body")))
    try:
        run_dataset(w, d, as_of=AS_OF)
        said = "nothing"
    except BadPages as problem:
        said = str(problem)
    return w.ops.runs().where("status = 'failed'").select(F.lit(said).alias("said"))
