"""The registered queries: each operator of the library on the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.marts import daily_counts
from tidemill.functions import calendar as cal
from tidemill.functions import coerce as co
from tidemill.functions import ordering
from tidemill.operators import dedup as dd
from tidemill.operators import incremental as inc
from tidemill.operators import normalize as nm
from tidemill.operators import promote as pm
from tidemill.operators import quality as qa
from tidemill.operators.tokens import token, tokenize
from tidemill.sources.checkpoints import shared_folder
from tidemill.sources.pages import at, explode_records, unnest
from tidemill.sources.snapshots import Snapshots
from tidemill.spec import Field

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
NTZ = "timestamp_ntz"


class Tables:
    """The tables of a folder, read when named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _queries[make.__name__] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql:
            _sql[make.__name__] = sql
        return make

    return add


def queries() -> dict[str, Query]:
    from tidemill.plans import driver_catalog, driver_runs  # register whole runs

    assert driver_catalog and driver_runs
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_sql)


# ---- marts and calendars -------------------------------------------------------------------------------------------

_TREND = """
WITH first AS (SELECT {who} AS who, CAST(date_trunc('week', min({ts})) AS DATE) AS wk FROM {table} WHERE {ts} <= TIMESTAMP '{as_of}' {more} GROUP BY {who}),
weekly AS (SELECT wk, count(*) AS n FROM first WHERE wk <= CAST(date_trunc('week', DATE '{as_of}' - 7) AS DATE) GROUP BY wk),
spine AS (SELECT CAST(unnest(generate_series(CAST(min(wk) AS TIMESTAMP), CAST(greatest(max(wk), CAST(date_trunc('week', DATE '{as_of}' - 7) AS DATE)) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS wk FROM weekly)
SELECT s.wk AS week_start_date, CAST(coalesce(n, 0) AS BIGINT) AS new_entities, CAST(sum(coalesce(n, 0)) OVER (ORDER BY s.wk) AS BIGINT) AS cumulative_entities
FROM spine s LEFT JOIN weekly w ON w.wk = s.wk
"""


@query(_TREND.format(who="user_id", ts="ts", table="events", as_of="2024-03-01", more=""))
def adoption_trend(t):
    return cal.first_seen_trend(t.events, "user_id", "ts", "2024-03-01")


@query(_TREND.format(who="user_id", ts="ts", table="events", as_of="2024-01-20", more="AND event_type = 'purchase'"))
def adoption_trend_purchases(t):
    return cal.first_seen_trend(t.events.where("event_type = 'purchase'"), "user_id", "ts", "2024-01-20")


@query(_TREND.format(who="o_custkey", ts="o_orderdate", table="orders", as_of="1998-06-10", more=""))
def customer_onboarding(t):
    return cal.first_seen_trend(t.orders, "o_custkey", "o_orderdate", "1998-06-10")


@query("""SELECT CAST(o_orderdate AS DATE) AS report_date, coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknown') AS priority, coalesce(o_orderstatus, 'Unknown') AS state, CAST(count(*) AS INTEGER) AS row_count
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, 3""")
def daily_summary(t):
    rows = t.orders.select("o_orderdate", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), F.col("o_orderstatus").alias("state"))
    return daily_counts(rows, "o_orderdate", "priority", "state")


@query("""SELECT o_orderpriority, count(*) AS n_lines, round(avg((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9), 6) AS avg_hours, avg((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9) > 1000 AS slow
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def resolve_hours(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hours = co.hours_between(F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp"))
    out = both.groupBy("o_orderpriority").agg(F.count("*").alias("n_lines"), F.round(F.avg(hours), 6).alias("avg_hours"))
    return out.withColumn("slow", F.col("avg_hours") > 1000)


@query("""SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, CAST(o_orderdate AS DATE) + 30 AS due, CAST(o_orderdate AS DATE) - 7 AS week_before, CAST(o_orderkey % 1000 AS BIGINT) AS short_key FROM orders""")
def week_functions(t):
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", cal.week_start(F.col("o_orderdate")).alias("week_start"), cal.add_days(day, 30).alias("due"), cal.add_days(day, -7).alias("week_before"), (F.col("o_orderkey") % 1000).cast("bigint").alias("short_key"))


@query("""SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 7 DAY)) AS DATE) AS day FROM orders""")
def calendar_spine(t):
    return cal.calendar_spine(t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("first"), F.max("o_orderdate").cast("date").alias("last")))


@query("""SELECT event_id, user_id, CAST(sum(user_id) OVER (ORDER BY event_id) AS BIGINT) AS total FROM events""")
def running_total(t):
    """Over all events, in ranges of their ids."""
    return ordering.running_total(t.events.select("event_id", F.col("user_id").cast("bigint").alias("user_id")), "event_id", "user_id", "total")


@query("""SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week_start_date, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at, greatest(min(value), 5.0) AS floor_value FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1, 2""")
def weekly_counts(t):
    rows = inc.in_window(t.events, "ts", None, datetime(2024, 1, 20))
    return rows.groupBy("event_type", cal.week_start(F.col("ts")).alias("week_start_date")).agg(F.count("*").alias("n"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.greatest(F.min("value"), F.lit(5.0)).alias("floor_value"))


# ---- one row a key -------------------------------------------------------------------------------------------------

_LINE = "l_orderkey, l_linenumber"
_REST = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY {_LINE} ORDER BY {', '.join(c + ' DESC' for c in _REST)}) = 1")
def dedup_latest(t):
    return dd.dedup_latest(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in _REST])


@query("""SELECT user_id, event_type, day, event_id, value FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_daily_latest(t):
    rows = t.events.select("user_id", "event_type", "event_id", "value", F.to_date("ts").alias("day"), F.col("ts").cast("string").alias("raw"))
    return dd.daily_latest(rows, ["user_id", "event_type"], "raw", "day", [F.desc("event_id")]).drop("raw")


@query(f"SELECT {_LINE}, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n_rows DESC, {_LINE} LIMIT 3")
def dup_samples(t):
    return dd.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY {_LINE} HAVING count(*) > 1)")
def pk_unique(t):
    return qa.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT DISTINCT ON (user_id) user_id, event_id, event_type FROM events ORDER BY user_id, event_id DESC""")
def shard_dedup(t):
    shards = t.events.where("event_id % 3 <> 0").unionByName(t.events.where("event_id % 2 = 0")).unionByName(t.events)
    return dd.dedup_latest(shards.select("user_id", "event_id", "event_type"), ["user_id"], [F.desc("event_id")])


# ---- quality -------------------------------------------------------------------------------------------------------


def _labelled(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


_LABELLED = "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query("UNION ALL".join(f" SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(*) FILTER ({c} IS NULL) / count(*) AS null_rate FROM {_LABELLED} " for c in _COLUMNS))
def null_rates(t):
    return qa.null_rates(_labelled(t), _COLUMNS)


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (doc_id IS NULL) AS key_nulls, count(quality) = 0 AS quality_empty, count(toxic) = 0 AS toxic_empty, count(*) FILTER (quality IS NULL) / count(*) > 0.02 AS over_limit FROM {_LABELLED}""")
def pk_and_null_checks(t):
    got = qa.measured(_labelled(t), [qa.NotNull(("doc_id",)), qa.NotAllNull(("quality", "toxic")), qa.NullRate(exclude=("doc_id",))])
    return got.select(F.col("rows").alias("n_rows"), F.col("nulls:doc_id").alias("key_nulls"), (F.col("held:quality") == 0).alias("quality_empty"), (F.col("held:toxic") == 0).alias("toxic_empty"), (F.col("nulls:quality") / F.col("rows") > 0.02).alias("over_limit"))


@query("""SELECT lang, count(*) FILTER (length(text) > 2000) AS n_long, CAST(max(length(text)) AS BIGINT) AS longest, max(length(text)) > 10000 AS oversized FROM documents GROUP BY lang""")
def text_lengths(t):
    got = qa.measured(t.documents.select("lang", "text"), [qa.MaxLength({"text": 2000}), qa.Oversized(10_000)], "lang")
    return got.select("lang", F.col("long:text").alias("n_long"), F.col("longest:text").cast("bigint").alias("longest"), (F.col("longest:text") > 10_000).alias("oversized"))


_CHECKS = [qa.RowCount(1), qa.NotNull(("doc_id", "quality")), qa.NotAllNull(("lang", "toxic")), qa.MaxLength({"text": 20_000, "lang": 2}), qa.HasColumns(("doc_id", "missing"))]


@query(f"""SELECT name, found FROM (
SELECT 'rows' AS name, count(*) AS found FROM {_LABELLED} UNION ALL SELECT 'nulls:doc_id', count(*) FILTER (doc_id IS NULL) FROM {_LABELLED} UNION ALL SELECT 'nulls:quality', count(*) FILTER (quality IS NULL) FROM {_LABELLED}
UNION ALL SELECT 'held:lang', count(lang) FROM {_LABELLED} UNION ALL SELECT 'held:toxic', count(toxic) FROM {_LABELLED} UNION ALL SELECT 'long:text', count(*) FILTER (length(text) > 20000) FROM {_LABELLED}
UNION ALL SELECT 'long:lang', count(*) FILTER (length(lang) > 2) FROM {_LABELLED} UNION ALL SELECT 'longest:text', CAST(max(length(text)) AS BIGINT) FROM {_LABELLED} UNION ALL SELECT 'longest:lang', CAST(max(length(lang)) AS BIGINT) FROM {_LABELLED})""")
def composed_checks(t):
    got = qa.measured(_labelled(t), _CHECKS)
    return got.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("bigint").alias("found")) for n in got.columns))).alias("r")).select("r.*")


@query("""SELECT announced, collected, CASE WHEN announced > collected THEN (announced - collected) / announced ELSE 0 END AS shortfall, CASE WHEN (announced - collected) / announced > 0.05 THEN 'fail' WHEN announced > collected THEN 'warn' ELSE 'ok' END AS verdict
FROM (SELECT (SELECT count(*) FROM documents) AS announced, (SELECT count(DISTINCT doc_id) FROM labels) AS collected)""")
def completeness(t):
    return qa.completeness(t.labels, ["doc_id"], t.documents.agg(F.count("*").alias("announced")))


_RUNS = "SELECT event_type AS dataset, '' AS tenant, CAST(ts AS DATE) AS started_at, count(*) AS rows_loaded FROM events GROUP BY ALL"


def _runs(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("event_type").alias("dataset"), F.lit("").alias("tenant"), F.to_date("ts").alias("started_at")).agg(F.count("*").alias("rows_loaded"))


@query(f"""SELECT *, coalesce(rows_loaded < 0.5 * usual, false) AS anomalous FROM (SELECT *, avg(rows_loaded) OVER (PARTITION BY dataset, tenant ORDER BY started_at ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS usual FROM ({_RUNS}))""")
def row_count_anomaly(t):
    return qa.anomalies(_runs(t))


@query("""SELECT s.source, last_success_at FROM (SELECT DISTINCT o_orderpriority AS source FROM orders UNION SELECT 'never') s
LEFT JOIN (SELECT o_orderpriority, max(o_orderdate) AS last_success_at FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1) r ON r.o_orderpriority = s.source
WHERE last_success_at IS NULL OR last_success_at < TIMESTAMP '2001-08-02' - INTERVAL 24 HOUR""")
def source_freshness(t):
    registry = t.orders.where("o_orderstatus <> 'O'").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.max("o_orderdate").alias("last_success_at"))
    sources = t.orders.select(F.col("o_orderpriority").alias("source")).union(t.orders.select(F.lit("never"))).distinct()
    return qa.stale_sources(registry, sources, "2001-08-02")


@query("""SELECT event_type, count(*) FILTER (try_cast(x AS TIMESTAMP) IS NULL AND x IS NOT NULL) AS n_unread FROM (SELECT event_type, CASE WHEN event_id % 10 = 0 THEN 'soon' ELSE CAST(ts AS VARCHAR) END AS x FROM events) GROUP BY 1""")
def unparseable_dates(t):
    raw = t.events.select("event_type", F.when(F.col("event_id") % 10 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("x"))
    return qa.measured(raw, [qa.Unparseable("x")], "event_type").select("event_type", F.col("unread:x").alias("n_unread"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE role END AS role FROM conversations""")
def empty_to_null(t):
    raw = t.conversations.select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("role")).alias("role"))
    return qa.without_empty(raw, (("role",),))


# ---- promotion -----------------------------------------------------------------------------------------------------


def _changed(t: Tables) -> DataFrame:
    """Every third customer with other values, and as many new ones."""
    old = t.customer.where("c_custkey % 3 = 0").withColumns({"c_acctbal": F.col("c_acctbal") + 1, "c_mktsegment": F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))})
    return old.unionByName(old.withColumn("c_custkey", F.col("c_custkey") + 1_000_000))


_CHANGED = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal + 1, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END FROM customer WHERE c_custkey % 3 = 0)"""


@query(f"SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM {_CHANGED}) UNION ALL SELECT * FROM {_CHANGED}")
def promote_upsert(t):
    return pm.upserted(t.customer, _changed(t), ["c_custkey"])


def _promoted(t: Tables, *steps: tuple[DataFrame, str, str], keys: tuple[str, ...] = ("c_custkey",)) -> DataFrame:
    """A table after some promotions (rows, strategy, tenant)."""
    table = Snapshots(t.spark, shared_folder(t.spark))
    for rows, strategy, tenant in steps:
        pm.promote(rows, table, [*keys], strategy, tenant=tenant)
    return table.read()


@query(f"SELECT * FROM {_CHANGED}")
def promote_replace(t):
    return _promoted(t, (t.customer, "upsert", ""), (_changed(t), "replace", ""))


@query(f"SELECT * FROM customer UNION ALL SELECT * FROM {_CHANGED}")
def promote_append(t):
    return _promoted(t, (t.customer, "append", ""), (_changed(t), "append", ""))


@query(f"SELECT c_custkey FROM customer UNION SELECT c_custkey FROM {_CHANGED}")
def promote_insert_absent(t):
    """A table of keys alone: known ones come again to no effect."""
    return _promoted(t, (t.customer.select("c_custkey"), "upsert", ""), (_changed(t).select("c_custkey"), "upsert", ""))


@query(f"""SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT c_custkey FROM {_CHANGED} WHERE c_mktsegment = 'BUILDING') UNION ALL SELECT * FROM {_CHANGED} WHERE c_mktsegment = 'BUILDING'""")
def promote_tenant_replace(t):
    """A tenant's rows anew: those of others stay, but for keys that come again."""
    building = t.customer.where("c_mktsegment = 'BUILDING'")
    others = t.customer.where("c_mktsegment <> 'BUILDING'")
    return _promoted(t, (building, "replace", "BUILDING"), (others, "replace", "others"), (_changed(t).where("c_mktsegment = 'BUILDING'"), "replace", "BUILDING"))


_MORE = "s_suppkey + 1000000 AS s_suppkey, s_name, s_nationkey, s_acctbal"


def _more_suppliers(t: Tables) -> DataFrame:
    return t.supplier.withColumns({"s_suppkey": F.col("s_suppkey") + 1_000_000, "s_rating": (F.col("s_suppkey") % 5).cast("int")})


@query(f"SELECT *, CAST(NULL AS INTEGER) AS s_rating FROM supplier UNION ALL SELECT {_MORE}, CAST(s_suppkey % 5 AS INTEGER) FROM supplier")
def contract_evolve(t):
    rows, schema = pm.under_contract(_more_suppliers(t), t.supplier.schema, "evolve")
    return pm._as(t.supplier, schema).unionByName(rows)


@query(f"SELECT * FROM supplier UNION ALL SELECT {_MORE} FROM supplier")
def contract_discard(t):
    return t.supplier.unionByName(pm.under_contract(_more_suppliers(t), t.supplier.schema, "discard")[0])


# ---- increments ----------------------------------------------------------------------------------------------------


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts <= TIMESTAMP '2024-01-20'")
def incremental_window(t):
    start, end = inc.date_window("forward", {"forward_watermark": datetime(2024, 1, 10, 12)}, datetime(2024, 1, 20))
    return inc.in_window(t.events, "ts", start, end)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 720 DAY")
def lookback_window(t):
    return inc.in_window(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", datetime(1996, 1, 1), None, datetime(2001, 8, 1), 720)


@query("SELECT event_type AS dataset, min(ts) AS low, max(ts) AS high, CAST(0 AS BIGINT) AS n_unread FROM events GROUP BY 1")
def watermarks(t):
    marks = inc.watermarks(t.events.withColumnRenamed("event_type", "dataset"), "ts", "dataset")
    return marks.select("dataset", F.col("low").cast(NTZ).alias("low"), F.col("high").cast(NTZ).alias("high"), "n_unread")


@query("""WITH old AS (SELECT event_type AS dataset, '' AS tenant, max(ts) AS f, min(ts) AS b FROM events WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-15' AND ts > TIMESTAMP '2024-01-05' GROUP BY 1),
new AS (SELECT event_type AS dataset, '' AS tenant, max(ts) AS f, min(ts) AS b FROM events WHERE event_type <> 'click' GROUP BY 1)
SELECT coalesce(old.dataset, new.dataset) AS dataset, coalesce(old.tenant, new.tenant) AS tenant, greatest(old.f, new.f) AS forward_watermark, least(old.b, new.b) AS backward_watermark FROM old FULL JOIN new ON old.dataset = new.dataset""")
def coverage_merge(t):
    def marks(rows):
        return inc.watermarks(rows.select(F.col("event_type").alias("dataset"), F.lit("").alias("tenant"), "ts"), "ts", "dataset", "tenant")

    old = inc.coverage_update(marks(t.events.where("event_type <> 'error' AND ts < TIMESTAMP_NTZ '2024-01-15' AND ts > TIMESTAMP_NTZ '2024-01-05'")), "full")
    out = inc.merge_coverage(old, inc.coverage_update(marks(t.events.where("event_type <> 'click'")), "full"))
    return out.select("dataset", "tenant", F.col("forward_watermark").cast(NTZ).alias("forward_watermark"), F.col("backward_watermark").cast(NTZ).alias("backward_watermark"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING')")
def remaining_work(t):
    """Orders, without those of a segment, which are done."""
    done = t.orders.join(t.customer.where("c_mktsegment = 'BUILDING'"), F.col("c_custkey") == F.col("o_custkey"))
    return inc.remaining(t.orders.select("o_orderkey"), done.select("o_orderkey"), ["o_orderkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def parent_fan_out(t):
    keys = inc.entity_keys(t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    return inc.of_parents(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_custkey"])


@query("SELECT DISTINCT p_brand || '/' || p_name AS full_name FROM part WHERE lower(p_brand || '/' || p_name) LIKE 'brand#2/%'")
def tenant_prefix(t):
    return inc.entity_keys(t.part.select(F.concat_ws("/", "p_brand", "p_name").alias("full_name")), ["full_name"], "BRAND#2")


@query("SELECT n_nationkey, n_name, n_regionkey, r_name AS region FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 4")
def decode_labels(t):
    choices = t.region.where("r_regionkey < 4").select(F.lit("region").alias("element"), F.col("r_regionkey").alias("value"), F.col("r_name").alias("label"))
    return inc.decode(t.nation, "n_regionkey", choices, "region", "region")


@query("SELECT user_id, event_type, event_id FROM events WHERE user_id IS NOT NULL AND event_id % 4 <> 0")
def drop_null_keys(t):
    return inc.drop_null_keys(t.events.select("user_id", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("event_type"), "event_id"), ["user_id", "event_type"])


# ---- records -------------------------------------------------------------------------------------------------------


def _event_records(t: Tables) -> DataFrame:
    body = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"user":'), F.when(F.col("user_id") % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('{"login":"u'), F.col("user_id"), F.lit('"}'))), F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(',"props":'), F.col("props"))), F.lit("}"))
    pages = t.events.select(F.lit("").alias("tenant"), F.to_json(F.struct(F.col("event_type").alias("owner"), F.col("user_id").cast("string").alias("name"))).alias("entity_key"), F.lit(1).alias("page"), F.lit(None).cast("timestamp").alias("fetched_at"), F.col("event_id").alias("seq"), body.alias("body"))
    return explode_records(pages, None)


_FIELDS = (Field("id", "bigint"), Field("login", path="user.login", on_null_parent=""), Field("k", "integer", "props.k"), Field("owner", key="owner"), Field("entity", key="name"), Field("shown", path="props.none", fallback=("props.k", "id")))


@query("""SELECT event_id AS id, CASE WHEN user_id % 5 = 0 THEN '' ELSE 'u' || user_id END AS login, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, event_type AS owner, CAST(user_id AS VARCHAR) AS entity,
CASE WHEN event_id % 7 <> 0 AND json_extract_string(props, '$.k') IS NOT NULL THEN json_extract_string(props, '$.k') ELSE CAST(event_id AS VARCHAR) END AS shown FROM events""")
def field_map(t):
    return nm.normalize(_event_records(t), _FIELDS, ()).drop("_absent", "_unread")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.a.b') AS deep, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS twice FROM events""")
def json_get(t):
    v = F.try_parse_json("props")
    return t.events.select("event_id", at(v, "k", "string").alias("k"), at(v, "a.b", "string").alias("deep"), (at(v, "k", "bigint") * 2).alias("twice"))


@query("""SELECT column_name AS "column", path, n_missing, first_seq FROM (
SELECT 'k' AS column_name, 'props.k' AS path, count(*) AS n_missing, min(event_id) AS first_seq FROM events WHERE event_id % 7 = 0 OR NOT json_exists(props, '$.k') UNION ALL
SELECT 'gone', 'props.gone.deep', count(*), min(event_id) FROM events) WHERE n_missing > 0""")
def absent_keys(t):
    fields = (Field("id", "bigint"), Field("login", path="user.login"), Field("k", path="props.k"), Field("gone", path="props.gone.deep"), Field("line", path="line", optional=True))
    rows = nm.normalize(_event_records(t), fields, ("seq",)).select("_seq", F.explode("_absent").alias("column"))
    paths = F.create_map(*(F.lit(x) for f in fields for x in (f.name, f.source)))
    return rows.groupBy("column").agg(F.count("*").alias("n_missing"), F.min("_seq").alias("first_seq")).withColumn("path", F.element_at(paths, F.col("column")))


def _order_pages(t: Tables) -> DataFrame:
    """A page for each customer: its orders, each with its lines, as JSON."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("int").alias("q"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    orders = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_custkey", F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("lines").alias("lines")).alias("o"))
    bodies = orders.groupBy("o_custkey").agg(F.to_json(F.struct(F.struct(F.sort_array(F.collect_list("o")).alias("orders")).alias("data"))).alias("body"))
    return bodies.select(F.lit("").alias("tenant"), F.col("o_custkey").cast("string").alias("entity_key"), F.lit(1).alias("page"), F.lit(None).cast("timestamp").alias("fetched_at"), F.col("o_custkey").alias("seq"), "body")


@query("SELECT o_custkey AS cust, o_orderkey AS order_id, o_orderstatus AS status FROM orders")
def unnest_records(t):
    fields = (Field("cust", "bigint", key="*"), Field("order_id", "bigint", "id"), Field("status"))
    return nm.normalize(explode_records(_order_pages(t), "data.orders"), fields, ()).drop("_absent", "_unread")


@query("SELECT o_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, CAST(l_quantity AS INTEGER) AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def unnest_two_levels(t):
    orders = explode_records(_order_pages(t), "data.orders").select(at(F.col("record"), "id", "bigint").alias("order_id"), "record")
    lines = unnest(orders, "record", "lines", ["order_id"], "line_at")
    return lines.select("order_id", *(at(F.col("line_at"), p, k).alias(n) for n, p, k in (("line", "n", "int"), ("part", "part", "bigint"), ("q", "q", "int"))))


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS joined, '[' || string_agg('"' || event_type || '"', ',' ORDER BY event_type) || ']' AS packed FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1""")
def array_text(t):
    kinds = F.sort_array(F.collect_set("event_type"))
    return t.events.groupBy("user_id").agg(kinds.alias("kinds")).select("user_id", co.array_text(F.col("kinds")).alias("joined"), co.array_json(F.col("kinds")).alias("packed"))


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE '{' || CASE WHEN event_id % 2 = 0 THEN '' ELSE '"kind":"' || event_type || '"' || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',' END END || CASE WHEN event_id % 3 = 0 THEN '' ELSE '"user":' || user_id END || '}' END AS details FROM events""")
def json_repack(t):
    return t.events.select("event_id", co.repack(kind=F.when(F.col("event_id") % 2 != 0, F.col("event_type")), user=F.when(F.col("event_id") % 3 != 0, F.col("user_id"))).alias("details"))


@query("""SELECT c_custkey, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, TIMESTAMP '2024-05-01 00:00:00' AS collected_at FROM customer""")
def entity_key_injection(t):
    key = F.to_json(F.struct(F.col("c_mktsegment").alias("s"), F.col("c_nationkey").alias("n")))
    pages = t.customer.select(F.lit("").alias("tenant"), key.alias("entity_key"), F.lit(1).alias("page"), F.lit(None).cast("timestamp").alias("fetched_at"), F.lit(0).alias("seq"), F.to_json(F.struct("c_custkey")).alias("body"))
    fields = (Field("c_custkey", "bigint"), Field("segment", key="s"), Field("nation", key="n"))
    out = nm.ingest_time(nm.normalize(explode_records(pages, None), fields, ()).drop("_absent", "_unread"), "collected_at", datetime(2024, 5, 1))
    return out.withColumn("collected_at", F.col("collected_at").cast(NTZ))


@query("""SELECT p_partkey, split_part(p_name, ' ', 1) AS head, substr(p_name, strpos(p_name, ' ') + 1) AS rest FROM part WHERE strpos(p_name, ' ') > 0""")
def split_names(t):
    return inc.split_names(t.part.select("p_partkey", F.regexp_replace("p_name", "^([^ ]*) ", "$1/").alias("n")), "n", "head", "rest").drop("n")


# ---- scalar functions ----------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN length(text) > 4000 THEN left(text, 2000) || '[truncated]' || right(text, 2000) ELSE text END AS text, 'https://example.org/' || source || '/' || doc_id AS url FROM documents""")
def truncate_middle(t):
    return t.documents.select("doc_id", co.truncate_middle(F.col("text")).alias("text"), F.concat(F.lit("https://example.org/"), "source", F.lit("/"), "doc_id").alias("url"))


@query("""SELECT o_orderkey, CASE b WHEN 'true' THEN true WHEN 'false' THEN false END AS flag, try_cast(p AS DOUBLE) AS price, CASE WHEN d = '' THEN NULL ELSE CAST(d AS TIMESTAMP) END AS at, CASE WHEN d = '' THEN NULL ELSE CAST(d[1:10] AS DATE) END AS day FROM (
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'TRUE' ELSE '1' END AS b, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS p, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderdate AS VARCHAR) END AS d FROM orders)""")
def coercions(t):
    k = F.col("o_orderkey")
    b = F.when(k % 4 == 0, "true").when(k % 4 == 1, "false").when(k % 4 == 2, "TRUE").otherwise("1")
    p = F.when(k % 5 == 0, "").when(k % 5 == 1, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    d = F.when(k % 3 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return t.orders.select("o_orderkey", co.to_bool(b).alias("flag"), co.to_double(p).alias("price"), co.to_timestamp(d).cast(NTZ).alias("at"), co.date_prefix(d).cast("date").alias("day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS seen, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_text, o_orderpriority FROM orders""")
def sniff_timestamps(t):
    raw = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("seen"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"), "o_orderpriority")
    out = co.sniff_timestamps(raw, "o_orderkey")
    return out.withColumn("seen", F.col("seen").cast(NTZ))


def _hmac(column: str, key: bytes = b"pepper") -> str:
    """The token of a column, in DuckDB's SQL."""
    inner, outer = (bytes(b ^ pad for b in key.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({column}))))[1:18]"


@query(f"SELECT c_custkey, {_hmac('c_name')} AS c_name, c_mktsegment FROM customer")
def tokenize_names(t):
    return tokenize(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_name", "absent"], "pepper")


@query(f"""SELECT token, count(*) AS n_orders FROM (SELECT {_hmac('c_name')} AS token, c_custkey FROM customer) JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def tokenized_join(t):
    named = t.customer.select("c_custkey", token(F.col("c_name"), "pepper").alias("token"))
    return t.orders.join(named, F.col("o_custkey") == F.col("c_custkey")).groupBy("token").agg(F.count("*").alias("n_orders"))
