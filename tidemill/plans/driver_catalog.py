"""Registered queries of datasets that nothing else runs: orders become the records of each, with a value at every field's path, and the
loaded table must have each value at its column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.catalog import DATASETS
from tidemill.plans.driver import NTZ, Tables, query
from tidemill.plans.driver_runs import AS_OF, _bodies, _land, _text, _warehouse
from tidemill.plans.run import run_dataset
from tidemill.spec import Dataset, Field

NAMES = [
    *(f"github_{n}" for n in ("commits", "workflow_runs", "workflow_jobs", "runner_groups", "repo_properties")),
    *(f"servicenow_{n}" for n in ("changes", "change_tasks", "problems", "user_groups", "departments", "cmdb_cis", "hardware_assets", "catalog_items", "catalog_requests")),
    "sonarqube_analyses",
]
#: The one entity that children belong to.
ENTITY = {"full_name": "acme/r", "repo_full_name": "acme/r", "id": "7", "key": "k7"}


def _is_gappy(field: Field, place: int) -> bool:
    """Whether every third value of a field is null."""
    return field.nullable and place > 3


def _value(field: Field, place: int) -> Column:
    """A field's value in a record of ``orders``."""
    key = F.col("o_orderkey")
    if field.type == "boolean":
        return key % (2 + place) == 0
    if field.type in ("bigint", "integer"):
        return key + place
    if field.type == "double":
        return key / 4
    if field.type == "timestamptz":
        return _text("o_orderdate")
    text = F.concat(F.lit(f"{place}-"), key.cast("string"))
    return F.when(key % 3 != 0, text) if _is_gappy(field, place) else text


def _value_sql(field: Field, place: int) -> str:
    """The same in SQL. Registering makes no columns, as it needs no session."""
    if field.type == "boolean":
        return f"o_orderkey % {2 + place} = 0"
    if field.type in ("bigint", "integer"):
        return f"CAST(o_orderkey + {place} AS {'BIGINT' if field.type == 'bigint' else 'INTEGER'})"
    if field.type == "double":
        return "o_orderkey / 4"
    if field.type == "timestamptz":
        return "o_orderdate"
    text = f"'{place}-' || o_orderkey"
    return f"CASE WHEN o_orderkey % 3 <> 0 THEN {text} END" if _is_gappy(field, place) else text


def _record(values: dict[str, Column]) -> Column:
    """An object with the values at their dotted paths."""
    inner: dict[str, dict[str, Column]] = {}
    for path, value in values.items():
        head, _, rest = path.partition(".")
        inner.setdefault(head, {})[rest] = value
    return F.struct(*((held[""] if "" in held else _record(held)).alias(head) for head, held in inner.items()))


def _entity(d: Dataset) -> str:
    """The entity key of a child's pages, as JSON text."""
    if not d.parent:
        return "null"
    parts = {part: ENTITY[column] for part, column in d.parent_key.items()}
    return f'"{parts["*"]}"' if "*" in parts else "{" + ", ".join(f'"{k}": "{v}"' for k, v in parts.items()) + "}"


def _register(name: str) -> None:
    d = DATASETS[name]
    sql = [f"{repr(ENTITY[d.parent_key[f.key]]) if f.key else _value_sql(f, i)} AS {f.name}" for i, f in enumerate(d.fields)]

    def run(t: Tables):
        w = _warehouse(t)
        if d.parent:
            columns = [*d.parent_key.values()]
            w.table(d.parent).commit(t.spark.range(1).select(*(F.lit(ENTITY[c]).alias(c) for c in columns)))
        pages = _bodies(t.orders, _record({f.source: _value(f, i) for i, f in enumerate(d.fields) if not f.key}), d.records or None)
        _land(w, name, pages.withColumn("entity_key", F.lit(_entity(d))))
        run_dataset(w, d, "full", as_of=AS_OF)
        rows = w.table(name).read()
        return rows.select(*(F.col(f.name).cast(NTZ).alias(f.name) if f.type == "timestamptz" else F.col(f.name) for f in d.fields))

    run.__name__ = f"run_{name}"
    query(f"SELECT {', '.join(sql)} FROM orders")(run)


for _name in NAMES:
    _register(_name)
