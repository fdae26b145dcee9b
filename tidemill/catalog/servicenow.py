"""Datasets of incidents, changes, people, places, assets and choices. Every leaf of a body is text."""

from __future__ import annotations

from tidemill.catalog.marts import by_day
from tidemill.operators.kept import Counts
from tidemill.spec import Dataset
from tidemill.spec import Field as f

# Names of tables and columns, the longest text that a column may hold, and which columns may be null in any number.
LENGTHS = {"sys_id": 32, "number": 40, "state": 100, "priority": 100, "category": 200, "assigned_to": 32, "assignment_group": 32}


def _text(*names: str) -> tuple[f, ...]:
    return tuple(f(n) for n in names)


def _times(*names: str) -> tuple[f, ...]:
    return tuple(f(n, "timestamptz") for n in names)


def _dataset(name: str, *fields: f, unique: tuple[tuple[str, ...], ...] = (), open_ended: tuple[str, ...] = (), **more) -> Dataset:
    """A table with its id before the fields and its time of update behind them, loaded forward by that time unless told otherwise."""
    columns = (f("sys_id", nullable=False), *fields, f("sys_updated_on", "timestamptz"))
    lengths = {c.name: LENGTHS[c.name] for c in columns if c.name in LENGTHS}
    how = {"mode": "forward", "incremental": "sys_updated_on"} | more
    return Dataset(f"servicenow_{name}", columns, ("sys_id",), "result", unique=unique, null_limits={n: 1.0 for n in open_ended}, max_lengths=lengths, **how)


DATASETS = (
    _dataset("incidents", *_text("number", "short_description", "description", "state", "priority", "severity", "category", "assigned_to", "assignment_group"), *_times("opened_at", "closed_at"), unique=(("number",),), open_ended=("closed_at",), kept={"by_day": Counts(by_day)}),
    _dataset("changes", *_text("number", "short_description", "description", "state", "type", "priority", "risk", "category", "assigned_to", "assignment_group"), *_times("opened_at", "closed_at", "start_date", "end_date"), unique=(("number",),), open_ended=("closed_at", "start_date", "end_date",)),
    _dataset("change_tasks", *_text("number", "short_description", "state", "priority", "change_request", "assigned_to", "assignment_group"), *_times("planned_start_date", "planned_end_date"), unique=(("number",),), open_ended=("planned_start_date", "planned_end_date",)),
    _dataset("problems", *_text("number", "short_description", "state", "priority", "category", "assigned_to", "assignment_group"), *_times("opened_at", "closed_at"), unique=(("number",),), open_ended=("closed_at",)),
    _dataset("users", *_text("first_name", "last_name", "name", "email", "title", "department", "manager"), f("active", "boolean"), f("last_login_time", "timestamptz"), unique=(("email",),), open_ended=("last_login_time",)),
    _dataset("user_groups", *_text("name", "description", "manager", "email"), f("active", "boolean"), *_text("type")),
    _dataset("departments", *_text("name", "dept_head", "description", "parent", "primary_contact", "company")),
    _dataset("locations", *_text("name", "city", "state", "country"), f("latitude", "double"), f("longitude", "double"), *_text("parent"), open_ended=("latitude", "longitude",)),
    _dataset("cmdb_cis", *_text("name", "sys_class_name", "category", "subcategory", "operational_status", "asset_tag", "serial_number", "assigned_to", "support_group", "company", "location")),
    _dataset("hardware_assets", *_text("display_name", "asset_tag", "serial_number", "model", "model_category", "assigned_to", "location", "install_status", "substatus", "ci")),
    _dataset("catalog_items", *_text("number", "short_description", "request", "cat_item", "state", "quantity", "price", "stage"), *_times("opened_at", "closed_at"), unique=(("number",),), open_ended=("closed_at",)),
    _dataset("catalog_requests", *_text("number", "short_description", "request_state", "requested_for"), *_times("opened_at", "closed_at"), unique=(("number",),), open_ended=("closed_at",)),
    _dataset("choices", *_text("name", "element", "value", "label", "language"), f("inactive", "boolean"), load="replace", mode="full", incremental=None),
)
