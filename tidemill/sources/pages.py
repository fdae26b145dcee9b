"""Landed pages: response bodies as they came, one row each, with what is known of the request.

Columns: ``dataset``, ``tenant``, ``day`` (of landing), ``entity_key`` (JSON text), ``page``, ``fetched_at``, ``seq`` (order of
landing), ``body``. Pages lie in folders by dataset, tenant and day, so that a run's conditions on these leave whole folders out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "dataset string, tenant string, entity_key string, page int, fetched_at timestamp, seq bigint, body string, day date"
META = ["tenant", "entity_key", "page", "fetched_at", "seq"]
FOLDERS = ["dataset", "tenant", "day"]
#: What tells one page from another, beside its folders.
UNIT = ["entity_key", "page", "fetched_at", "seq"]


class BadPages(ValueError):
    """Pages that are no answers but errors."""


def land(pages: DataFrame, path: str, day: date) -> None:
    """Adds ``pages`` (with or without ``day``) to those that lie at ``path``, as landed on a day. Days of landing must not go back."""
    named = {n: F.lit(day) if n == "day" else F.col(n) for n in (c.split()[0] for c in SCHEMA.split(", "))}
    pages.select(*(c.alias(n) for n, c in named.items())).write.mode("append").partitionBy(*FOLDERS).parquet(path)


def of(pages: DataFrame, dataset: str, tenant: str | None = None) -> DataFrame:
    """The pages of a dataset, and of a tenant if one is named; conditions on folders alone. A page without a tenant has an empty one."""
    own = pages.where(F.col("dataset") == dataset)
    own = own if tenant is None else own.where(F.coalesce("tenant", F.lit("")) == tenant)
    return own.withColumn("tenant", F.coalesce("tenant", F.lit("")))


def read_pages(spark: SparkSession, path: str, dataset: str, tenant: str | None = None, max_pages: int | None = None, since: date | None = None) -> DataFrame:
    """The landed pages of a dataset; all conditions reach the scan, and those on dataset, tenant and day choose its folders. ``since``: landed on
    that day or later, or on a day that isn't known."""
    pages = of(spark.read.schema(SCHEMA).parquet(path), dataset, tenant)
    if since is not None:
        pages = pages.where(F.col("day").isNull() | (F.col("day") >= F.lit(since)))
    return pages if max_pages is None else pages.where(F.col("page") <= max_pages)


def raw_pages(files: DataFrame, dataset: str, tenant: str, page_of: str = r"([0-9]+)\.[A-Za-z]+(?:\.gz)?$", key_of: str | dict[str, str] | None = None) -> DataFrame:
    """Files of raw bodies as pages. ``files``: as ``read_raw`` or ``stream_raw`` give them. ``page_of``: a pattern whose group is the page's
    number in a file's path; ``key_of``: one whose group is the entity key, or one for each part of the key.

    The day and order of landing are those of the files' last change. Bodies are taken as they are, also such as are no JSON: a
    run counts them, and they have no records."""
    path = F.url_decode(F.col("_path"))
    number = F.regexp_extract(path, page_of, 1).try_cast("int")
    if isinstance(key_of, dict):
        key = F.to_json(F.struct(*(F.nullif(F.regexp_extract(path, p, 1), F.lit("")).alias(n) for n, p in key_of.items())))
    else:
        found = F.regexp_extract(path, key_of, 1) if key_of else F.lit("")
        key = F.when(found == "", "null").otherwise(F.regexp_extract(F.to_json(F.array(found)), r"^\[(.*)\]$", 1))
    return files.select(
        F.lit(dataset).alias("dataset"), F.lit(tenant).alias("tenant"), key.alias("entity_key"), F.coalesce(number, F.lit(1)).alias("page"), F.col("_at").alias("fetched_at"),
        (F.unix_micros("_at") * 1000 + F.coalesce(number, F.lit(0)) % 1000).alias("seq"), F.col("value").alias("body"), F.to_date("_at").alias("day"),
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Files as ``value`` (the whole body), ``_path`` and ``_at``; compressed ones by their ending. A body is one value: up to two gigabytes."""
    return _with_origin(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True))


def stream_raw(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_raw``, of the files as they come."""
    return _with_origin(spark.readStream.option("recursiveFileLookup", "true").text(path, wholetext=True))


def _with_origin(files: DataFrame) -> DataFrame:
    return files.select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_at"))


def at(value: Column, path: str, kind: str = "variant") -> Column:
    """What a variant has at a dotted path; null where anything on the way is missing, null or no object."""
    keys = "".join(f"['{key}']" for key in path.split(".")) if path else ""
    return F.try_variant_get(value, "$" + keys, kind)


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with the body as a variant, ``v``; null where it isn't JSON. Pages that have it stay as they are."""
    return pages if "v" in pages.columns else pages.withColumn("v", F.try_parse_json("body"))


def is_object(value: Column) -> Column:
    """Whether a variant is an object; its values aren't gone through."""
    return at(value, "", "struct<errors: variant>").isNotNull()


def explode_records(pages: DataFrame, path: str | None = "") -> DataFrame:
    """One row for each record: page columns, ``pos`` (place in the page) and ``record``.

    ``path`` leads to a list; "" says that the body is the list; None, that the body is one record. A body without that list
    has no records."""
    bodies = parsed(pages)
    if path is None:
        return bodies.where(is_object(F.col("v"))).select(*META, F.lit(0).alias("pos"), F.col("v").alias("record"))
    return bodies.select(*META, F.posexplode(at(F.col("v"), path, "array<variant>")).alias("pos", "record"))


def unnest(rows: DataFrame, value: str, path: str, keep: list[str], into: str = "record", position: str = "pos") -> DataFrame:
    """One row for each element of the list at ``path`` of a variant column, with the columns ``keep`` of its parent. A parent
    without such a list, or with an empty one, has no rows."""
    return rows.select(*keep, F.posexplode(at(F.col(value), path, "array<variant>")).alias(position, into))


class PageWatch:
    """What is counted of pages while they are parsed for their rows, in the same pass: those that are no JSON, error envelopes, the
    largest total that they announce. ``pages`` goes on with the parsed bodies; read the rest after rows were written."""

    def __init__(self, pages: DataFrame, announced: str | None = None):
        v, self.seen = F.col("v"), Observation()
        errors = at(v, "errors", "array<variant>")
        bad = F.when(v.isNull(), "body is not JSON").when(~is_object(v), "body is not an object")
        bad = bad.when(F.size(errors) > 0, F.coalesce(at(F.get(errors, 0), "message", "string"), F.lit("unnamed error")))
        total = at(v, announced, "bigint") if announced else F.lit(None).cast("bigint")
        self.pages = parsed(pages).observe(self.seen, F.count(F.lit(1)).alias("pages"), F.count_if(v.isNull()).alias("corrupt"), F.count_if(bad.isNotNull()).alias("bad"), F.min_by(bad, F.when(bad.isNotNull(), F.col("seq"))).alias("first"), F.max(total).alias("announced"))

    @property
    def n_pages(self) -> int:
        return self.seen.get["pages"]

    @property
    def corrupt(self) -> int:
        return self.seen.get["corrupt"]

    @property
    def announced(self) -> int | None:
        return self.seen.get["announced"]

    def refuse_envelopes(self) -> None:
        """An error, with the number of bad pages and a message, if not every body is an object without errors."""
        if self.seen.get["bad"]:
            raise BadPages(f"{self.seen.get['bad']} bad pages; the first: {self.seen.get['first']}")


def guard_envelopes(pages: DataFrame) -> DataFrame:
    """The pages as they are, if every body is an object without errors; else an error. For frames outside of a run, where there is no pass to
    count along with."""
    watch = PageWatch(pages)
    watch.pages.write.format("noop").mode("overwrite").save()
    watch.refuse_envelopes()
    return pages


def announced_total(pages: DataFrame, path: str) -> DataFrame:
    """One row: the largest total that the pages announce at ``path``."""
    return parsed(pages).agg(F.max(at(F.col("v"), path, "bigint")).alias("announced"))
