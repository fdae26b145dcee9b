"""Landed pages as a stream: each micro-batch takes the steps of a forward run, once.

A stream is known by the id that its checkpoint keeps. Each version of a target has the number of the last batch of every stream that
it took, and every later version carries it on, whoever makes it; so a batch that comes again changes nothing, however many
other streams and runs were at work meanwhile. Beyond that the target's ledger of pages tells which were taken, by runs or by
streams that are gone: a new checkpoint takes what is new and nothing else."""

from __future__ import annotations

import hashlib
import time
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.plans.run import Taken, Warehouse, finish, judged, loaded_parent, not_in_ledger, pages_of_parents, parent_keys, rows_of, staged_rows, unit_of
from tidemill.sources.pages import SCHEMA, PageWatch, of
from tidemill.spec import Context, Dataset


def take_batch(warehouse: Warehouse, dataset: Dataset, pages: DataFrame, stream: str, k: int, as_of: datetime, tenant: str = "") -> None:
    """Batch ``k`` of a stream into the target: guard, rows, tokens, staging, checks, upsert, watermarks by tenant, ledger, history. A child's
    pages whose parents aren't there stay for a later run; without a loaded parent the batch fails, as a run does. Rows
    join in the order of their landing within a batch; a page that lands late overwrites."""
    ops, target = warehouse.ops, warehouse.table(dataset.name)
    now, mark = target.current(), f"stream:{stream}"
    if now and now["marks"].get(mark, -1) >= k:
        return
    began, run_id = time.monotonic(), f"{stream}:{k}"
    context = Context(run_id, "forward", as_of, tenant)
    staging = warehouse.staging(f"{dataset.name}_stream", hashlib.sha256(run_id.encode()).hexdigest())
    staging.drop()  # what an attempt before may have left
    ops.register([dataset], as_of)
    begun = ops.record(run_id, dataset.name, tenant, "forward", "running", as_of)
    try:
        own = of(pages, dataset.name, tenant or None)
        first = own.agg(F.min("day").alias("day"), F.count_if(F.col("day").isNull()).alias("undated")).first()
        own = not_in_ledger(target, now, own, None if first["undated"] else first["day"])
        if dataset.parent:
            own = pages_of_parents(dataset, own, parent_keys(dataset, loaded_parent(warehouse, dataset), context)[0])
        watch = PageWatch(own)
        staged, watched = staged_rows(warehouse, dataset, rows_of(dataset, watch.pages, context), context, staging.path + "/rows")
        if dataset.guarded:
            watch.refuse_envelopes()
        staged = warehouse.spark.read.schema(staged.schema).parquet(staging.path + "/rows")  # in the target's own session
        loaded, warnings = 0, watched.warnings()
        warnings += (f"{watch.corrupt} bodies are not JSON",) if watch.corrupt else ()
        if not staged.isEmpty():
            warnings += judged(dataset, staged, warehouse.violations(dataset.name, hashlib.sha256(run_id.encode()).hexdigest())).warnings
            done = finish(warehouse, dataset, staged, context, "upsert", "_tenant", Taken(own.select("day", unit_of().alias("unit")).distinct(), {mark: k}))
            loaded, warnings = done.rows_loaded, (*warnings, *done.warnings)
        ops.record(run_id, dataset.name, tenant, "forward", "success", as_of, loaded, time.monotonic() - began, "; ".join(warnings) or None, None, begun)
    except Exception as error:
        ops.record(run_id, dataset.name, tenant, "forward", "failed", as_of, None, time.monotonic() - began, None, str(error)[:2000], begun)
        raise
    finally:
        staging.drop()


def stream_pages(warehouse: Warehouse, dataset: Dataset, tenant: str = "") -> DataFrame:
    """A dataset's pages as they land; conditions on dataset and tenant choose folders."""
    return of(warehouse.spark.readStream.schema(SCHEMA).parquet(warehouse.pages), dataset.name, tenant or None)


def stream_dataset(warehouse: Warehouse, dataset: Dataset, checkpoint: str, as_of: datetime, tenant: str = "", available_now: bool = True, pages: DataFrame | None = None) -> StreamingQuery:
    """A query over the warehouse's pages as they land, or over ``pages``, such as ``raw_pages`` of a stream of files; with ``available_now`` it
    ends when all are taken."""

    def take(batch: DataFrame, k: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        take_batch(warehouse, dataset, batch, stream, k, as_of, tenant)

    writer = (stream_pages(warehouse, dataset, tenant) if pages is None else pages).writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
