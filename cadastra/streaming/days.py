"""Operation-day documents as a stream: every date in a micro-batch runs as one day step, oldest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadastra.plans.daily import run_day
from cadastra.plans.replay import check_load
from cadastra.rules import Rules
from cadastra.session import scope
from cadastra.sources import operations
from cadastra.sources.catalog import Catalog
from cadastra.sources.store import Store


def apply_batch(store: Store, documents: DataFrame, catalog: Catalog, rules: Rules) -> None:
    """Run the dates of one micro-batch, oldest first.

    A date that is already complete is not run again: it was done by an earlier attempt of this batch, and a date
    is accepted once. A date before the last complete one that was never run stops the stream, as does a date
    listed twice. Broken and undated elements are rejected without a date, before any date runs, and once each.
    The documents are parsed once; their rows go when the batch is done.
    """
    with scope(documents.sparkSession):
        _apply_rows(store, operations.stored_rows(documents), catalog, rules)


def _apply_rows(store: Store, rows: DataFrame, catalog: Catalog, rules: Rules) -> None:
    rejects = operations.rejects_of(rows)
    check_load(rejects, rules)
    store.add_undated("reject", rejects.where("op_date IS NULL"))
    days = operations.dates_of(rows).groupBy("op_date").count()
    listed = sorted((r["op_date"], r["count"]) for r in days.collect())  # one row per date of the batch
    twice = [str(d) for d, n in listed if n > 1]
    if twice:
        raise ValueError(f"operation dates listed more than once: {twice}")
    dates = [day for day, _ in listed]
    complete = {r["op_date"] for r in store.read("op_day").where(F.col("op_date").isin(dates)).collect()}
    events = operations.all_events(rows)
    for day in dates:
        if day not in complete:
            run_day(store, events, day, catalog, rules, rejects)


def ingest_days(
    spark: SparkSession,
    path: str,
    store: Store,
    catalog: Catalog,
    checkpoint: str,
    rules: Rules = Rules(),
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Process every document now in ``path`` and stop; the checkpoint remembers which files were done."""
    documents = operations.stream_documents(spark, path, files_per_batch)

    def step(batch: DataFrame, _: int) -> None:
        apply_batch(store, batch, catalog, rules)

    return (
        documents.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
