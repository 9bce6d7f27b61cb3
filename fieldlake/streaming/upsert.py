"""Incremental sync as a stream (I13).

Raw change files land in a folder; a Structured Streaming query picks up
new files, keeps the latest version of every key in the batch, conforms it, and
upserts it into the table. The table keeps each row's change stamp
(``changed_at``; the epoch where the record has none), so a file that arrives
late cannot replace a newer row.

Customers, subscriptions and tickets lie in folders of id ranges, appointments
in folders of office and month with an index of ids; a batch reads and
rewrites the folders its keys fall in. A ticket brings all of its items: those
stored for it are replaced by those that came. Every commit notes the stream and
the batch, so a batch that runs again after a failure skips the tables that
hold it and does the rest. The latest versions are staged as Parquet for the
time of the batch: keys, rows and items are read from there, column by column,
instead of shuffling the wide raw records once for each.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlake.functions.parse import to_timestamp
from fieldlake.operators import conform as C
from fieldlake.session import scratch_path
from fieldlake.sources import sinks, tables
from fieldlake.sources.schemas import raw_schema


@dataclass(frozen=True)
class Entity:
    """How one entity's change records become rows."""

    conform: Callable
    real: Callable  # drops orphans
    raw_keys: tuple[str, str]
    id_col: str
    stamp: str = "dateUpdated"


ENTITIES: dict[str, Entity] = {
    "customer": Entity(C.conform_customers, C.real_records, ("officeID", "customerID"), "customer_id"),
    "subscription": Entity(C.conform_subscriptions, C.real_records, ("officeID", "subscriptionID"), "subscription_id"),
    "appointment": Entity(C.conform_appointments, C.real_office, ("officeID", "appointmentID"), "appointment_id"),
    "ticket": Entity(C.conform_tickets, C.real_office, ("officeID", "ticketID"), "ticket_id"),
}
CHANGED_AT = "changed_at"


def items_path(table_path: str) -> str:
    """Where the items of the ticket table lie."""
    return f"{table_path.rstrip('/')}_items"


def latest_per_key(raw: DataFrame, raw_keys: Iterable[str], stamp: str) -> DataFrame:
    """One row per key: the one with the greatest change stamp (ties broken
    by the row's values, so the pick is deterministic). A max over a struct
    is combined map-side, so a hot key never gathers in one task."""
    keys = list(raw_keys)
    others = [c for c in raw.columns if c not in keys and c != stamp]
    best = F.max(F.struct(F.col(stamp).alias("_s"), *[F.col(c) for c in others])).alias("_best")
    g = raw.groupBy(*keys).agg(best)
    return g.select(*keys, F.col("_best._s").alias(stamp), *[F.col(f"_best.{c}").alias(c) for c in others])


def _holds(spark: SparkSession, path: str, batch: tuple[str, int] | None) -> bool:
    """Whether a table's last commit holds this batch of the stream already."""
    commit = tables.latest(spark, path)
    return bool(batch and commit and commit.batches.get(batch[0], -1) >= batch[1])


def _newer(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows at least as new as the stored one of their key."""
    held = stored.groupBy(*keys).agg(F.max(CHANGED_AT).alias("_stored"))
    return (incoming.join(held, keys, "left")
            .filter(F.col("_stored").isNull() | (F.col(CHANGED_AT) >= F.col("_stored"))).select(*incoming.columns))


def upsert_batch(spark: SparkSession, batch: DataFrame, table_path: str, entity: str, run_at,
                 applied: tuple[str, int] | None = None) -> None:
    """Apply one batch of change records. ``applied`` (stream, batch number)
    is noted in the commits; a table that has it already is left alone."""
    e = ENTITIES[entity]
    staged = scratch_path(spark, f"batch-{entity}")
    try:
        latest_per_key(e.real(batch), e.raw_keys, e.stamp).select(*batch.columns).write.option(
            "compression", "zstd").parquet(staged)
        _apply(spark, spark.read.schema(batch.schema).parquet(staged), table_path, entity, run_at, applied)
    finally:
        tables.remove(spark, staged)


def _apply(spark: SparkSession, latest: DataFrame, table_path: str, entity: str, run_at,
           applied: tuple[str, int] | None) -> None:
    e = ENTITIES[entity]
    keys = ["office_id", e.id_col]
    changed = F.coalesce(to_timestamp(F.col(e.stamp)), F.timestamp_seconds(F.lit(0))).alias(CHANGED_AT)
    incoming = e.conform(latest, run_at, changed)
    if entity == "appointment":
        _upsert_appointments(spark, incoming, table_path, keys, applied)
        return
    if not sinks.exists(spark, table_path):
        sinks.write_by_id(incoming.limit(0), table_path, e.id_col, allow_empty=True)
    ids = incoming.select(*keys)
    new = _newer(incoming, sinks.read_ids(spark, table_path, ids, e.id_col), keys).checkpoint(eager=True)
    accepted = new.select(*keys).distinct()
    if entity == "ticket":  # children first: the next run still sees which tickets were accepted
        _replace_items(spark, latest, accepted, table_path, run_at, applied)
    if not _holds(spark, table_path, applied):
        sinks.load_by_id(spark, table_path, new, accepted, e.id_col, batch=applied, staged=True)


def _replace_items(spark: SparkSession, raw: DataFrame, accepted: DataFrame, table_path: str, run_at,
                   applied: tuple[str, int] | None) -> None:
    path = items_path(table_path)
    rows = C.explode_ticket_items(raw, run_at)
    if not sinks.exists(spark, path):
        sinks.write_by_id(rows.limit(0), path, "ticket_id", allow_empty=True)
    if not _holds(spark, path, applied):
        rows = rows.join(accepted, ["office_id", "ticket_id"], "left_semi").select(*rows.columns)
        sinks.load_by_id(spark, path, rows, accepted, "ticket_id", allow_empty=True, batch=applied)


def _upsert_appointments(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str],
                         applied: tuple[str, int] | None) -> None:
    if not sinks.exists(spark, path):
        sinks.write_fact(incoming.limit(0), path, allow_empty=True)
    if _holds(spark, path, applied):
        return
    stored = sinks.read_rows_of(spark, path, incoming.select(*keys), keys[1])
    new = _newer(incoming, stored, keys).checkpoint(eager=True)
    sinks.replace_months(spark, path, new, [], None, keys[1], batch=applied, staged=True)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's id, which its checkpoint keeps over restarts."""
    (row,) = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").limit(1).collect()
    return json.loads(row[0])["id"]


def start_upsert_stream(spark: SparkSession, landing: str, table_path: str, entity: str,
                        checkpoint: str, run_at, available_now: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed
    and stops (``awaitTermination()`` to wait)."""
    src = (spark.readStream.schema(raw_schema(entity)).option("mode", "PERMISSIVE")
           .option("maxFilesPerTrigger", 1000).json(landing))

    def apply(batch: DataFrame, number: int) -> None:
        upsert_batch(spark, batch, table_path, entity, run_at, (_stream_id(spark, checkpoint), number))

    w = src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
