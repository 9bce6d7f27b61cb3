"""The history load: office-months not loaded yet, many of them in one job.

A ledger table names the office-months that are done. A slot enters it only
after its appointments, their tickets and their items are committed, so a run
that is stopped anywhere is resumed by the next one: what the ledger lacks is
loaded again, and loading a slot twice leaves the rows of one load. An office
whose fetch fails keeps its slots pending; the others go on.

Raw records are filtered by date before they are conformed, and only the
folders of the slots are rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.parse import to_date
from fieldlake.operators import conform as C
from fieldlake.operators import load as L
from fieldlake.plans.nightly import (
    Fetch, Run, _columns, _union, item_columns, of_office, refresh_dimensions, ticket_columns)
from fieldlake.sources import sinks

LEDGER = "backfill_ledger"
LEDGER_SCHEMA = ("kind string, office_id long, month_start date, appointments long, tickets long, ticket_items long, "
                 "run_at timestamp")
SLOTS_PER_JOB = 24
WHOLE = {"dim_customers": ("customer", C.conform_customers), "dim_subscriptions": ("subscription", C.conform_subscriptions)}

Slot = tuple[int, dt.date]


def ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/{LEDGER}"
    return sinks.read(spark, path) if sinks.exists(spark, path) else spark.createDataFrame([], LEDGER_SCHEMA)


def _note(rows: DataFrame, root: str) -> None:
    sinks.append(rows, f"{root}/{LEDGER}")


def load_dimensions(spark: SparkSession, fetch: Fetch, root: str, offices: Iterable[int], run_at) -> None:
    """All five dimensions in full, once: the slow ones replaced, customers and
    subscriptions (without orphans) written by id."""
    offices = list(offices)
    refresh_dimensions(spark, fetch, root, offices, run_at)
    for table, (entity, conform) in WHOLE.items():
        raw = _union(of_office(C.real_records(fetch(entity, o)), o) for o in offices)
        sinks.write_by_id(_columns(conform(raw, run_at), table), f"{root}/{table}", sinks.BY_ID[table])
    _note(spark.createDataFrame([("dims", None, None, None, None, None)], LEDGER_SCHEMA.rpartition(",")[0])
          .withColumn("run_at", F.lit(str(run_at)).cast("timestamp")), root)


def load_slots(run: Run, fetch: Fetch, slots: list[Slot], run_at) -> DataFrame:
    """Appointments of these office-months with their tickets and items;
    returns the ledger rows of the offices that got through. A slot for which
    nothing comes keeps what is stored, as in the source."""
    spark, root = run.spark, run.root
    path = f"{root}/fact_appointments"
    months = {o: sorted(m for x, m in slots if x == o) for o in run.active}
    run.active = [o for o in run.active if months[o]]

    def appointments(office):
        day = to_date(F.col("date"))
        raw = of_office(C.real_office(fetch("appointment", office)), office)
        return _columns(C.conform_appointments(raw.filter(F.trunc(day, "month").isin(months[office])), run_at),
                        "fact_appointments")

    month = F.trunc("scheduled_date", "month").alias("month_start")
    staged = run.staged("appointments", appointments)
    if staged:
        new = _union(staged.values())
        filled = [(r["office_id"], r["month_start"]) for r in new.select("office_id", month).distinct().collect()]
        run.load(["appointments"], lambda: sinks.replace_months(
            spark, path, new, filled, F.lit(True), "appointment_id", staged=True))
    stored = sinks.read_months(spark, path, [(o, m) for o in run.active for m in months[o]])
    booked = stored.select("office_id", month, "ticket_id").distinct()
    ids = booked.filter(F.col("ticket_id") > 0).select("office_id", "ticket_id").distinct()

    def tickets(office):
        return L.refetch(of_office(C.real_office(fetch("ticket", office)), office), ids.filter(F.col("office_id") == office),
                         "ticketID", "ticket_id")

    raw = _union(run.staged("tickets", tickets).values())
    if raw is None:
        raw = None if not run.active else tickets(run.active[0]).limit(0)
    if not run.active:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    asked = ids.filter(F.col("office_id").isin(*run.active))
    rows, items = ticket_columns(raw, run_at), item_columns(raw, run_at).checkpoint(eager=True)
    run.load([], lambda: sinks.load_by_id(spark, f"{root}/fact_tickets", rows, asked, "ticket_id", allow_empty=True,
                                          staged=True))
    run.load([], lambda: sinks.load_by_id(spark, f"{root}/fact_ticket_items", items, asked, "ticket_id",
                                          allow_empty=True, staged=True))
    if not run.active:
        return spark.createDataFrame([], LEDGER_SCHEMA)

    def count(df, name):
        return df.groupBy("office_id", "month_start").agg(F.count(F.lit(1)).alias(name))

    per_ticket = booked.filter(F.col("ticket_id") > 0)
    keys = ["office_id", "month_start"]
    done = spark.createDataFrame([(o, m) for o in run.active for m in months[o]], "office_id long, month_start date")
    for df, name in ((stored.select("office_id", month), "appointments"),
                     (per_ticket.join(rows.select("office_id", "ticket_id"), ["office_id", "ticket_id"]), "tickets"),
                     (per_ticket.join(items.select("office_id", "ticket_id"), ["office_id", "ticket_id"]), "ticket_items")):
        done = done.join(count(df, name), keys, "left")
    return done.select(F.lit("slot").alias("kind"), *keys, *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("appointments", "tickets", "ticket_items")],
        F.lit(str(run_at)).cast("timestamp").alias("run_at"))


def backfill_run(spark: SparkSession, fetch: Fetch, root: str, as_of, run_at, years: int = 5,
                 offices: Iterable[int] = (1, 2), slots_per_job: int = SLOTS_PER_JOB,
                 most_jobs: int | None = None) -> DataFrame:
    """Load what the ledger lacks, oldest months first, ``slots_per_job``
    office-months at a time (``most_jobs`` ends the run early); returns the
    progress. Run it again to go on."""
    offices = sorted(offices)
    sinks.ensure_tables(spark, root)
    if ledger(spark, root).filter("kind = 'dims'").isEmpty():
        load_dimensions(spark, fetch, root, offices, run_at)
    calendar = L.backfill_calendar(spark, as_of, years, offices)
    done = ledger(spark, root).filter("kind = 'slot'")
    pending = [(r["office_id"], r["month_start"]) for r in  # a row per office-month of the calendar
               L.backfill_pending(calendar, done).orderBy("month_start", "office_id").collect()]
    jobs = [pending[k:k + slots_per_job] for k in range(0, len(pending), slots_per_job)]
    failed: set[int] = set()
    for slots in jobs[:most_jobs]:
        run = Run(spark, root, [o for o in offices if o not in failed])
        _note(load_slots(run, fetch, [s for s in slots if s[0] not in failed], run_at), root)
        failed |= set(run.errors)
        if len(failed) == len(offices):
            break
    return L.backfill_progress(calendar, ledger(spark, root).filter("kind = 'slot'"))
