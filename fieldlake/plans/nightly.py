"""The nightly sync of the star schema, composed of the load operators.

Appointments of the look-back window (with those that vanished from the
search), the tickets of these appointments and their items, then the customers
and subscriptions changed since. Per entity, each office's records are fetched
and conformed by themselves, side by side, and all of them are loaded in one
commit; an office whose fetch fails is left out from then on, and its health
row keeps the counts reached before. The values that the safe parsers replaced
are noted beside the conformed records and counted with them, without a scan of
their own, and appended to the table ``load_rejects``.

Tables are committed folders under one root: appointments by (office, month),
the others by (office, range of ids), so a night reads and rewrites the folders
it touches and no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.parse import to_date, to_int
from fieldlake.operators import conform as C
from fieldlake.operators import load as L
from fieldlake.operators import quality as Q
from fieldlake.session import ensure_checkpoint_dir
from fieldlake.sources import sinks
from fieldlake.sources.schemas import STAR_SCHEMAS

Fetch = Callable[[str, int], DataFrame]  # (raw entity, office) -> the office's raw records

# Statuses that the source's search leaves out: cancelled, rescheduled.
INACTIVE = (-1, -2)

REJECTS = "office_id bigint, entity string, field string, records bigint, rejects bigint"
NOTED = "_rejected"  # a staged row's rejected fields, as an array of names

DIMENSIONS = {"dim_service_types": ("serviceType", C.conform_service_types),
              "dim_employees": ("employee", C.conform_employees),
              "dim_products": ("product", C.conform_products)}


def of_office(raw: DataFrame, office: int) -> DataFrame:
    return raw.filter(to_int(F.col("officeID")) == office)


class Run:
    """The offices of one sync that still go on, with their counts and the
    errors of the others."""

    def __init__(self, spark: SparkSession, root: str, offices: Iterable[int]):
        self.spark, self.root = spark, root
        self.offices = sorted(offices)
        self.active = list(self.offices)
        self.counts = {o: dict.fromkeys(L.SYNC_ENTITIES, 0) for o in self.offices}
        self.errors: dict[int, str] = {}
        self.rejects: list[tuple[int, str, str, int, int]] = []  # office, entity, field, records, rejects
        ensure_checkpoint_dir(spark)

    def fail(self, offices: Iterable[int], error: Exception) -> None:
        for o in offices:
            self.errors.setdefault(o, str(error))
        self.active = [o for o in self.active if o not in self.errors]

    def checkpointed(self, rows: DataFrame, entity: str | None) -> tuple[DataFrame, int, list[int]]:
        """The rows, conformed once, their number and their rejects per field."""
        rows = rows.checkpoint(eager=True)
        counts = Q.reject_counts(entity, F.col(NOTED)) if entity else []
        n, *rejects = rows.agg(F.count(F.lit(1)), *counts).first()
        return rows.drop(NOTED), n, rejects

    def note(self, office: int, entity: str, n: int, rejects: list[int]) -> None:
        fields = [f for f, _ in Q.REJECT_RULES[entity]]
        self.rejects += [(office, entity, f, n, x) for f, x in zip(fields, rejects, strict=True)]

    def staged(self, name: str, make: Callable[[int], DataFrame], entity: str | None = None) -> dict[int, DataFrame]:
        """Each active office's rows, fetched and conformed once and side by
        side, without offices that have none; counts them as ``name`` and, with
        ``entity``, its rejects, which the rows then note in a column."""
        def one(office):
            try:
                return *self.checkpointed(make(office), entity), None
            except Exception as e:  # the other offices go on; the health row says what failed
                return None, 0, None, e

        with ThreadPoolExecutor(max(1, len(self.active))) as pool:
            done = dict(zip(self.active, pool.map(one, self.active), strict=True))
        for office, (_, n, rejects, error) in done.items():
            if error is not None:
                self.fail([office], error)
            elif entity:
                self.note(office, entity, n, rejects)
            self.counts[office][name] = n
        return {o: rows for o, (rows, n, *_) in done.items() if n}

    def load(self, names: Iterable[str], write: Callable[[], object]) -> None:
        """One load for all active offices; if it fails they all do, without
        the counts of what did not get in."""
        try:
            write()
        except Exception as e:
            for o in self.active:
                self.counts[o].update(dict.fromkeys(names, 0))
            self.fail(list(self.active), e)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _columns(rows: DataFrame, name: str, *extra: str) -> DataFrame:
    return rows.select(*STAR_SCHEMAS[name].names, *extra)


def _noted(entity: str):
    return Q.rejected_fields(entity).alias(NOTED)


def sync_appointments(run: Run, fetch: Fetch, start, end, run_at) -> None:
    """The window as the search returns it now, and the stored appointments
    it no longer returns, fetched again by id."""
    path = f"{run.root}/fact_appointments"
    dates = [F.lit(str(x)).cast("date") for x in (start, end)]

    def rows(office):
        raw = of_office(C.real_office(fetch("appointment", office)), office)
        stored = sinks.read_months(run.spark, path, [(office, m) for m in sinks._months(start, end)])
        active = raw.filter(to_date(F.col("date")).between(*dates)
                            & ~F.coalesce(to_int(F.col("status")).isin(*INACTIVE), F.lit(False)))
        found = active.select(to_int(F.col("officeID")).alias("office_id"),
                              to_int(F.col("appointmentID")).alias("appointment_id"))
        gone = L.vanished_ids(stored, found, office, start, end)
        routes, n, rejects = run.checkpointed(
            of_office(fetch("route", office), office).select("*", _noted("route")), "route")
        run.note(office, "route", n, rejects)
        return _columns(C.conform_appointments(active.unionByName(L.refetch(raw, gone)), run_at, _noted("appointment"),
                                               route_tech=L.route_tech(routes, start, end, office)),
                        "fact_appointments", NOTED)

    staged = run.staged("appointments", rows, "appointment")
    if staged:
        slots = [(o, m) for o in staged for m in sinks._months(start, end)]
        dropped = F.col("office_id").isin(*staged) & F.col("scheduled_date").between(*dates)
        run.load(["appointments"], lambda: sinks.replace_months(
            run.spark, path, _union(staged.values()), slots, dropped, "appointment_id", staged=True))


def ticket_columns(raw: DataFrame, run_at) -> DataFrame:
    return _columns(C.conform_tickets(raw, run_at), "fact_tickets")


def item_columns(raw: DataFrame, run_at) -> DataFrame:
    return _columns(C.explode_ticket_items(raw, run_at), "fact_ticket_items")


def sync_tickets(run: Run, fetch: Fetch, start, end, run_at) -> None:
    """The tickets of the window's appointments, by id, and their items.
    Items of every requested ticket are replaced, also those of a ticket that
    did not come back."""
    months = sinks._months(start, end)
    booked = sinks.read_months(run.spark, f"{run.root}/fact_appointments", [(o, m) for o in run.active for m in months])
    ids = {o: L.window_ticket_ids(booked, o, start, end) for o in run.active}

    def rows(office):
        raw = L.refetch(of_office(C.real_office(fetch("ticket", office)), office), ids[office], "ticketID", "ticket_id")
        return raw.select("*", _noted("ticket"))

    staged = run.staged("tickets", rows, "ticket")
    if not staged:
        return
    raw, asked = _union(staged.values()), _union(ids[o] for o in staged)
    tickets = ticket_columns(raw, run_at)
    items = item_columns(raw, run_at).checkpoint(eager=True)
    found = raw.select(to_int(F.col("officeID")).alias("office"), F.size(F.filter("items", lambda x: x.isNotNull())).alias("n"),
                       _noted("ticketItem"))
    for office, n, *rejects in found.groupBy("office").agg(  # a row per office
            F.sum(F.greatest("n", F.lit(0))), *Q.reject_counts("ticketItem", F.col(NOTED))).collect():
        run.counts[office]["ticket_items"] = n
        run.note(office, "ticketItem", n, rejects)
    run.load(["tickets", "ticket_items"], lambda: sinks.load_by_id(
        run.spark, f"{run.root}/fact_tickets", tickets, asked, "ticket_id", staged=True))
    if run.active:
        run.load(["ticket_items"], lambda: sinks.load_by_id(
            run.spark, f"{run.root}/fact_ticket_items", items, asked, "ticket_id", allow_empty=True, staged=True))


def sync_changed(run: Run, fetch: Fetch, entity: str, name: str, conform: Callable, as_of, days: int, run_at) -> None:
    """Records changed since ``as_of`` minus ``days`` days, replaced by id."""
    table = f"dim_{name}"
    key = sinks.BY_ID[table]

    def rows(office):
        raw = of_office(C.real_records(fetch(entity, office)), office)
        return _columns(conform(L.changed_since(raw, as_of, days), run_at, _noted(entity)), table, NOTED)

    staged = run.staged(name, rows, entity)
    if staged:
        new = _union(staged.values())
        run.load([name], lambda: sinks.load_by_id(run.spark, f"{run.root}/{table}", new, new.select("office_id", key),
                                                  key, staged=True))


def refresh_dimensions(spark: SparkSession, fetch: Fetch, root: str, offices: Iterable[int], run_at) -> None:
    """Full replacement of the slow dimensions from all offices."""
    for table, (entity, conform) in DIMENSIONS.items():
        raw = [of_office(fetch(entity, o), o) for o in offices]
        sinks.overwrite(_columns(L.refresh_dimension(raw, conform, run_at), table), f"{root}/{table}")


def create_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Write tables in the layout that the sync expects."""
    for name, rows in tables.items():
        sinks.create(rows.select(*[c for c in STAR_SCHEMAS[name].names if c in rows.columns]), f"{root}/{name}", name)


def nightly_sync(spark: SparkSession, fetch: Fetch, root: str, offices: Iterable[int], as_of, days: int,
                 run_at, full_dims: bool = False) -> DataFrame:
    """Sync every office and append a health row for each, also for one that
    failed, and what its parsers rejected; returns this run's health rows. ``full_dims`` forces the refresh of
    the slow dimensions, which otherwise is due on Mondays; if it fails, the
    rows of all offices say so and nothing else is loaded."""
    run = Run(spark, root, offices)
    end = dt.date.fromisoformat(str(as_of)[:10])
    start = end - dt.timedelta(days=days)
    if L.is_refresh_day(end, full_dims):
        run.load([], lambda: refresh_dimensions(spark, fetch, root, run.offices, run_at))
    for step in (lambda: sync_appointments(run, fetch, start, end, run_at),
                 lambda: sync_tickets(run, fetch, start, end, run_at),
                 lambda: sync_changed(run, fetch, "customer", "customers", C.conform_customers, as_of, days, run_at),
                 lambda: sync_changed(run, fetch, "subscription", "subscriptions", C.conform_subscriptions, as_of, days,
                                      run_at)):
        if run.active:
            run.load([], step)
    health = [(str(run_at), o, "Residential" if o == 1 else "Commercial", "error" if o in run.errors else "success",
               run.errors.get(o), days, *[run.counts[o][e] for e in L.SYNC_ENTITIES]) for o in run.offices]
    schema = STAR_SCHEMAS["sync_health"]
    kinds = ", ".join(f"{f.name} {'string' if f.name == 'run_at' else f.dataType.simpleString()}" for f in schema)
    rows = spark.createDataFrame(health, kinds).withColumn("run_at", F.col("run_at").cast("timestamp"))
    sinks.write_health(rows, f"{root}/sync_health")
    found = spark.createDataFrame(run.rejects, REJECTS)
    sinks.append(found.select(F.lit(str(run_at)).cast("timestamp").alias("run_at"), "*"), f"{root}/load_rejects")
    return rows
